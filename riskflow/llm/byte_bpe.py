"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The model is serialised from the vocabulary alone: every token becomes a piece in which each
byte is one fixed character, the piece's score is its negative rank, and the normaliser is the
identity, so merging the best-scored pair is merging the lowest rank. Texts are split by the
pre-token pattern and every match is encoded on its own; decoding maps pieces back to bytes.

A vocabulary may hold tokens that no sequence of merges reaches. The rank library takes
a pre-token that is such a token whole; ``Codec`` finds those tokens once and does the same.

* null text counts as empty: no tokens; a repeated row is encoded again, rows are independent;
* a pre-token of any length is encoded whole; an empty table gives an empty result;
* the model (some MB, bounded by the vocabulary) is the only thing broadcast.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskflow.llm.common import Lately, slices

# One printable character per byte, outside ASCII so that no library treats it specially.
FIRST = 0x4E00
TO_CHARS = {b: FIRST + b for b in range(256)}
FROM_CHARS = {FIRST + b: b for b in range(256)}

#: Bytes of stretches remembered in a task, and as much again for older ones; results don't depend on it.
REMEMBERED = 24 << 20


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a rank file (base64 token, rank)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def to_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(TO_CHARS)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose piece ids are the ranks; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece=to_chars(token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    trainer, plain = model.trainer_spec, model.normalizer_spec
    trainer.model_type = proto.TrainerSpec.BPE
    trainer.vocab_size = len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(tokens), -1, -1, -1
    plain.name = "identity"
    plain.precompiled_charsmap = b""
    plain.add_dummy_prefix = plain.remove_extra_whitespaces = plain.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encode and decode with a serialised model; one per Python worker."""

    def __init__(self, model: bytes, pattern: str) -> None:
        import regex
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor()
        self.pieces.LoadFromSerializedProto(model)
        self.split = regex.compile(pattern).findall
        size = self.pieces.get_piece_size() - 1
        names = [self.pieces.id_to_piece(i) for i in range(size)]
        self.token = pa.array([name.translate(FROM_CHARS).encode("latin-1") for name in names], pa.binary())
        self.digits = pa.array([str(i) for i in range(size)], pa.string())
        encoded = self.pieces.encode(names, num_threads=1)
        self.whole = {name: [i] for i, (name, ids) in enumerate(zip(names, encoded)) if ids != [i]}
        self.stretches = Lately(REMEMBERED)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens as packed 32-bit integers; equal ones are encoded once, all in one call."""
        distinct = list(dict.fromkeys(words))
        data = [word.encode("utf-8") for word in distinct]
        chars = (np.frombuffer(b"".join(data), np.uint8).astype("<u4") + FIRST).tobytes().decode("utf-32-le")
        ends = list(accumulate(map(len, data)))
        names = [chars[a:b] for a, b in zip([0, *ends], ends)]
        ids = self.pieces.encode(names, num_threads=1)
        if self.whole:
            ids = [self.whole.get(name, own) for name, own in zip(names, ids)]
        ends = list(accumulate(map(len, ids)))
        packed = np.fromiter(chain.from_iterable(ids), "<i4", ends[-1] if ends else 0).tobytes()
        known = {word: packed[4 * a : 4 * b] for word, a, b in zip(distinct, [0, *ends], ends)}
        return list(map(known.__getitem__, words))

    def encode_text(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.encode_words(self.split(text))), "<i4")

    def encode_stretches(self, parts: list[str]) -> list[bytes]:
        """Ids of stretches that start with their space, split into pre-tokens where they are new."""
        out = [self.stretches.get(part) for part in parts]
        missing = [k for k, ids in enumerate(out) if ids is None]
        words = self.split("".join([parts[k] for k in missing]))  # a space opens each stretch, so none runs into the next
        ids = self.encode_words(words)
        chars = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        ends = np.searchsorted(chars, np.cumsum([len(parts[k]) for k in missing])) + 1
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))[ends - 1].tolist() if missing else []
        packed = b"".join(ids)
        for k, a, b in zip(missing, [0, *ends], ends):
            out[k] = packed[a:b]
            self.stretches.put(parts[k], out[k])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text, and the ids of all texts one after the other.

        A stretch between two single spaces that neither starts nor ends with white space splits
        the same way wherever it stands, so equal stretches of a batch are encoded once, each
        with the space before it. Texts with other runs of white space are split as a whole.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        stretches = pc.split_pattern(texts, " ")
        starts = stretches.offsets.to_numpy() - stretches.offsets[0].as_py()
        coded = stretches.flatten().dictionary_encode()
        index, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        odd = np.fromiter((not d or d[0].isspace() or d[-1].isspace() for d in distinct), bool, len(distinct))
        first, place = np.unique(index[starts[:-1]], return_inverse=True)
        index[starts[:-1]] = len(distinct) + place
        apart = np.logical_or.reduceat(np.append(odd, odd[first])[index], starts[:-1]) if len(texts) else np.zeros(0, bool)
        later = iter(self.encode_stretches([" " + d for d, o in zip(distinct, odd) if not o]))
        encoded = [b"" if o else next(later) for o in odd]
        encoded += [b"" if odd[i] else self.encode_text(distinct[i]).tobytes() for i in first]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        ids, ends = np.frombuffer(b"".join(encoded), "<i4"), np.cumsum(sizes)
        taken = sizes[index]
        at = np.repeat(ends[index] - np.cumsum(taken), taken) + np.arange(taken.sum())
        offsets, out = np.append(0, np.cumsum(taken))[starts], ids[at]
        if apart.any():
            own = [self.encode_text(texts[i].as_py()) if apart[i] else out[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
            offsets, out = np.append(0, np.cumsum([len(o) for o in own])), np.concatenate(own)
        return offsets, out

    def _joined(self, names: pa.Array, separator: str | bytes, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(offsets.astype(np.int32), names.take(pa.array(ids))), separator)

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        return self._joined(self.token, b"", offsets, ids)

    def listed(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """Decimal ids joined by commas."""
        return self._joined(self.digits, ",", offsets, ids)


_codecs: dict[str, Codec] = {}


def _codec(model: bytes, pattern: str) -> Codec:
    name = hashlib.sha256(model + pattern.encode()).hexdigest()
    if name not in _codecs:
        _codecs[name] = Codec(model, pattern)
    return _codecs[name]


def _map(docs: DataFrame, path: str, pattern: str, schema: str, key: str, text: str, make) -> DataFrame:
    """Run ``make(codec, ids, texts) -> record batch`` over Arrow batches of (key, text)."""
    model = docs.sparkSession.sparkContext.broadcast(sentencepiece_model(read_ranks(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value, pattern)
        for part in slices(batches):
            yield make(codec, part.column(0), part.column(1))
        codec.stretches.clear()  # the worker goes on to other work

    return docs.selectExpr(f"cast(`{key}` as long) as doc_id", f"`{text}` as text").mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text."""

    def make(codec: Codec, keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        offsets, ids = codec.encode(texts)
        return pa.record_batch([keys, pa.ListArray.from_arrays(offsets.astype(np.int32), ids)], names=["doc_id", "ids"])

    return _map(docs, path, pattern, "doc_id long, ids array<int>", key, text, make)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``data`` (the bytes) from ``doc_id`` and ``ids``; null ids decode to no bytes."""

    def make(codec: Codec, keys: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        data = codec.decode(np.append(0, np.cumsum(sizes)), ids.flatten().to_numpy(zero_copy_only=False))
        return pa.record_batch([keys, data.cast(pa.binary())], names=["doc_id", "data"])

    return _map(encoded, path, pattern, "doc_id long, data binary", "doc_id", "ids", make)


def token_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Counts and digests of the ids and of the bytes decoded from them, and the ids if wanted.

    The same ``Codec`` calls as the two functions above, in one pass over the texts.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def digests(values: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(v.as_buffer() or b"").hexdigest() for v in values], pa.string())

    def make(codec: Codec, keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        offsets, ids = codec.encode(texts)
        columns = [keys, pa.array(np.diff(offsets), pa.int64()), digests(codec.listed(offsets, ids)), digests(codec.decode(offsets, ids))]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(offsets.astype(np.int32), ids))
        return pa.record_batch(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _map(docs, path, pattern, schema, key, text, make)
