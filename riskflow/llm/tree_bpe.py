"""BPE encoding of texts of any length by tree concatenation.

A text is encoded by the public tokenizer file as its library does. A long text is cut into pieces of
about ``leaf`` code points, anywhere, also inside words; pieces are encoded in parallel, each as
if it were a whole text, and neighbours are joined pairwise up a tree. A join re-encodes a window
around the cut and lets it grow until both sides agree; then the result is exactly the
encoding of the joined text:

* Pre-tokens come from a scan from left to right that looks at most two characters ahead and never
  back. From a common boundary on, two scans of the same text are the same; inside a run of
  letters, digits, signs or white space they end it at the same place.
* In a byte-pair encoding two neighbouring tokens are always the encoding of their own joined
  text, and a sequence in which this holds for all neighbours is the encoding of the whole. So if
  the window starts with the token that the left side has there, or ends with one that
  the right side has, the encodings on both sides of it can be spliced.

If no agreement is found the window grows to the whole of a side, so every join is exact. Strings of special
tokens are looked for first, as the library does, and never cut. Equal long texts are encoded
once. Pieces are dealt out by text and place, so one long text is encoded by many tasks; its
ids are one row in the end.

* null counts as empty: no tokens; rows are independent, a repeated row is encoded again or shares the work;
* null keys stay; an empty table gives an empty result; other columns are left out of the way.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Lately, kept_table, slices

#: Set in an id that starts a pre-token.
STARTS = np.int32(1 << 30)
#: A scan is sure of what lies so many bytes (two characters) before the end of its text.
AHEAD = 8
#: Pieces that one task joins at a time.
FAN_IN = 16
#: Bytes of stretches remembered per Python worker, and as much again for older ones.
REMEMBERED = 32 << 20


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files of this kind.

    Printable bytes stand for themselves; the others are numbered on from 256.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """The tokenizer file's library, its vocabulary as bytes, and joins."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self._load(text)

    def _load(self, text: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.text, described = text, json.loads(text)
        own, splits = described["model"], described["pre_tokenizer"]
        odd = [a for a in described["added_tokens"] if a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]]
        if own["type"] != "BPE" or own["ignore_merges"] or own["dropout"] or splits["type"] != "ByteLevel" or splits["add_prefix_space"] or described["normalizer"] or odd:
            raise ValueError("not a plain byte-level BPE file")
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True  # special tokens are cut out before
        self.known = Lately(REMEMBERED)
        self.special = {a["content"]: a["id"] for a in described["added_tokens"]}
        byte_of = _byte_of_char()
        tokens = {i: bytes(byte_of[c] for c in name) for name, i in own["vocab"].items()} | {i: name.encode() for name, i in self.special.items()}
        self.token = pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.binary())
        self.size = pc.binary_length(self.token).to_numpy().astype(np.int64)
        self.follows = np.array([bool(t) and t[0] & 0xC0 == 0x80 for t in self.token.to_pylist()])  # starts inside a character
        for word in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"):  # a window never starts inside one
            if len(self.library.encode(word).ids) != 1:
                raise ValueError(f"{word} is not one token")

    def __reduce__(self):
        return _codec, (self.text,)

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text without special tokens, marked where pre-tokens start."""
        found = self.library.encode(text, add_special_tokens=False)
        ids, words = np.array(found.ids, np.int32), np.array(found.word_ids, np.int64)
        if len(ids):
            ids[np.append(True, words[1:] != words[:-1])] |= STARTS
        return ids

    def bytes_of(self, marked: np.ndarray) -> bytes:
        return b"".join(self.token.take(pa.array(marked & ~STARTS)).to_pylist())

    def segments(self, text: str) -> list[str | int]:
        """The text cut at special tokens: strings and ids in turn."""
        parts: list[str | int] = [text]
        for name in sorted(self.special, key=len, reverse=True):
            if name in text:
                parts = [piece for part in parts for piece in (_between(part, name, self.special[name]) if isinstance(part, str) else [part])]
        return parts

    def join(self, left: np.ndarray, right: np.ndarray, reach: int = 8) -> np.ndarray:
        """Marked ids of the joined text from those of its two parts."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        before, after = reach, reach
        while True:
            i, rest = self._window_start(left, before)
            j = self._window_end(right, after)
            window = self.plain((self.bytes_of(left[i:]) + self.bytes_of(right[:j])).decode())
            known = i == 0 or self._agrees_left(left, i, window)
            cut = (len(window), j) if j == len(right) else self._agrees_right(right, j, window, rest)
            if known and cut:
                return np.concatenate([left[:i], window[: cut[0]], right[cut[1] :]])
            before, after = before if known else 2 * before, after if cut else 2 * after

    def _window_start(self, left: np.ndarray, reach: int) -> tuple[int, int]:
        """First token of the window, at a whole character, and the bytes of the left text from there on."""
        ids = left & ~STARTS
        i = max(0, len(left) - reach)
        while i and self.follows[ids[i]]:
            i -= 1
        return i, int(self.size[ids[i:]].sum())

    def _window_end(self, right: np.ndarray, reach: int) -> int:
        j = min(len(right), reach)
        while j < len(right) and self.follows[right[j] & ~STARTS]:
            j += 1
        return j

    def _agrees_left(self, left: np.ndarray, i: int, window: np.ndarray) -> bool:
        sizes = self.size[left[i:] & ~STARTS]
        if left[i] & STARTS:
            return bool(sizes.sum() >= AHEAD)
        if len(sizes) < 2 or len(window) < 2 or sizes[1:].sum() < AHEAD:
            return False
        return bool((left[i] | STARTS) == window[0] and (left[i + 1] & STARTS) == (window[1] & STARTS))

    def _agrees_right(self, right: np.ndarray, j: int, window: np.ndarray, offset: int) -> tuple[int, int] | None:
        """Where window and right side say the same: a token of each."""
        own, other = np.cumsum(self.size[right[:j] & ~STARTS]), np.cumsum(self.size[window & ~STARTS])
        starts, seen = np.append(0, own[:-1]), np.append(0, other[:-1]) - offset
        _, here, there = np.intersect1d(starts, seen, assume_unique=True, return_indices=True)
        same = (starts[here] <= own[-1] - AHEAD) & ((right[here] & STARTS) == (window[there] & STARTS))
        same &= (right[here] & STARTS != 0) | (right[here] == window[there])
        found = np.flatnonzero(same)
        return (int(there[found[0]]), int(here[found[0]])) if len(found) else None

    def join_all(self, parts: list[np.ndarray]) -> np.ndarray:
        """Neighbours joined pairwise until one is left."""
        while len(parts) > 1:
            parts = [self.join(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0] if parts else np.zeros(0, np.int32)

    def whole(self, text: str) -> np.ndarray:
        """Marked ids of any text, in one piece."""
        parts = [np.array([p], np.int32) | STARTS if isinstance(p, int) else self.plain(p) for p in self.segments(text)]
        return np.concatenate(parts)

    def _remembered(self, parts: list[str | None]) -> list[bytes]:
        """Packed marked ids of stretches (None: no ids); each starts a pre-token wherever it stands."""
        out = [b"" if part is None else self.known.get(part) for part in parts]
        missing = [k for k, ids in enumerate(out) if ids is None]
        data = [parts[k].encode() for k in missing]
        marked = self.plain(b"".join(data).decode())
        ends = np.searchsorted(np.cumsum(self.size[marked & ~STARTS]), np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))) + 1
        packed = marked.tobytes()
        for k, a, b in zip(missing, [0, *ends.tolist()], ends.tolist()):
            out[k] = packed[4 * a : 4 * b]
            self.known.put(parts[k], out[k])
        return out

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text, and the marked ids of all texts, each in one piece.

        A pre-token starts at a space that follows anything but white space. So a stretch
        between two single spaces is encoded alike wherever it stands, if white space neither starts nor
        ends it: equal stretches of a batch are encoded once, with the space before them. The
        first stretch of a text has none; it is encoded after a line feed, which is a pre-token of its own.
        Texts with other runs of white space or with special tokens are encoded one by one.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(1, np.int64), np.zeros(0, np.int32)
        stretches = pc.split_pattern(texts, " ")
        starts = stretches.offsets.to_numpy() - stretches.offsets[0].as_py()
        coded = stretches.flatten().dictionary_encode()
        index, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        odd = np.fromiter((not d or d[0].isspace() or d[-1].isspace() for d in distinct), bool, len(distinct))
        apart = np.logical_or.reduceat(odd[index], starts[:-1])
        for name in self.special:
            apart |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        first, place = np.unique(index[starts[:-1]], return_inverse=True)
        index[starts[:-1]] = len(distinct) + place
        encoded = self._remembered([None if o else " " + d for d, o in zip(distinct, odd)] + [None if odd[i] else "\n" + distinct[i] for i in first])
        marked = np.frombuffer(b"".join(encoded), np.int32)
        ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded))) // 4
        begins = np.append(0, ends[:-1])
        begins[len(distinct) :] += ends[len(distinct) :] > begins[len(distinct) :]  # without the line feed
        taken = (ends - begins)[index]
        at = np.repeat(begins[index] - np.append(0, np.cumsum(taken)[:-1]), taken) + np.arange(taken.sum())
        offsets, out = np.append(0, np.cumsum(taken))[starts], marked[at]
        if apart.any():
            own = [self.whole(texts[i].as_py()) if apart[i] else out[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
            offsets, out = np.append(0, np.cumsum([len(o) for o in own])), np.concatenate(own)
        return offsets, out

    def data(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The bytes that the ids of each text stand for; unknown ids stand for none."""
        lists = pa.ListArray.from_arrays(offsets.astype(np.int32), self.token.take(pa.array(ids, pa.int32())))
        return pc.binary_join(lists, b"")

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """The text of each run of ids; what is no UTF-8 becomes replacement characters."""
        return [str(value.as_buffer() or b"", "utf-8", "replace") for value in self.data(offsets, ids)]


_codecs: dict[str, Codec] = {}


def _codec(text: str) -> Codec:
    """One codec per worker and file."""
    name = hashlib.sha256(text.encode()).hexdigest()
    if name not in _codecs:
        made = Codec.__new__(Codec)
        made._load(text)
        _codecs[name] = made
    return _codecs[name]


def _between(text: str, name: str, number: int) -> list[str | int]:
    out: list[str | int] = []
    for k, part in enumerate(text.split(name)):
        out += [number] * (k > 0) + [part] * bool(part)
    return out


def _halves(text: str, leaf: int) -> list[str]:
    """The text cut in halves, those in halves again, down to ``leaf`` code points."""
    pieces = 1
    while pieces * leaf < len(text):
        pieces *= 2
    return [text[len(text) * k // pieces : len(text) * (k + 1) // pieces] for k in range(pieces)]


Finish = Callable[[Codec, np.ndarray, np.ndarray], list[pa.Array]]


def _encoded(docs: DataFrame, path: str, key: str, text: str, leaf: int, finish: Finish, schema: str) -> DataFrame:
    """``doc_id`` and what ``finish`` makes of the ids of each text, in columns of ``schema``."""
    sent = docs.sparkSession.sparkContext.broadcast(Codec(path))  # a file of a few MB
    names = [column.split()[0] for column in schema.split(", ")]
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            offsets, ids = sent.value.encode_many(part.column(1))
            yield pa.record_batch([part.column(0), *finish(sent.value, offsets, ids & ~STARTS)], names=["doc_id", *names])

    brief = texts.where(F.length("text") <= leaf).mapInArrow(short, f"doc_id long, {schema}")
    long = texts.where(F.length("text") > leaf).select("doc_id", F.sha2("text", 256).alias("digest"), "text")
    owners = kept_table(long.select("doc_id", "digest", F.length("text").alias("size")), "long-texts")
    longest = owners.agg(F.max("size")).first()[0]
    if longest is None:
        return brief
    node = "digest string, segment int, place int, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for name, whole in zip(part.column("digest").to_pylist(), part.column("text").to_pylist()):
                for number, own in enumerate(sent.value.segments(whole)):
                    pieces = [None] if isinstance(own, int) else _halves(own, leaf)
                    ids = [np.int32(own).tobytes()] if isinstance(own, int) else [None] * len(pieces)
                    many = len(pieces)
                    yield pa.record_batch(
                        [pa.array([name] * many), pa.array([number] * many, pa.int32()), pa.array(range(many), pa.int32()), pa.array(ids, pa.binary()), pa.array(pieces, pa.string())],
                        names=["digest", "segment", "place", "ids", "piece"],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            offsets, marked = sent.value.encode_many(part.column("piece"))
            ids = [marked[a:b].tobytes() if known is None else known for known, a, b in zip(part.column("ids").to_pylist(), offsets, offsets[1:])]
            yield pa.record_batch([*part.columns[:3], pa.array(ids, pa.binary())], names=["digest", "segment", "place", "ids"])

    def groups(batches: Iterator[pa.RecordBatch], same: Callable) -> Iterator[tuple[tuple, list[np.ndarray]]]:
        """Rows come sorted; runs that are the ``same``, one of them in memory at a time."""
        at, parts = None, []
        for batch in batches:
            for *row, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if same(*row) != at:
                    if parts:
                        yield at, parts
                    at, parts = same(*row), []
                parts.append(np.frombuffer(ids, np.int32))
        if parts:
            yield at, parts

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, segment, place), parts in groups(batches, lambda name, segment, place: (name, segment, place // FAN_IN)):
            row = [pa.array([name]), pa.array([segment], pa.int32()), pa.array([place], pa.int32()), pa.array([sent.value.join_all(parts).tobytes()], pa.binary())]
            yield pa.record_batch(row, names=["digest", "segment", "place", "ids"])

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last joins of each segment, and the segments of a text one after the other."""
        whole: tuple[str, list[np.ndarray]] | None = None

        def done(name: str, parts: list[np.ndarray]) -> pa.RecordBatch:
            ids = np.concatenate(parts) & ~STARTS
            return pa.record_batch([pa.array([name]), *finish(sent.value, np.array([0, len(ids)]), ids)], names=["of_digest", *names])

        for (name, _), parts in groups(batches, lambda name, segment, place: (name, segment)):
            if whole and whole[0] != name:
                yield done(*whole)
                whole = None
            whole = whole or (name, [])
            whole[1].append(sent.value.join_all(parts))
        if whole:
            yield done(*whole)

    # Equal pieces of equal texts meet in the shuffle that deals them out; one of them goes on.
    pieces = long.select("digest", "text").mapInArrow(cut, f"{node}, piece string").dropDuplicates(["digest", "segment", "place"])
    nodes, most = pieces.mapInArrow(encode, node), 1
    while most * leaf < longest:
        most *= 2
    while most > FAN_IN:
        nodes = nodes.repartition("digest", "segment", F.floor(F.col("place") / FAN_IN)).sortWithinPartitions("digest", "segment", "place")
        nodes, most = kept_table(nodes.mapInArrow(joined, node), "nodes"), -(-most // FAN_IN)
    roots = nodes.repartition("digest").sortWithinPartitions("digest", "segment", "place").mapInArrow(rooted, f"of_digest string, {schema}")
    return brief.unionByName(owners.join(roots, F.col("digest") == F.col("of_digest")).select("doc_id", *names))


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", leaf: int = 16384) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text."""

    def finish(codec: Codec, offsets: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids, pa.int32()))]

    return _encoded(docs, path, key, text, leaf, finish, "ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``; null ids are an empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(Codec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy()
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            texts = sent.value.decode(np.append(0, np.cumsum(sizes)), flat)
            yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def token_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", leaf: int = 16384) -> DataFrame:
    """Counts and digests of the ids (little-endian 32-bit) and of the text decoded from them."""

    def finish(codec: Codec, offsets: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        own = ids.astype("<u4")
        of_ids = [hashlib.sha256(own[a:b].tobytes()).hexdigest() for a, b in zip(offsets, offsets[1:])]
        of_text = [hashlib.sha256(t.encode()).hexdigest() for t in codec.decode(offsets, ids)]
        return [pa.array(np.diff(offsets), pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    return _encoded(docs, path, key, text, leaf, finish, "n_tokens long, ids_sha256 string, decoded_sha256 string")
