"""Tree concatenation against the tokenizer library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from riskflow.llm import tree_bpe as B
from tests.llm.test_operators import edge_docs

FILE = public_tokenizers.path("byte_bpe_50k.json")
POOLS = ["ab  \n\t\x1c é中1٣!'s’漢ñ😀\x00", "a", " ", " \n", "'rellsvedm ", "0123456789", "中文字漢😀", "the of and re ll ve s't'd\n  ", "=-_"]
WORDS = "the quick don't we're they'll I'd  <|endoftext|> 1234567 !!! ''' \n\n ====== aaaaaaaaaaaa résumé 漢字かな हिन्दी".split(" ")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def codec():
    return B.Codec(FILE)


def made_texts(number, seed):
    rng = random.Random(seed)
    for _ in range(number):
        if rng.random() < 0.5:
            pool = rng.choice(POOLS)
            yield "".join(rng.choice(pool) for _ in range(rng.randrange(120)))
        else:
            yield "".join(rng.choice(WORDS) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(40)))


def test_joins_are_exact(codec, library):
    """Pieces of one to forty characters, cut anywhere, joined with the smallest windows."""
    rng = random.Random(4)
    for text in made_texts(1500, 3):
        got = []
        for segment in codec.segments(text):
            if isinstance(segment, int):
                got.append(segment)
                continue
            pieces = B._halves(segment, rng.choice([1, 2, 3, 8, 40]))
            assert "".join(pieces) == segment
            parts = [codec.plain(p) for p in pieces]
            while len(parts) > 1:
                parts = [codec.join(*parts[k : k + 2], reach=1) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
            got += (parts[0] & ~B.STARTS).tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text


def test_windows_stay_small(codec, monkeypatch):
    """A join of ordinary text re-encodes a few tokens, not its sides."""
    left, right = codec.plain("some ordinary words of a text " * 500), codec.plain("nd it goes on like that " * 500)
    seen = []
    plain = codec.plain
    monkeypatch.setattr(codec, "plain", lambda text: seen.append(len(text)) or plain(text))
    codec.join(left, right)
    assert len(seen) == 1 and seen[0] < 200


def test_decode_equals_library(codec, library):
    rng = np.random.default_rng(2)
    runs = [rng.integers(0, 50257, rng.integers(0, 30)).astype(np.int32) for _ in range(300)]  # mostly no UTF-8
    offsets = np.append(0, np.cumsum([len(r) for r in runs]))
    assert codec.decode(offsets, np.concatenate(runs)) == [library.decode(r.tolist(), skip_special_tokens=False) for r in runs]


def expected(rows, library):
    out = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def digests(frame):
    return sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in frame.collect()), key=str)


def test_token_digests(spark, library):
    """Short and long texts, copies of a long one, one long pre-token, special tokens, null and empty."""
    texts = [*made_texts(60, 9), "a" * 3000, "wordwithoutend" * 400 + "!", " " * 1500 + "x", "<|endoftext|>" * 90, "中文" * 900, None, "", "an ordinary text of words " * 300]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900 + i, texts[-1]) for i in range(20)] + [(3, texts[3]), (None, texts[62]), (62, texts[62])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(B.token_digests(docs, FILE, leaf=20)) == expected(rows, library)  # three levels of joins
    assert digests(B.token_digests(docs, FILE)) == expected(rows, library)


def test_round_trip_and_edges(spark, library):
    edges = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    for leaf in (1000, 1 << 20):
        assert digests(B.token_digests(edges, FILE, leaf=leaf)) == expected(rows, library)
        decoded = B.decode_documents(B.encode_documents(edges, FILE, leaf=leaf), FILE).collect()
        assert sorted((r.text for r in decoded)) == sorted(t or "" for _, t in rows)
    assert B.token_digests(edges.limit(0), FILE).count() == 0


def test_query_equals_library(spark, library):
    from riskflow.llm.catalog import catalog

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert digests(catalog()["op12_tree_bpe"](spark, folder)) == expected(rows, library)


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        B.Codec(public_tokenizers.path("word_bpe_49k.json"))
