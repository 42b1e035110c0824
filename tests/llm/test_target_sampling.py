"""Importance resampling against a plain version, and the selection against a sort."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskflow.llm import target_sampling as T
from tests.llm.test_operators import edge_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, longest):
    words = WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain_resample(rows, target, longest=1, least_words=20, percent=10):
    corpus, wanted = Counter(), Counter()
    for _, text in rows:
        corpus.update(plain_features(text, longest)[1])
    for text in target:
        wanted.update(plain_features(text, longest)[1])
    s_all, t_all, out = sum(corpus.values()), sum(wanted.values()), []
    for key, text in rows:
        words, found = plain_features(text, longest)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((corpus[b] + 1) * (t_all + 10000)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for place, row in enumerate(able[: len(able) * percent // 100]):
        row[5] = place + 1
    return sorted(map(tuple, out), key=str)


def found(frame):
    rows = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in frame.collect()]
    return sorted(rows, key=str)


def test_feature_buckets():
    texts = ["", None, "Don't STOP x1 \x00 Ünï 漢字É\n42", "...", "a", "b a b a b", "z" * 5000, " lead and trail "]
    for longest in (1, 3):
        owner, bucket, words = T.feature_buckets(pa.array(texts).slice(0), longest, 10_000)
        for i, text in enumerate(texts):
            many, own = plain_features(text, longest)
            assert many == words[i] and sorted(own) == sorted(bucket[owner == i].tolist())
    owner, _, words = T.feature_buckets(pa.array(texts).slice(2, 3), 2, 10_000)  # a slice of a longer array
    assert words.tolist() == [plain_features(t, 1)[0] for t in texts[2:5]]
    assert len(T.feature_buckets(pa.array([], pa.string()), 2, 10)[0]) == 0


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(400)]
    return rows + [(7, rows[7][1])] * 30 + [(None, rows[9][1]), (None, None), (401, ""), (9, "other text " * 15)]


@pytest.mark.parametrize("longest, least_words, percent", [(1, 20, 10), (2, 5, 37), (1, 0, 100), (1, 1000, 50)])
def test_resample(spark, corpus, longest, least_words, percent):
    target = ["w1 w2 w3 w4 w5", None, "", "w6 " * 9]
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(7)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    options = {"longest": longest, "least_words": least_words, "percent": percent}
    assert found(T.resample(docs, bench, **options)) == plain_resample(corpus, target, **options)
    kept = T.drawn_documents(docs, bench, **options).collect()
    ranks = [r[5] for r in plain_resample(corpus, target, **options) if r[5]]
    assert sorted(r.rank for r in kept) == sorted(ranks)
    by_rank = {r[5]: r[0] for r in plain_resample(corpus, target, **options)}
    assert all(by_rank[r.rank] == r.row.doc_id for r in kept)


def test_resample_edges(spark):
    edges = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    none = spark.createDataFrame([], "text string")
    options = {"least_words": 1, "percent": 60}
    assert found(T.resample(edges, none, **options)) == plain_resample(rows, [], **options)
    kept = T.drawn_documents(edges, none, **options)
    assert kept.select("row.*").columns == edges.columns and kept.count() == sum(r[5] is not None for r in plain_resample(rows, [], **options))
    assert T.resample(edges.limit(0), none).count() == 0


def test_cutoff(spark):
    """Every place of an order with many ties, cut into uneven partitions."""
    rng = np.random.default_rng(5)
    rows = [(int(k) if k else None, int(s)) for k, s in zip(rng.integers(0, 40, 500), rng.integers(-6, 6, 500))]
    ordered = sorted((-s, k is None, k or 0) for k, s in rows)
    scored = spark.createDataFrame(rows, "doc_id long, score long").repartitionByRange(5, "score")
    for wanted in (1, 2, 77, 250, 499, 500):
        assert tuple(map(int, T.cutoff_key(scored, wanted, base=3))) == tuple(map(int, ordered[wanted - 1]))
