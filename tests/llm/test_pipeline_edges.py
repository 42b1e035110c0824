"""Every pipeline stage on nulls, empty and long texts, repeated ids, clashing and dotted columns, and no rows."""

from __future__ import annotations

import collections

import pytest

import corpus_pipeline
from tests.llm.test_operators import edge_docs, plain_components
from tests.llm.test_operators import docs as plain_docs

FOLDER = "/root/testdata/sf0.001"


def dotted(spark):
    return edge_docs(spark).selectExpr("*", "'x' as `a.b`", "1 as number", "2 as known", "'r' as place")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, name, stage):
    frame = dotted(spark)
    out = stage(spark, frame, FOLDER)
    if name != "tokens":
        assert out.columns == frame.columns
    assert stage(spark, frame.limit(0), FOLDER).count() == 0
    rows = collections.Counter((r["doc_id"], r["text"]) if name != "tokens" else r["doc_id"] for r in out.collect())
    given = {r.doc_id: r.text for r in frame.collect()}
    if name == "language":  # labels with too few texts to learn from: only texts without a letter go
        assert rows == {(3, given[3]): 1, (4, given[4]): 2, (None, given[None]): 1}
    elif name == "shared_lines":  # rows of one id are one document; the null id comes after all others
        assert rows == {(1, ""): 1, (2, ""): 1, (3, given[3]): 1, (4, given[4]): 2, (None, ""): 1}
    elif name == "near_duplicates":
        assert rows == {(1, None): 1, (2, ""): 1, (3, given[3]): 1, (4, given[4]): 1, (None, given[None]): 1}
    elif name == "mixed":
        assert all(given[i] == t and t for i, t in rows)
    else:
        assert rows == {1: 1, 2: 1, 3: 1, 4: 2, None: 1}


def test_different_texts_of_one_id_stay(spark):
    text = {name: " ".join(f"{name}{k}" for k in range(60)) for name in "abc"}
    rows = [(5, text["a"]), (5, text["b"]), (1, text["a"]), (2, text["b"] + " more"), (5, text["c"]), (9, text["c"]), (5, text["c"])]
    kept = corpus_pipeline.near_duplicates(spark, plain_docs(spark, *rows), FOLDER).collect()
    assert sorted((r.doc_id, r.text[0]) for r in kept) == [(1, "a"), (2, "b"), (5, "c")]
    single = [(1, text["a"]), (2, text["b"]), (3, text["a"]), (4, text["b"] + " more")]
    kept = corpus_pipeline.near_duplicates(spark, plain_docs(spark, *single), FOLDER).collect()
    assert {r.doc_id for r in kept} == {root for _, root in plain_components(single, 5, 80).values()}


def test_rare_labels_stay(spark):
    rows = [(1, "three good rows of plain text", "en", "a", 1), (2, "and nothing to learn from", "en", "a", 1), (3, "ein Satz auf Deutsch", "de", "a", 1), (4, "1234 !", "en", "a", 1), (5, "no label here", None, "a", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.language(spark, frame, FOLDER).collect()} == {1, 2, 3, 5}
