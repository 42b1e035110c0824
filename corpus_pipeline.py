"""Training-text pipeline: language, shared lines, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last
return the columns of ``documents``; the last returns token ids. Empty inputs give empty results, and
null ids or texts are treated as the operators say.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import byte_bpe, langid, line_dedup, mixing, parity_join
from riskflow.llm.catalog import TOKENS
from riskflow.llm.common import kept_table, packed, prepare, table

#: Texts whose best language explains a smaller share of their n-grams are rejected.
LEAST_SCORE = 0.2
#: Labels with fewer texts teach too little to reject their own texts.
LEAST_TEXTS = 50
#: Near duplicates share this percentage of their shingles of so many words; op10_parity_join has its own figures.
SHINGLE_WORDS, LINKED_PERCENT = 5, 80


#: Without a language to learn, any letter will do.
LETTERS_ONLY = langid.LanguageFilter(("any",), np.full((1, 1), 1, np.uint64))


def quoted(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language; those without a letter or like no language go.

    Nobody can say that a text is not in the language of its own label if that label had fewer than
    ``LEAST_TEXTS`` texts to learn from, so such rows stay if they have a letter; so does every
    row if no label had more.
    """
    prepare(spark)
    model = langid.learn(docs, F.col("lang"), ~langid.held_out(F.col("doc_id")))
    names = [(name,) for name, many in zip(model.languages, model.texts) if many >= LEAST_TEXTS]
    taught = spark.createDataFrame(names, "known string")
    found = langid.identify(docs, model if names else LETTERS_ONLY)
    found = found.join(F.broadcast(taught), F.col("row.lang") == F.col("known"), "left")  # a row per language at most
    unjudged = F.col("known").isNull() & (F.col("row.lang").isNotNull() | F.lit(not names))
    return found.where((F.col("lang_pred") != "und") & ((F.col("score") >= LEAST_SCORE) | unjudged)).select("row.*")


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a smaller document holds too; ``n_chars`` follows the text."""
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return line_dedup.dedup_lines(docs).select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts: that with the smallest id. Null ids are never linked.

    Rows that repeat an id are documents of their own: equal ones are copies, different ones stay or go by
    their own texts.
    """
    prepare(spark)
    known = docs.where(F.col("doc_id").isNotNull())
    rest = docs.where(F.col("doc_id").isNull())
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("many")).where("many > 1")
    if not repeated.limit(1).count():
        classes = parity_join.jaccard_components(docs, n=SHINGLE_WORDS, percent=LINKED_PERCENT)
        gone = kept_table(classes.where("doc_id != component_id").select("doc_id"), "near-duplicates")
        return known.join(gone, "doc_id", "left_anti").select(*quoted(docs)).unionByName(rest)
    # Ids don't name rows here, so numbers do; they are written with the rows.
    rows = kept_table(packed(known, number=F.monotonically_increasing_id()), "numbered")
    texts = rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))
    classes = parity_join.jaccard_components(texts, n=SHINGLE_WORDS, percent=LINKED_PERCENT)
    named = classes.join(rows.select(F.col("number").alias("doc_id"), F.col("row.doc_id").alias("id")), "doc_id")
    first = named.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("first"))
    kept = kept_table(first.select(F.col("first.doc_id").alias("number")), "near-duplicates")
    return rows.join(kept, "number", "left_semi").select("row.*").unionByName(rest)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as often as its source's target takes it, shard by shard in the shuffled order of each."""
    prepare(spark)
    return mixing.mixed_documents(docs).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    prepare(spark)
    return byte_bpe.token_digests(docs, TOKENS, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language", language),
    ("shared_lines", shared_lines),
    ("near_duplicates", near_duplicates),
    ("mixed", mixed),
    ("tokens", tokens),
]

#: Sketches, trees and tokens have no SQL form; a test compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
