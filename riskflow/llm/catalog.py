"""Registered queries of the training-text operators: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import byte_bpe, dialogue_repair, html_tree, langid, line_dedup, mixing, parity_join, pii, quality_forest, stable_search, target_sampling, tree_bpe, warc
from riskflow.llm.common import kept_table, table

#: Stands for the secret that a real run reads from its own configuration.
SURROGATE_KEY = "surrogates"
TOKENS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MERGES = public_tokenizers.path("byte_bpe_50k.json")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), TOKENS, public_tokenizers.PATTERN)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, SURROGATE_KEY).select("row.doc_id", F.col("safe").alias("text"), "n_entities")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op5_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_tree.extract_text(pages, html_tree.learn(pages))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op7_language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept_out = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs, F.col("lang"), ~kept_out)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", langid.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op8_stable_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_search.nearest(table(spark, sf_dir, "embeddings"))


def op9_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = kept_table(quality_forest.text_counts(table(spark, sf_dir, "documents")), "text-counts")
    forest = quality_forest.fit_forest(counts, table(spark, sf_dir, "labels"))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")
    return quality_forest.judge(counts, forest).select(*columns)


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.token_digests(table(spark, sf_dir, "documents"), MERGES)


def op13_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = target_sampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_byte_bpe,
        op2_line_dedup,
        op3_surrogates,
        op4_warc,
        op5_html_tree,
        op6_mixing,
        op7_language_filter,
        op8_stable_search,
        op9_quality_forest,
        op10_parity_join,
        op11_dialogue_repair,
        op12_tree_bpe,
        op13_target_sampling,
    )
    return {query.__name__: query for query in found}


ORACLE = {
    "op2_line_dedup": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM docs),
        keyed AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        shared AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        marked AS (SELECT k.doc_id, k.pos, k.line, s.owner IS NOT NULL AND s.owner <> k.doc_id AS gone
                   FROM keyed k LEFT JOIN shared s ON k.key = s.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op13_target_sampling": r"""
        WITH table_of AS (SELECT list(c ORDER BY i) AS crcs FROM (
            SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
            FROM (SELECT unnest(range(256)) AS i))),
        words AS (SELECT 'd' AS part, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
                  UNION ALL
                  SELECT 'b', NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
        bytes AS (SELECT word, list_transform(range(length(hex(word)) // 2), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)) AS codes
                  FROM (SELECT DISTINCT word FROM words)),
        buckets AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, codes), lambda a, x: xor(a >> 8, crcs[(xor(a, x) & 255) + 1])),
                           4294967295) % 10000 AS bucket FROM bytes, table_of),
        features AS (SELECT part, doc_id, bucket FROM words JOIN buckets USING (word)),
        counts AS (SELECT bucket, count(*) FILTER (part = 'd') AS s, count(*) FILTER (part = 'b') AS t FROM features GROUP BY bucket),
        sums AS (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM counts),
        gains AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
                  FROM counts, sums),
        weights AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
                    FROM features JOIN gains USING (bucket) WHERE part = 'd' GROUP BY doc_id),
        noise AS (SELECT doc_id, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM documents),
        scored AS (SELECT n.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                          coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
                   FROM noise n LEFT JOIN weights USING (doc_id)),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
        FROM scored s LEFT JOIN ranked r USING (doc_id)""",
}
