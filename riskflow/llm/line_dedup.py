"""Line dedup: lines that several documents share stay in one of them only.

Normalised lines are exploded and hashed (128 bits); documents are counted per hash with
map-side aggregation, and the lines over the threshold are dropped by position. Only hashes
and positions are shuffled for that; each text moves once, when its lines are reassembled.

* null or empty text: one empty line; null ``doc_id``: one document after all others;
* rows that repeat a ``doc_id`` are one document: their common lines are not shared lines;
* a line held by any share of all rows is one row per task before the shuffle, and the join
  that finds its positions is a plain equi-join on two fresh exchanges, which adaptive
  execution splits when one hash is hot;
* an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import WHITE, kept_table, lower_ascii, packed

LAST = (1 << 63) - 1


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``row`` (the input row), ``kept`` (text left), ``n_lines`` and ``n_dropped`` per input row.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all
    their lines except in the smallest document that holds them.
    """
    body = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    base = (
        packed(docs)
        .withColumn("doc", F.coalesce(F.col(f"row.{key}").cast("long"), F.lit(LAST)))
        .withColumn("mark", F.xxhash64(body))
    )
    lines = (
        base.select("doc", "mark", F.posexplode(F.split(lower_ascii(body), "\n", -1)).alias("pos", "line"))
        .select("doc", "mark", "pos", F.trim(F.col("line"), F.lit(WHITE)).alias("line"))
        .where(F.length("line") >= min_chars)
        .select("doc", "mark", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))
    )
    per_hash = lines.groupBy("h1", "h2")
    if min_docs == 2:
        shared = per_hash.agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner < last")
    else:
        shared = per_hash.agg(F.min("doc").alias("owner"), F.count_distinct("doc").alias("found")).where(F.col("found") >= min_docs)
    shared = kept_table(shared.select("h1", "h2", "owner"), "shared-lines")
    cuts = lines.join(shared, ["h1", "h2"]).where("doc > owner").groupBy("doc", "mark").agg(F.array_sort(F.collect_set("pos")).alias("cut"))
    return (
        base.join(cuts, ["doc", "mark"], "left")
        .withColumn("lines", F.split(body, "\n", -1))
        .withColumn("n_lines", F.size("lines").cast("long"))
        # Lines between two dropped positions stay: slices, so that the work is linear in the text.
        .withColumn("ends", F.concat(F.array(F.lit(-1)), "cut", F.array(F.size("lines"))))
        .select(
            "row",
            F.when(
                F.col("cut").isNotNull(),
                F.array_join(
                    F.expr("flatten(transform(sequence(1, size(ends) - 1), k -> slice(lines, ends[k - 1] + 2, ends[k] - ends[k - 1] - 1)))"), "\n"
                ),
            )
            .otherwise(body)
            .alias("kept"),
            "n_lines",
            F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
