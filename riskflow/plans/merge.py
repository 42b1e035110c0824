"""Merging changes into a partitioned table without rewriting it.

Only partitions that hold a changed key, or will hold one, are read and written again. The others keep
their files. A row whose partition value changes leaves its old partition, and a partition that loses
its last row goes. Merging the same changes twice gives the same rows, so a stream may repeat a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskflow.plans.lake import read_layer
from riskflow.plans.pipeline import upsert
from riskflow.session import drop_folder, stored_table
from riskflow.streaming.queries import start_batches


def _any_of(values: list[tuple], names: Sequence[str]) -> Column:
    """Whether a row's partition is one of ``values``; plain comparisons, so that Spark prunes by them."""
    if len(names) == 1:
        known = F.col(names[0]).isin([v[0] for v in values if v[0] is not None])
        return known | F.col(names[0]).isNull() if (None,) in values else known
    each = [reduce(Column.__and__, [F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(names, value)]) for value in values]
    return reduce(Column.__or__, each, F.lit(False))


def _partitions(rows: DataFrame, names: Sequence[str]) -> list[tuple]:
    """Distinct partition values; as many as folders that the merge writes, far fewer than rows."""
    return sorted({tuple(row) for row in rows.select(*names).distinct().collect()}, key=str)


def merge_into(
    spark: SparkSession, path: str, updates: DataFrame, partitions: Sequence[str], key: str = "transaction_id"
) -> list[tuple]:
    """Upsert ``updates`` into the table at ``path``; returns the partitions that were touched.

    The table has ``key``, ``processed_at`` and the columns of ``updates``. The existing table is read in two
    ways: keys and partition values of all rows, to find where changed keys are, and whole rows of the
    touched partitions. The merged rows are written aside first, then over the touched partitions.
    """
    updates = stored_table(updates, "updates")
    existing = read_layer(spark, path)
    touched = set(_partitions(updates, partitions))
    if existing is None:
        merged = upsert(updates.limit(0), updates, key)
    else:
        existing = existing.select(*updates.columns)
        places = existing.select(key, *partitions).join(updates.select(key), key, "left_semi")
        touched |= set(_partitions(places, partitions))
        old = existing.where(_any_of(sorted(touched, key=str), partitions))
        merged = upsert(old, updates, key)
    if not touched:
        return []
    merged = stored_table(merged, "merged")
    left = set(_partitions(merged, partitions))
    (
        merged.hint("rebalance", *[F.col(name) for name in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    for value in touched - left:
        drop_folder(spark, "/".join([path.rstrip("/"), *_folders(partitions, value)]))
    return sorted(touched, key=str)


def _folders(names: Sequence[str], value: tuple) -> list[str]:
    """Folder names of a partition; only values that a folder name shows as they are."""
    found = ["__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in value]
    if any(not all(c.isalnum() or c in "-_. " for c in text) for text in found):
        raise ValueError(f"no plain folder name for {value}")
    return [f"{n}={text}" for n, text in zip(names, found)]


def start_merge(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    partitions: Sequence[str],
    name: str = "merge",
    key: str = "transaction_id",
    trigger_seconds: int | None = 5,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge every micro-batch of a stream of changes.

    A batch that is repeated after a failure merges the same rows again and changes nothing. ``prepare``
    turns the rows of a batch into those to merge, for example decided rows into alerts.
    """

    def merge(rows: DataFrame, batch_id: int) -> None:
        merge_into(rows.sparkSession, path, prepare(rows) if prepare else rows, partitions, key)

    return start_batches(changes, merge, name, checkpoint, trigger_seconds)
