"""Silver and Gold tables: layout, batch writes, read-back and checks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.contract import GOLD_COLUMNS, GOLD_PARTITIONS, SILVER_COLUMNS, SILVER_PARTITIONS, transaction_schema

# Exit codes of the readiness gate.
SILVER_MISSING_CODE = 2
GOLD_MISSING_CODE = 3


def silver_transactions(events: DataFrame) -> DataFrame:
    """Contract columns plus event date and hour, in table order."""
    at = F.col("event_timestamp")
    return events.withColumns({"event_date": F.to_date(at), "event_hour": F.hour(at)}).select(
        *SILVER_COLUMNS
    )


def silver_schema() -> T.StructType:
    """The schema of the Silver table, known before it has any files."""
    partitions = [T.StructField("event_date", T.DateType()), T.StructField("event_hour", T.IntegerType())]
    return T.StructType([*transaction_schema().fields, *partitions])


def gold_account_features(features: DataFrame) -> DataFrame:
    """Window features plus the date of the window start, in table order."""
    return features.withColumn("window_date", F.to_date("window_start")).select(*GOLD_COLUMNS)


def write_table(
    table: DataFrame, path: str, partitions: tuple[str, ...], mode: str = "overwrite"
) -> None:
    """Partitioned Parquet. Rows are gathered by partition value first, to avoid a small file
    per task; the rebalance hint lets Spark split a partition value that is too large."""
    (
        table.hint("rebalance", *[F.col(name) for name in partitions])
        .write.mode(mode)
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_silver(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_table(silver_transactions(events), path, SILVER_PARTITIONS, mode)


def write_gold(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_table(gold_account_features(features), path, GOLD_PARTITIONS, mode)


def write_bronze(records: DataFrame, path: str, mode: str = "append") -> None:
    """Untouched records with their log coordinates, partitioned by hour of arrival.

    Needs a ``timestamp`` column: the log's record time, as its source provides it.
    """
    at = F.col("timestamp")
    table = records.withColumns({"arrival_date": F.to_date(at), "arrival_hour": F.hour(at)})
    write_table(table, path, ("arrival_date", "arrival_hour"), mode)


def replay(
    spark: SparkSession,
    bronze_path: str,
    start: str | None = None,
    end: str | None = None,
    account_id: str | None = None,
) -> DataFrame:
    """Bronze records of a time range and account, ready for validation again.

    ``start`` is inclusive, ``end`` exclusive (UTC text). Both also restrict the date partitions, and on the
    first and last date the hours, so only those folders are listed and read.
    """
    records = spark.read.parquet(bronze_path)
    day, hour = F.col("arrival_date"), F.col("arrival_hour")
    if start is not None:
        since = F.lit(start).cast("timestamp")
        first = F.to_date(since)
        records = records.where(F.col("timestamp") >= since).where((day > first) | ((day == first) & (hour >= F.hour(since))))
    if end is not None:
        until = F.lit(end).cast("timestamp")
        last = F.to_date(until)
        records = records.where(F.col("timestamp") < until).where((day < last) | ((day == last) & (hour <= F.hour(until))))
    if account_id is not None:
        records = records.where(F.col("key") == F.lit(account_id).cast("binary"))
    return records


def read_layer(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None while nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        # A folder without data files has no schema to infer.
        if problem.getCondition() == "PATH_NOT_FOUND" or "infer schema" in str(problem):
            return None
        raise


def _summary(spark: SparkSession, layer: str, path: str, time: str) -> DataFrame:
    table = read_layer(spark, path)
    if table is None:
        return spark.range(1).select(
            F.lit(layer).alias("layer"),
            F.lit(False).alias("has_files"),
            F.lit(0).cast("bigint").alias("row_count"),
            F.lit(None).cast("timestamp").alias("first_time"),
            F.lit(None).cast("timestamp").alias("last_time"),
        )
    return table.agg(
        F.lit(layer).alias("layer"),
        F.lit(True).alias("has_files"),
        F.count(F.lit(1)).alias("row_count"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    ).select("layer", "has_files", "row_count", "first_time", "last_time")


def lake_summary(
    spark: SparkSession, silver_path: str, gold_path: str, require_gold: bool = False
) -> DataFrame:
    """One row per layer: files present, rows, time range, and the readiness gate.

    ``gate_code`` is 0 when the layer is ready; Silver must have rows, Gold only if required.
    """
    layers = _summary(spark, "silver", silver_path, "event_timestamp").unionByName(
        _summary(spark, "gold", gold_path, "window_start")
    )
    empty = F.col("row_count") == 0
    code = (
        F.when((F.col("layer") == "silver") & empty, SILVER_MISSING_CODE)
        .when((F.col("layer") == "gold") & empty & F.lit(require_gold), GOLD_MISSING_CODE)
        .otherwise(0)
    )
    return layers.withColumn("gate_code", code)


def preview(table: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at."""
    return table.limit(n)
