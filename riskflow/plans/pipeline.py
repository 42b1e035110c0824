"""The whole batch path: raw records -> Silver, Gold and dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.parse import deduplicate
from riskflow.operators.validate import dead_letters, valid_events, validate_events
from riskflow.operators.windows import account_window_features
from riskflow.plans.lake import write_gold, write_silver
from riskflow.session import drop_folder, shared_folder
from riskflow.settings import FeatureSettings


@dataclass(frozen=True)
class Layers:
    silver: DataFrame
    gold: DataFrame
    dead_letters: DataFrame


def refine(records: DataFrame, settings: FeatureSettings = FeatureSettings()) -> Layers:
    """Lazy layers of a set of raw records."""
    validated = validate_events(records)
    events = deduplicate(valid_events(validated))
    return Layers(events, account_window_features(events, settings), dead_letters(validated))


def build_lake(
    spark: SparkSession,
    records: DataFrame,
    silver_path: str,
    gold_path: str,
    dlq_path: str,
    settings: FeatureSettings = FeatureSettings(),
) -> None:
    """Write all layers, checking every record once.

    The checked records are written first, split by outcome; Silver and the dead letters read
    their part of them, and Gold reads Silver. A lost executor costs re-reading files, never
    another pass over the raw records.
    """
    checked_path = shared_folder(spark, "checked")
    checked = validate_events(records).drop("body")
    checked.write.partitionBy("is_valid").parquet(checked_path)
    # The schema is given, since a Boolean partition value would be read back as text.
    checked = spark.read.schema(checked.schema).parquet(checked_path)
    write_silver(deduplicate(valid_events(checked)), silver_path)
    write_gold(account_window_features(spark.read.parquet(silver_path), settings), gold_path)
    dead_letters(checked).write.mode("overwrite").parquet(dlq_path)
    drop_folder(spark, checked_path)


def upsert(existing: DataFrame, updates: DataFrame, key: str = "transaction_id") -> DataFrame:
    """``existing`` with ``updates`` merged in: the update wins, one row per key.

    Repeated updates of one key keep the latest ``processed_at``; running the same batch
    twice changes nothing. The choice is a map-side maximum, so no key can flood a task.
    """
    names = existing.columns
    both = existing.select(*names, F.lit(0).alias("rank")).unionByName(
        updates.select(*names, F.lit(1).alias("rank"))
    )
    order = F.struct("rank", "processed_at", *[n for n in names if n != "processed_at"])
    return (
        both.groupBy(key)
        .agg(F.max(order).alias("kept"))
        .select(*[F.col(key) if n == key else F.col(f"kept.{n}").alias(n) for n in names])
    )
