"""Data-quality report and drift measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.operators.ordered import running_over_values

from riskflow.contract import ALLOWED_VALUES


def quality_report(events: DataFrame, now: Column, future_slack: str = "5 minutes") -> DataFrame:
    """``(check_name, failed, total)`` of every transaction-level check.

    The row checks are one aggregation over the table; uniqueness counts ids first, with a
    map-side partial count, so repeated ids do not gather anywhere.
    """
    bad = {
        "transaction_id_not_null": F.col("transaction_id").isNull(),
        "account_id_not_null": F.col("account_id").isNull(),
        "amount_positive": ~F.coalesce(F.col("amount") > 0, F.lit(False)),
        "currency_allowed": ~F.coalesce(
            F.col("currency").isin(*ALLOWED_VALUES["currency"]), F.lit(False)
        ),
        "coordinates_valid": ~F.coalesce(
            F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180),
            F.lit(False),
        ),
        "event_time_not_in_future": ~F.coalesce(
            F.col("event_timestamp") <= now + F.expr(f"interval {future_slack}"), F.lit(False)
        ),
    }
    one_row = events.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(test).alias(name) for name, test in bad.items()]
    )
    row_checks = one_row.select(
        "total",
        F.inline(
            F.array(
                *[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failed")) for name in bad]
            )
        ),
    )
    copies = events.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("copies"))
    unique = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"),
        F.lit("transaction_id_unique").alias("check_name"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("failed"),
    )
    return row_checks.unionByName(unique).select("check_name", "failed", "total")


def pipeline_report(
    validated: DataFrame,
    scores: DataFrame,
    score: str = "risk_score",
    volume: tuple[int, int] = (1, 10**15),
    max_dlq_ratio: float = 0.05,
) -> DataFrame:
    """``(check_name, measured, passed)``: volume range, dead-letter ratio, score bounds."""
    flow = validated.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        (F.count_if(~F.col("is_valid")) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("dlq"),
    ).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("volume_in_range").alias("check_name"),
                    F.col("rows").alias("measured"),
                    F.col("rows").between(*volume).alias("passed"),
                ),
                F.struct(
                    F.lit("dlq_ratio").alias("check_name"),
                    F.col("dlq").alias("measured"),
                    (F.col("dlq") <= max_dlq_ratio).alias("passed"),
                ),
            )
        )
    )
    outside = F.count_if(~F.coalesce(F.col(score).between(0, 1), F.lit(False))).cast("double")
    bounds = scores.agg(
        F.lit("score_in_bounds").alias("check_name"),
        outside.alias("measured"),
        (outside == 0).alias("passed"),
    )
    return flow.unionByName(bounds)


def _shares(reference: DataFrame, current: DataFrame, bin_of: Column) -> DataFrame:
    """Rows per bin on both sides, with their totals; one row per bin."""
    both = reference.select(bin_of.alias("bin"), F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        current.select(bin_of.alias("bin"), F.lit(0).alias("old"), F.lit(1).alias("new"))
    )
    bins = both.groupBy("bin").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    everything = W.partitionBy()
    return bins.withColumns(
        {
            "old_total": F.sum("old").over(everything),
            "new_total": F.sum("new").over(everything),
            "bin_count": F.count(F.lit(1)).over(everything),
        }
    )


def amount_bin(cuts: Sequence[float], column: str = "amount") -> Column:
    """Index of the half-open bin ``[cut_i, cut_i+1)`` a value falls into; NULL has its own bin."""
    value = F.col(column).cast("double")
    index = sum(((value >= cut).cast("int") for cut in sorted(cuts)), F.lit(0))
    return F.coalesce(index, F.lit(-1))


def population_stability(
    reference: DataFrame, current: DataFrame, bin_of: Column, feature: str
) -> DataFrame:
    """PSI over bins: sum of ``(q - p) * ln(q / p)``, counts smoothed by one half.

    Only for a bounded set of bins (value ranges, categories), as the totals pass over the
    bins runs in one task.
    """
    spread = F.lit(0.5) * F.col("bin_count")
    p = (F.col("old") + 0.5) / (F.col("old_total") + spread)
    q = (F.col("new") + 0.5) / (F.col("new_total") + spread)
    return _shares(reference, current, bin_of).agg(
        F.lit(feature).alias("feature"),
        F.count(F.lit(1)).alias("bins"),
        F.sum((q - p) * F.log(q / p)).alias("psi"),
    )


def kolmogorov_smirnov(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Largest gap between the two cumulative shares over all distinct values; NULLs take no part."""
    value = F.col(column).cast("double").alias("value")
    both = reference.select(value, F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        current.select(value, F.lit(0).alias("old"), F.lit(1).alias("new"))
    )
    points = both.where(F.col("value").isNotNull()).groupBy("value").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    upto = running_over_values(points, {"old": "old_upto", "new": "new_upto"})
    totals = upto.agg(F.sum("old").alias("old_total"), F.sum("new").alias("new_total"))
    gap = F.abs(
        F.col("old_upto") / F.nullif(F.col("old_total"), F.lit(0))
        - F.col("new_upto") / F.nullif(F.col("new_total"), F.lit(0))
    )
    return (
        upto.crossJoin(F.broadcast(totals))  # one row
        .select(gap.alias("gap"))
        .agg(F.lit(column).alias("feature"), F.max("gap").alias("ks"))
    )
