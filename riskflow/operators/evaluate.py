"""Model and threshold metrics from scored, labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.operators.ordered import running_over_values

THRESHOLDS = tuple(step / 20 for step in range(1, 20))


def _ratio(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom, F.lit(0))


def threshold_metrics(
    scored: DataFrame,
    score: str = "risk_score",
    label: str = "is_fraud",
    thresholds: Sequence[float] = THRESHOLDS,
    fraud_cost: float = 500.0,
    false_decline_cost: float = 5.0,
) -> DataFrame:
    """Confusion counts, rates and expected cost per threshold, in one aggregation pass.

    Rows are first counted per score band, so the thresholds cost no extra pass and the
    second step only sees one row per band.
    """
    cuts = sorted(thresholds)
    band = sum((F.col(score) >= cut).cast("int") for cut in cuts[1:]) + (
        F.col(score) >= cuts[0]
    ).cast("int")
    labelled = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = labelled.groupBy(band.alias("band")).agg(
        F.count_if(F.col(label).cast("boolean")).alias("frauds"),
        F.count_if(~F.col(label).cast("boolean")).alias("others"),
    )
    table = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(cut).alias("threshold"),
                        (F.col("band") > at).alias("flagged"),
                        F.col("frauds"),
                        F.col("others"),
                    )
                    for at, cut in enumerate(cuts)
                ]
            )
        )
    )
    flagged = F.col("flagged")
    sums = table.groupBy("threshold").agg(
        F.sum(F.when(flagged, F.col("frauds")).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, F.col("others")).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, 0).otherwise(F.col("frauds"))).alias("fn"),
        F.sum(F.when(flagged, 0).otherwise(F.col("others"))).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    return sums.select(
        "*",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        _ratio(fp, fp + tn).alias("false_positive_rate"),
        _ratio(fn, fn + tp).alias("false_negative_rate"),
        (fn * F.lit(fraud_cost) + fp * F.lit(false_decline_cost)).alias("expected_cost"),
    )


def best_threshold(metrics: DataFrame) -> DataFrame:
    """The threshold of lowest expected cost (the lower threshold on a tie)."""
    return metrics.orderBy("expected_cost", "threshold").limit(1)


def curve_areas(scored: DataFrame, score: str = "risk_score", label: str = "is_fraud") -> DataFrame:
    """Exact ROC-AUC and average precision; equal scores count as ties."""
    positive = F.col(label).cast("boolean")
    points = (
        scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy((-F.col(score).cast("double")).alias("value"))
        .agg(F.count_if(positive).alias("frauds"), F.count_if(~positive).alias("others"))
    )
    curve = running_over_values(points, {"frauds": "tp", "others": "fp"})
    frauds, others = F.sum("frauds"), F.sum("others")
    # Each band of others ranks below the frauds above it and ties with half of its own.
    wins = F.sum(F.col("others") * (F.col("tp") - F.col("frauds") / 2))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return curve.agg(
        frauds.alias("frauds"),
        others.alias("others"),
        (wins / F.nullif(frauds * others, F.lit(0))).alias("roc_auc"),
        (F.sum(F.col("frauds") * precision) / F.nullif(frauds, F.lit(0))).alias("pr_auc"),
    )
