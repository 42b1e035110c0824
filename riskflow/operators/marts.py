"""Gold marts: daily and per-entity summaries. All are one partial-then-final aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.rules import BLOCK, REVIEW


def _total() -> Column:
    return F.sum("amount").alias("amount_sum")


def daily_merchant_summary(events: DataFrame) -> DataFrame:
    """Per day and merchant: transactions, value, largest ticket and distinct accounts."""
    return events.groupBy(F.to_date("event_timestamp").alias("event_date"), "merchant_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        _total(),
        F.max("amount").alias("amount_max"),
        F.count_distinct("account_id").alias("unique_accounts"),
    )


def daily_volume(events: DataFrame) -> DataFrame:
    """Transactions and value per day."""
    return events.groupBy(F.to_date("event_timestamp").alias("event_date")).agg(
        F.count(F.lit(1)).alias("txn_count"), _total()
    )


def fraud_rate_by(events: DataFrame, column: str) -> DataFrame:
    """Share of known labels that are fraud, per value of ``column``."""
    labelled = F.count("is_fraud")
    return events.groupBy(column).agg(
        F.count(F.lit(1)).alias("txn_count"),
        labelled.alias("labelled_count"),
        (F.count_if(F.col("is_fraud")) / F.nullif(labelled, F.lit(0))).alias("fraud_rate"),
    )


def score_by_channel(decided: DataFrame) -> DataFrame:
    """Mean risk score and decision counts per channel."""
    return decided.groupBy("channel").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.count_if(F.col("decision") == REVIEW).alias("reviewed"),
        F.count_if(F.col("decision") == BLOCK).alias("blocked"),
    )


def account_risk_summary(decided: DataFrame) -> DataFrame:
    """Per account: transactions, alerts, mean and highest score, last activity."""
    return decided.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(F.col("decision").isin(REVIEW, BLOCK)).alias("alert_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        F.max("event_timestamp").alias("last_seen"),
    )


def false_positive_trend(decided: DataFrame) -> DataFrame:
    """False-positive rate per day over labelled transactions."""
    alerted = F.col("decision").isin(REVIEW, BLOCK)
    legitimate = F.count_if(~F.col("is_fraud"))
    return decided.groupBy(F.to_date("event_timestamp").alias("event_date")).agg(
        legitimate.alias("legitimate_count"),
        (F.count_if(~F.col("is_fraud") & alerted) / F.nullif(legitimate, F.lit(0))).alias(
            "false_positive_rate"
        ),
    )
