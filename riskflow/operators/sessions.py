"""Session and sliding windows per account, as batch and as streams.

A session is a run of an account's transactions with no more than a gap between neighbours. In batch
the previous time and the running number of session starts come from ``riskflow.operators.carry``, which
cuts an account by count; the sums of a session are then pre-aggregated in tasks, so one session that
holds all rows of an account is never in one task. Streams use Spark's own session and sliding
windows. Both forms give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.carry import micros, running_totals, with_previous
from riskflow.session import stored_table

SESSION_GAP = "30 minutes"


def _cents() -> Column:
    return (F.col("amount") * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)")


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("txn_count"),
        F.sum(_cents()).alias("cents"),
        F.max(_cents()).alias("max_cents"),
        F.sum((F.col("transaction_type") == "REFUND").cast("int")).alias("refund_count"),
    ]


def _published(aggregated: DataFrame, kind: str, start: Column, end: Column) -> DataFrame:
    return aggregated.select(
        "account_id",
        start.alias(f"{kind}_start"),
        end.alias(f"{kind}_end"),
        "txn_count",
        _money(F.col("cents")).alias("amount_sum"),
        _money(F.col("max_cents")).alias("amount_max"),
        "refund_count",
    )


def account_sessions(events: DataFrame, gap: str = SESSION_GAP, parts: int | None = None) -> DataFrame:
    """One row per session: it ends ``gap`` after its last transaction. Rows without a time are in none.

    A transaction exactly ``gap`` after the one before still belongs to its session. Streams need a watermark.
    """
    if events.isStreaming:
        keys = [F.col("account_id"), F.session_window("event_timestamp", gap)]
        aggregated = events.groupBy(*keys).agg(*_measures())
        return _published(aggregated, "session", F.col("session_window.start"), F.col("session_window.end"))
    needed = events.select("transaction_id", "account_id", "event_timestamp", "amount", "transaction_type")
    timed = needed.where(F.col("event_timestamp").isNotNull())
    linked = with_previous(timed, ["account_id"], {"previous_time": "event_timestamp"}, parts)
    apart = F.unix_micros("event_timestamp") - F.unix_micros("previous_time")
    starts = (F.col("previous_time").isNull() | (apart > micros(gap))).cast("int")
    marked = stored_table(linked.withColumn("starts", starts), "sessions")
    # Rows of one instant follow one another without a gap, so they share the number of starts so far.
    numbered = running_totals(marked, ["account_id"], {"starts": F.col("starts")}, {"session": 0}, parts)
    aggregated = (
        marked.join(numbered, "transaction_id")
        .groupBy("account_id", "session_starts")
        .agg(*_measures(), F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"))
    )
    end = F.timestamp_micros(F.unix_micros("last") + F.lit(micros(gap)))
    return _published(aggregated, "session", F.col("first"), end)


def sliding_windows(events: DataFrame, size: str = "30 minutes", slide: str = "10 minutes") -> DataFrame:
    """One row per account and window of ``size`` that starts at a multiple of ``slide`` and holds a row."""
    keys = [F.col("account_id"), F.window("event_timestamp", size, slide)]
    aggregated = events.groupBy(*keys).agg(*_measures())
    return _published(aggregated, "window", F.col("window.start"), F.col("window.end"))
