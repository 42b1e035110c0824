"""JSON values to typed transactions, event time, and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.contract import CONTRACT_FIELDS, MONEY, wire_schema
from riskflow.functions.wire import utc_millis


def parse_events(records: DataFrame) -> DataFrame:
    """Typed contract columns from a string or binary ``value`` column.

    Meant for values that passed validation. Unknown keys are ignored, and a part
    that does not parse becomes NULL instead of failing the job.
    """
    event = F.from_json(F.col("value").cast("string"), wire_schema())
    flat = records.select(event.alias("event")).select("event.*")
    return flat.withColumns(
        {
            "event_timestamp": utc_millis(F.col("event_timestamp")),
            "amount": F.col("amount").try_cast(MONEY),
        }
    )


def with_event_time(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Declare event time; rows later than ``delay`` behind the newest are dropped by streams."""
    return events.withWatermark("event_timestamp", delay)


def deduplicate(events: DataFrame, horizon: str = "watermark") -> DataFrame:
    """One row per ``transaction_id``.

    On a stream, ``horizon="watermark"`` forgets an id once the watermark has passed
    it, so state stays bounded; ``"unbounded"`` remembers every id for ever.

    On a batch the earliest copy is kept, ties broken by the other fields, so the
    result does not depend on row order. The minimum is taken map-side first:
    an id repeated any number of times leaves each input task as one row. Rows
    without an id (values that did not parse) are all kept, so that they can be counted.
    """
    if horizon not in ("watermark", "unbounded"):
        raise ValueError(f"unknown horizon {horizon!r}")
    if events.isStreaming:
        if horizon == "watermark":
            return events.dropDuplicatesWithinWatermark(["transaction_id"])
        return events.dropDuplicates(["transaction_id"])
    first_by = ["event_timestamp"] + [
        name for name in events.columns if name not in ("transaction_id", "event_timestamp")
    ]
    earliest = F.min(F.struct(*first_by)).alias("kept")
    # Rows without an id are not copies of each other: each stays a row of its own.
    apart = F.when(F.col("transaction_id").isNull(), F.monotonically_increasing_id())
    return (
        events.withColumn("apart", apart)
        .groupBy("transaction_id", "apart")
        .agg(earliest)
        .select(*[
            F.col(name) if name == "transaction_id" else F.col(f"kept.{name}").alias(name)
            for name in events.columns
        ])
    )


def prepare_events(
    records: DataFrame, delay: str = "10 minutes", horizon: str = "watermark"
) -> DataFrame:
    """Parse, declare event time, then de-duplicate, in that order."""
    events = parse_events(records)
    if events.isStreaming:
        events = with_event_time(events, delay)
    return deduplicate(events, horizon).select(*CONTRACT_FIELDS)
