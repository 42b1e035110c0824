"""Conversions between typed columns and the canonical JSON value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import CONTRACT_FIELDS, MONEY, WIRE_TIMESTAMP_FORMAT


def utc_millis_text(ts: Column) -> Column:
    """UTC ISO-8601 text with three fraction digits (cut, not rounded) and ``Z``.

    The session must be in UTC (``riskflow.session.configure``).
    """
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def utc_millis(text: Column) -> Column:
    """The strict inverse: exactly three fraction digits and an offset, else NULL."""
    return F.try_to_timestamp(text, F.lit(WIRE_TIMESTAMP_FORMAT))


def canonical_value(field: Callable[[str], Column] = F.col) -> Column:
    """Canonical JSON text of a typed transaction, fields in contract order.

    ``field`` finds a contract column by name, so that nested events work too.
    """
    shaped = {
        "event_timestamp": utc_millis_text(field("event_timestamp")),
        "amount": field("amount").cast(MONEY).cast("string"),
    }
    return F.to_json(
        F.struct(*[shaped.get(name, field(name)).alias(name) for name in CONTRACT_FIELDS])
    )


def keyed_records(events: DataFrame) -> DataFrame:
    """``(key, value)`` for a message log: the account id and the canonical JSON."""
    return events.select(
        F.col("account_id").cast("binary").alias("key"),
        canonical_value().cast("binary").alias("value"),
    )
