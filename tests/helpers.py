"""Small hand-written transactions and a reader for result rows."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from riskflow.contract import transaction_schema

VALID = {
    "schema_version": 1,
    "transaction_id": "pay_0417",
    "account_id": "acct_7310",
    "event_timestamp": "2026-03-17T08:24:51.406Z",
    "amount": "842.60",
    "currency": "EUR",
    "merchant_id": "m_812",
    "merchant_category": "TRAVEL",
    "device_id": "dev_41",
    "latitude": 40.4168,
    "longitude": -3.7038,
    "country": "DE",
    "channel": "ECOMMERCE",
    "transaction_type": "PURCHASE",
}


def at(clock: str, day: int = 1) -> datetime:
    hour, minute = clock.split(":")
    return datetime(2026, 1, day, int(hour), int(minute), tzinfo=timezone.utc)


def event(number: str, clock: str | None, amount: str = "10.00", **changes) -> dict:
    row = dict(VALID, transaction_id=number, amount=Decimal(amount))
    row["event_timestamp"] = at(clock) if clock else None
    row.update(changes)
    return row


def events(spark: SparkSession, *rows: dict) -> DataFrame:
    schema = transaction_schema()
    return spark.createDataFrame([tuple(row[n] for n in schema.names) for row in rows], schema)


def value(drop: tuple[str, ...] = (), **changes) -> bytes:
    document = {name: part for name, part in {**VALID, **changes}.items() if name not in drop}
    return json.dumps(document).encode()


def raw(spark: SparkSession, *values: bytes | None) -> DataFrame:
    rows = [(b"acct_7310", item, "transactions.raw", 3, 17 + n) for n, item in enumerate(values)]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long"
    )


def window(frame: DataFrame, size: str, clock: str):
    rows = [
        row
        for row in frame.where(f"window_size = '{size}'").collect()
        if row.window_start.strftime("%H:%M") == clock
    ]
    assert len(rows) == 1
    return rows[0]


# Two waves of two events each; the late one moves the watermark past the early windows.
WAVES = {"early": (("a", "10:01"), ("b", "10:03")), "late": (("c", "10:50"), ("d", "10:52"))}


def timed_wave(spark: SparkSession, wave: str, run_id: str) -> DataFrame:
    rows = [event(f"wave_{run_id}_{suffix}", clock, "31.25", account_id="acct_wave") for suffix, clock in WAVES[wave]]
    return events(spark, *rows)
