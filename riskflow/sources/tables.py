"""Transactions derived from the benchmark tables, column by column.

The ``events`` table is sparse per user, so time is compressed and users are
folded into accounts; every row of the table becomes one transaction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import contract

# Fixed values of the derivation (the SQL checks use the same ones).
BASE_MICROS = 1704067200000000  # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 48
ACCOUNTS = 20
MERCHANTS = 10
DEVICES = 3


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    choices = F.array(*[F.lit(value) for value in values])
    return F.element_at(choices, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Contract columns, one transaction per event row; needs a UTC session."""
    number = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    squeezed = F.lit(BASE_MICROS) + F.expr(
        f"(unix_micros(cast(ts as timestamp)) - {BASE_MICROS}) div {TIME_COMPRESSION}"
    )
    columns = {
        "schema_version": F.lit(1),
        "transaction_id": F.concat(F.lit("txn_"), number.cast("string")),
        "account_id": F.concat(
            F.lit("acct_"), (F.lit(1001) + F.pmod(F.col("user_id"), F.lit(ACCOUNTS))).cast("string")
        ),
        "event_timestamp": F.timestamp_micros(squeezed),
        "amount": F.col("value").try_cast(contract.MONEY),
        "currency": _pick(contract.CURRENCIES, number),
        "merchant_id": F.concat(F.lit("m_"), F.pmod(k, F.lit(MERCHANTS)).cast("string")),
        "merchant_category": _pick(contract.MERCHANT_CATEGORIES, k),
        "device_id": F.concat(F.lit("dev_"), F.pmod(number, F.lit(DEVICES)).cast("string")),
        "latitude": F.lit(12.0) + F.pmod(k, F.lit(7)) * F.lit(0.1),
        "longitude": F.lit(77.0) + F.pmod(number, F.lit(5)) * F.lit(0.1),
        "country": _pick(contract.COUNTRIES, number),
        "channel": _pick(contract.CHANNELS, number),
        "transaction_type": _pick(contract.TRANSACTION_TYPES, k),
    }
    return events.select(*[columns[name].alias(name) for name in contract.CONTRACT_FIELDS])


def read_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_events(read_table(spark, folder, "events"))
