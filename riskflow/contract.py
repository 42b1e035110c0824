"""The version 1 transaction contract: fields, allowed values, table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: the v1 contract -----------------------------------------
CONTRACT_FIELDS = (
    "schema_version",
    "transaction_id",
    "account_id",
    "event_timestamp",
    "amount",
    "currency",
    "merchant_id",
    "merchant_category",
    "device_id",
    "latitude",
    "longitude",
    "country",
    "channel",
    "transaction_type",
)
CURRENCIES = ("INR", "USD", "EUR", "GBP", "SGD", "AUD")
CHANNELS = ("ECOMMERCE", "POS", "MOBILE", "ATM")
TRANSACTION_TYPES = ("PURCHASE", "REFUND", "WITHDRAWAL", "TRANSFER")
MERCHANT_CATEGORIES = (
    "ELECTRONICS",
    "GROCERY",
    "RESTAURANT",
    "FUEL",
    "TRAVEL",
    "CLOTHING",
    "ENTERTAINMENT",
    "HEALTH",
    "JEWELRY",
    "UTILITIES",
)
COUNTRIES = ("IN", "US", "GB", "DE", "SG", "AU")
SILVER_PARTITIONS = ("event_date", "event_hour")
GOLD_PARTITIONS = ("window_date",)
GOLD_FEATURES = (
    "account_id",
    "window_start",
    "window_end",
    "window_size",
    "txn_count",
    "amount_sum",
    "amount_avg",
    "amount_max",
    "unique_merchants",
    "unique_devices",
    "unique_locations",
    "location_spread_km",
    "high_amount_count",
    "multi_device_signal",
    "rapid_transaction_signal",
    "rapid_location_change_signal",
)
VALIDATOR_VERSION = "1"
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
# ---------------------------------------------------------------------------

ALLOWED_VALUES = {
    "currency": CURRENCIES,
    "merchant_category": MERCHANT_CATEGORIES,
    "country": COUNTRIES,
    "channel": CHANNELS,
    "transaction_type": TRANSACTION_TYPES,
}
# Currency, latitude and longitude of each country's home city.
HOME = {
    "IN": ("INR", 12.9716, 77.5946),
    "US": ("USD", 40.7128, -74.0060),
    "GB": ("GBP", 51.5074, -0.1278),
    "DE": ("EUR", 52.5200, 13.4050),
    "SG": ("SGD", 1.3521, 103.8198),
    "AU": ("AUD", -33.8688, 151.2093),
}
ID_FIELDS = ("transaction_id", "account_id", "merchant_id", "device_id")
# schema_version has a default, so it is the one field that may be absent.
REQUIRED_FIELDS = CONTRACT_FIELDS[1:]

SILVER_COLUMNS = CONTRACT_FIELDS + SILVER_PARTITIONS
GOLD_COLUMNS = GOLD_FEATURES + GOLD_PARTITIONS

MONEY = T.DecimalType(12, 2)

_TYPED = {
    "schema_version": T.IntegerType(),
    "event_timestamp": T.TimestampType(),
    "amount": MONEY,
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
}
_ON_THE_WIRE = {**_TYPED, "event_timestamp": T.StringType(), "amount": T.StringType()}


def wire_schema() -> T.StructType:
    """Schema of the canonical JSON value: time and amount travel as strings."""
    return T.StructType(
        [T.StructField(name, _ON_THE_WIRE.get(name, T.StringType())) for name in CONTRACT_FIELDS]
    )


def transaction_schema() -> T.StructType:
    """Schema after parsing: UTC timestamps and exact two-decimal money."""
    return T.StructType(
        [T.StructField(name, _TYPED.get(name, T.StringType())) for name in CONTRACT_FIELDS]
    )


def raw_record_schema() -> T.StructType:
    """The columns of a message-log record this library reads."""
    return T.StructType(
        [
            T.StructField("key", T.BinaryType()),
            T.StructField("value", T.BinaryType()),
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
    )
