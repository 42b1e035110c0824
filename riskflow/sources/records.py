"""Raw message records: made from transactions, damaged on purpose, or peeked at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import CONTRACT_FIELDS
from riskflow.functions.wire import canonical_value, utc_millis_text
from riskflow.operators.validate import with_strict_json
from riskflow.settings import LogSettings

# --- Fixed values: the known ways a test event is damaged -------------------
FAULT_CASES = ("json", "amount", "enum", "extra", "coords", "missing")
BROKEN_TEXT = "{not-json"
BAD_AMOUNT = "-10.00"
BAD_CURRENCY = "ZZZ"
EXTRA_FIELD = ("unexpected_field", "drop-me")
BAD_LATITUDE = 200.0
# ----------------------------------------------------------------------------


def raw_records(
    events: DataFrame, offset: Column, topic: str = LogSettings().raw_topic, partitions: int = 4
) -> DataFrame:
    """Message-log records of typed transactions, one partition per account."""
    return events.select(
        F.col("account_id").cast("binary").alias("key"),
        canonical_value().cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("account_id"), F.lit(partitions)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
    )


def with_faults(events: DataFrame, case: Column) -> DataFrame:
    """Add ``value``: the JSON of each event, damaged as ``case`` says.

    ``case`` is one of ``FAULT_CASES``, or NULL to leave the event intact. An unknown case
    fails the query.
    """
    known = case.isNull() | case.isin(*FAULT_CASES)

    def document(extra: bool) -> Column:
        # to_json leaves a NULL out, which is how the amount goes missing.
        shaped = {
            "event_timestamp": utc_millis_text(F.col("event_timestamp")),
            "amount": F.when(case == "amount", BAD_AMOUNT).when(
                ~case.eqNullSafe("missing"), F.col("amount").cast("string")
            ),
            "currency": F.when(case == "enum", BAD_CURRENCY).otherwise(F.col("currency")),
            "latitude": F.when(case == "coords", BAD_LATITUDE).otherwise(F.col("latitude")),
        }
        columns = [shaped.get(name, F.col(name)).alias(name) for name in CONTRACT_FIELDS]
        if extra:
            columns.append(F.lit(EXTRA_FIELD[1]).alias(EXTRA_FIELD[0]))
        return F.to_json(F.struct(*columns))

    value = (
        F.when(~known, F.raise_error(F.concat(F.lit("unknown fault case: "), case)))
        .when(case == "json", BROKEN_TEXT)
        .when(case == "extra", document(True))
        .otherwise(document(False))
    )
    return events.withColumn("value", value.cast("binary"))


def readable_records(records: DataFrame) -> DataFrame:
    """Key as text (``""`` when absent) and the value as a VARIANT object.

    ``problem`` says why a value cannot be shown: it is empty, not JSON, or not an object.
    """
    is_object = F.try_variant_get("body", "$", "map<string,variant>").isNotNull()
    problem = (
        F.when(F.col("value").isNull() | (F.length("value") == 0), "empty value")
        .when(F.col("body").isNull(), "not JSON")
        .when(~is_object, "not an object")
    )
    return (
        with_strict_json(records, F.col("value").cast("string"))
        .withColumn("problem", problem)
        .withColumns(
            {
                "key": F.coalesce(F.make_valid_utf8(F.col("key").cast("string")), F.lit("")),
                "payload": F.when(F.col("problem").isNull(), F.to_json("body")),
            }
        )
        .drop("body", "value")
    )


def peek_records(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records by offset, made readable."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return readable_records(records.orderBy("offset").limit(n))
