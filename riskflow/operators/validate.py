"""Contract checks on raw message values, and routing into two topics.

One projection per record, no shuffle: the value is parsed once into a VARIANT,
each field is checked by column expressions, and every record leaves on exactly one
side. Nothing is dropped.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import (
    ALLOWED_VALUES,
    CONTRACT_FIELDS,
    ID_FIELDS,
    MONEY,
    REQUIRED_FIELDS,
    VALIDATOR_VERSION,
)
from riskflow.functions.wire import canonical_value, utc_millis_text
from riskflow.settings import LogSettings

# --- Fixed values: error types and accepted text forms ----------------------
EMPTY_PAYLOAD = "EMPTY_PAYLOAD"
MALFORMED_JSON = "MALFORMED_JSON"
MISSING_FIELD = "MISSING_FIELD"
INVALID_ENUM = "INVALID_ENUM"
INVALID_AMOUNT = "INVALID_AMOUNT"
INVALID_COORDINATES = "INVALID_COORDINATES"
UNEXPECTED_FIELD = "UNEXPECTED_FIELD"
SCHEMA_VALIDATION = "SCHEMA_VALIDATION"
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
VISIBLE_TEXT = "^[!-~]+$"
MONEY_TEXT = r"^[0-9]{1,10}\.[0-9]{2}$"
DEGREES_TEXT = r"^-?[0-9]{1,3}(\.[0-9]+)?$"
CANONICAL_TIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{3})?Z$"
WHOLE_TEXT = r"^[+-]?[0-9]+(\.0*)?$"
OFFSET_TIME_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt _][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?"
    r" ?([Zz]|[+-][0-9]{2}:?[0-9]{2})$"
)
BLANKS = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Epoch numbers beyond this many seconds are taken as milliseconds.
EPOCH_SECONDS_LIMIT = 20_000_000_000
# ----------------------------------------------------------------------------

_TEXTS = "struct<" + ",".join(f"{name}:string" for name in CONTRACT_FIELDS) + ">"
_VALUES = "map<string,variant>"


def _wrapped(text: Column) -> Column:
    """VARIANT of the text inside an object that ends with a marker.

    Spark's parser ignores anything after the first value, so the text alone would not
    show whether it is one complete document. The marker is a hash of the text, which the text
    itself cannot contain.
    """
    return F.try_parse_json(
        F.concat(F.lit('{"v":'), text, F.lit(',"end":"'), _marker(text), F.lit('"}'))
    )


def _marker(text: Column) -> Column:
    return F.hex(F.xxhash64(text))


def computed(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever is built on them.

    Plain projections would be merged, and everything built on a parsed value would then
    repeat the parse. An expression that looks at the partition number counts as
    non-deterministic, so Spark keeps it in its own projection; the value does not change.
    """
    always = F.spark_partition_id() >= 0
    return frame.withColumns({name: F.when(always, column) for name, column in columns.items()})


def with_strict_json(frame: DataFrame, text: Column) -> DataFrame:
    """Add ``body``: the VARIANT of a text that is one complete JSON document, else NULL."""
    wrapped = computed(frame, wrapped=F.when(F.is_valid_utf8(text), _wrapped(text)))
    complete = F.try_variant_get("wrapped", "$.end", "string") == _marker(text)
    body = F.when(complete, F.try_variant_get("wrapped", "$.v", "variant"))
    return computed(wrapped, body=body).drop("wrapped")


class _Field:
    """Expressions over one contract field: ``texts`` holds its text, ``values`` its VARIANT."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.text = F.col(f"texts.{name}")
        # Trimming by a set of blanks is slow, and texts of visible ASCII need none.
        self.trimmed = F.when(self.text.rlike(VISIBLE_TEXT), self.text).otherwise(
            F.btrim(self.text, F.lit(BLANKS))
        )
        self.value = F.element_at("values", name)
        self.kind = F.schema_of_variant(self.value)
        self.missing = ~F.array_contains("keys", name)

    @property
    def flag(self) -> Column:
        """1 or 0 for a JSON boolean; a string that reads "true" is not one."""
        return F.when(
            self.text.isin("true", "false") & (self.kind == "BOOLEAN"),
            (self.text == "true").cast("int"),
        )

    @property
    def number_text(self) -> Column:
        """Text of a number or of a numeric string, else NULL."""
        return F.when(self.trimmed.rlike(NUMBER_TEXT), self.trimmed)


# The usual, canonical form of a value is tested first, as it is much cheaper to read.


def _version(field: _Field) -> Column:
    number = F.coalesce(
        F.when(field.trimmed.rlike(WHOLE_TEXT), field.trimmed.try_cast("decimal(38,9)").try_cast("int")),
        field.flag,
    )
    return (
        F.when(field.text == "1", 1)
        .when(field.missing, 1)
        .otherwise(F.when(number >= 1, number))
    )


def _identifier(field: _Field) -> Column:
    return F.when(field.kind == "STRING", F.nullif(field.trimmed, F.lit("")))


def _choice(field: _Field) -> Column:
    return F.when(field.text.isin(*ALLOWED_VALUES[field.name]), field.text)


def _amount(field: _Field) -> Column:
    exact = field.number_text.try_cast("decimal(38,18)")
    fits = (exact > 0) & (exact == F.round(exact, 2)) & (exact < 10_000_000_000)
    usual = field.text.try_cast(MONEY)
    return F.when(field.text.rlike(MONEY_TEXT), F.when(usual > 0, usual)).otherwise(
        F.when(fits, exact.try_cast(MONEY))
    )


def _degrees(field: _Field, limit: float) -> Column:
    number = F.when(field.text.rlike(DEGREES_TEXT), field.text.try_cast("double")).otherwise(
        F.coalesce(field.number_text.try_cast("double"), field.flag.cast("double"))
    )
    return F.when(number.between(-limit, limit), number)


def _instant(field: _Field) -> Column:
    # Spark wants a dot, no blank before the offset, and seconds.
    tidy = F.regexp_replace(F.translate(field.trimmed, "tz_,", "TZ ."), " (?=[Z+-])", "")
    tidy = F.regexp_replace(tidy, "^(.{10}[T ][0-9]{2}:[0-9]{2})(?=[Z+-])", "$1:00")
    written = F.when(
        field.trimmed.rlike(OFFSET_TIME_TEXT),
        F.coalesce(field.trimmed.try_cast("timestamp"), tidy.try_cast("timestamp")),
    )
    epoch = field.number_text.try_cast("decimal(38,9)")
    per_unit = F.when(F.abs(epoch) > EPOCH_SECONDS_LIMIT, 1_000).otherwise(1_000_000)
    counted = F.timestamp_micros((epoch * per_unit).try_cast("bigint"))
    return F.coalesce(
        F.when(field.text.rlike(CANONICAL_TIME_TEXT), field.text.try_cast("timestamp")),
        F.date_trunc("millisecond", F.coalesce(written, counted)),
    )


def _typed(field: _Field) -> Column:
    if field.name == "schema_version":
        return _version(field)
    if field.name in ID_FIELDS:
        return _identifier(field)
    if field.name in ALLOWED_VALUES:
        return _choice(field)
    if field.name == "amount":
        return _amount(field)
    if field.name == "event_timestamp":
        return _instant(field)
    return _degrees(field, 90.0 if field.name == "latitude" else 180.0)


def _named_error(name: str) -> str | None:
    """The error type a bad value of the field gets; None if only the fallback names it."""
    if name in ALLOWED_VALUES:
        return INVALID_ENUM
    return {
        "amount": INVALID_AMOUNT,
        "latitude": INVALID_COORDINATES,
        "longitude": INVALID_COORDINATES,
    }.get(name)


def validate_events(records: DataFrame) -> DataFrame:
    """Check every record's ``value`` against the contract.

    Adds ``event`` (typed contract columns, NULL when invalid), ``error_type``,
    ``error_message``, ``payload_version``, ``is_valid`` and the parsed ``body``; input columns stay. The error
    type is that of the first failing field, in contract order, that has one;
    then an unexpected key; then the general schema error.
    """
    text = F.col("value").cast("string")
    read = computed(
        with_strict_json(records, text),
        values=F.try_variant_get("body", "$", _VALUES),
        texts=F.when(F.col("body").isNotNull(), F.from_json(text, _TEXTS)),
    ).withColumn("keys", F.map_keys("values"))
    fields = [_Field(name) for name in CONTRACT_FIELDS]
    typed = computed(
        read, event=F.struct(*[_typed(field).alias(field.name) for field in fields])
    )
    extras = F.array_except("keys", F.array(*[F.lit(name) for name in CONTRACT_FIELDS]))
    # All fields are good and there are no more keys than fields: nothing else to look at.
    expected = F.lit(len(REQUIRED_FIELDS)) + F.array_contains("keys", "schema_version").cast("int")
    good = reduce(and_, [F.col(f"event.{name}").isNotNull() for name in CONTRACT_FIELDS]) & (
        F.size("keys") == expected
    )

    first_error, notes = [], []
    for field in fields:
        absent = field.missing if field.name != "schema_version" else F.lit(False)
        bad = F.col(f"event.{field.name}").isNull()
        named = _named_error(field.name)
        error = F.when(absent, MISSING_FIELD)
        first_error.append(error if named is None else error.when(bad, named))
        notes.append(
            F.when(absent, f"{field.name}: field required").when(
                bad, F.concat(F.lit(f"{field.name}: not allowed: "), _shown(field))
            )
        )
    unexpected = F.size(extras) > 0
    general = F.when(F.concat_ws("", *notes) != "", SCHEMA_VALIDATION)
    extra_note = F.when(
        unexpected, F.concat(F.lit("unexpected field: "), F.array_join(extras, ", "))
    )
    error_type = (
        F.when(good, F.lit(None))
        .when(F.col("value").isNull(), EMPTY_PAYLOAD)
        .when(F.col("body").isNull(), MALFORMED_JSON)
        .when(F.col("keys").isNull(), SCHEMA_VALIDATION)
        .otherwise(F.coalesce(*first_error, F.when(unexpected, UNEXPECTED_FIELD), general))
    )
    message = (
        F.when(F.col("value").isNull(), "message value is empty")
        .when(~F.is_valid_utf8(text), "value is not valid UTF-8")
        .when(F.col("body").isNull(), "value is not one complete JSON document")
        .when(F.col("keys").isNull(), "value is not a JSON object")
        .otherwise(F.concat_ws("; ", *notes, extra_note))
    )
    version = F.element_at("values", "schema_version")
    judged = computed(typed, error_type=error_type).withColumn(
        "is_valid", F.col("error_type").isNull()
    )
    return judged.select(
        *records.columns,
        F.when(F.col("is_valid"), F.col("event")).alias("event"),
        "error_type",
        F.when(~F.col("is_valid"), message).alias("error_message"),
        F.when(F.col("is_valid"), F.col("event.schema_version").cast("bigint"))
        .when(
            F.schema_of_variant(version).isin("BIGINT", "BOOLEAN"),
            F.try_variant_get(version, "$", "bigint"),
        )
        .alias("payload_version"),
        "is_valid",
        "body",
    )


def _shown(field: _Field) -> Column:
    return F.coalesce(F.to_json(field.value), F.lit("null"))


def valid_events(validated: DataFrame) -> DataFrame:
    """Typed, canonical transactions of the accepted records."""
    return validated.where("is_valid").select("event.*")


def _letter() -> dict[str, Column]:
    """Dead-letter columns over a validated record."""
    text = F.col("value").cast("string")
    return {
        "original_topic": F.col("topic"),
        "original_partition": F.col("partition"),
        "original_offset": F.col("offset"),
        "original_key": F.make_valid_utf8(F.col("key").cast("string")),
        "original_payload": F.when(F.is_valid_utf8(text), text).otherwise(F.hex("value")),
        "error_type": F.col("error_type"),
        "error_message": F.col("error_message"),
        "failed_at": F.current_timestamp(),
        "schema_version": F.col("payload_version"),
        "validator_version": F.lit(VALIDATOR_VERSION),
    }


def dead_letters(validated: DataFrame) -> DataFrame:
    """One row per rejected record, with the payload kept as it arrived.

    Text payloads stay text; bytes that are not UTF-8 are kept as hexadecimal.
    """
    return validated.where(~F.col("is_valid")).select(
        *[column.alias(name) for name, column in _letter().items()]
    )


def _letter_value() -> Column:
    """JSON of the envelope; a payload that is JSON is embedded as JSON."""
    letter = _letter()
    letter["failed_at"] = utc_millis_text(letter["failed_at"])
    letter["original_payload"] = F.coalesce(
        F.col("body"), letter["original_payload"].cast("variant")
    )
    envelope = F.struct(*[column.alias(name) for name, column in letter.items()])
    return F.to_json(envelope, {"ignoreNullFields": "false"})


def route(records: DataFrame, topics: LogSettings = LogSettings()) -> DataFrame:
    """``(topic, key, value)`` of every record: canonical JSON or a dead-letter envelope.

    The target is a column, so one query with one write serves both topics: a message-log
    sink reads it per row, a file sink partitions by it. The original key is kept.
    """
    validated = validate_events(records)
    accepted = F.col("is_valid")
    return validated.select(
        F.when(accepted, topics.validated_topic).otherwise(topics.dlq_topic).alias("topic"),
        "key",
        F.when(accepted, canonical_value(lambda name: F.col(f"event.{name}")))
        .otherwise(_letter_value())
        .cast("binary")
        .alias("value"),
    )
