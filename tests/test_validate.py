import json

import pytest

from riskflow.operators.validate import dead_letters, route, valid_events, validate_events
from riskflow.sources.records import FAULT_CASES, peek_records, with_faults
from pyspark.sql import functions as F
from tests.helpers import VALID, event, events, raw, value

CASES = [
    (value(), None),
    (None, "EMPTY_PAYLOAD"),
    (b"", "MALFORMED_JSON"),
    (b"\xff\xfe", "MALFORMED_JSON"),
    (b"{not-json", "MALFORMED_JSON"),
    (value() + b" x", "MALFORMED_JSON"),
    (b'{"a":1},"end":"x"} junk', "MALFORMED_JSON"),
    (b"[1]", "SCHEMA_VALIDATION"),
    (b"5", "SCHEMA_VALIDATION"),
    (value(schema_version="1"), None),
    (value(schema_version=True), None),
    (value(schema_version=0), "SCHEMA_VALIDATION"),
    (value(("schema_version",)), None),
    (value(transaction_id="  x "), None),
    (value(transaction_id=" "), "SCHEMA_VALIDATION"),
    (value(transaction_id=5), "SCHEMA_VALIDATION"),
    (value(event_timestamp="2026-08-29 10:15:12.183+05:30"), None),
    (value(event_timestamp="2026-08-29T10:15Z"), None),
    (value(event_timestamp=1756462512), None),
    (value(event_timestamp="2026-08-29T10:15:12"), "SCHEMA_VALIDATION"),
    (value(event_timestamp="2026-08-29"), "SCHEMA_VALIDATION"),
    (value(amount=12.5), None),
    (value(amount=" 1.00 "), None),
    (value(amount="1e2"), None),
    (value(amount="1234567890.12"), None),
    (value(amount="1.555"), "INVALID_AMOUNT"),
    (value(amount="12345678901.00"), "INVALID_AMOUNT"),
    (value(amount=True), "INVALID_AMOUNT"),
    (value(amount=None), "INVALID_AMOUNT"),
    (value(amount="0.00"), "INVALID_AMOUNT"),
    (value(amount="-5.00"), "INVALID_AMOUNT"),
    (value(currency="ZZZ"), "INVALID_ENUM"),
    (value(currency="inr"), "INVALID_ENUM"),
    (value(country=None), "INVALID_ENUM"),
    (value(latitude="12.5"), None),
    (value(latitude=True), None),
    (value(latitude="true"), "INVALID_COORDINATES"),
    (value(latitude=200.0), "INVALID_COORDINATES"),
    (value(longitude="NaN"), "INVALID_COORDINATES"),
    (value(extra=1), "UNEXPECTED_FIELD"),
    (value(("merchant_id",)), "MISSING_FIELD"),
    # the first classifiable field decides, then extra keys, then the general error
    (value(amount="-1", currency="ZZZ"), "INVALID_AMOUNT"),
    (value(event_timestamp="bad", extra=1), "UNEXPECTED_FIELD"),
    (value(transaction_id="", currency="ZZZ"), "INVALID_ENUM"),
    (value(("device_id",), latitude=300), "MISSING_FIELD"),
]


@pytest.fixture(scope="module")
def checked(spark):
    return validate_events(raw(spark, *[case for case, _ in CASES])).orderBy("offset").collect()


@pytest.mark.parametrize("number", range(len(CASES)))
def test_error_type(checked, number):
    row = checked[number]
    assert row.error_type == CASES[number][1]
    assert row.is_valid == (row.error_type is None) == (row.event is not None)
    assert (row.error_message is None) == row.is_valid


def test_every_record_leaves_on_one_side(spark):
    validated = validate_events(raw(spark, *[case for case, _ in CASES]))
    assert valid_events(validated).count() + dead_letters(validated).count() == len(CASES)


def test_valid_rows_are_made_canonical(spark):
    row = valid_events(
        validate_events(raw(spark, value(transaction_id=" x ", amount=3, latitude="1.5")))
    ).first()
    assert (row.transaction_id, str(row.amount), row.latitude) == ("x", "3.00", 1.5)


def test_envelope_and_routing(spark):
    rows = route(raw(spark, value(), value(currency="ZZZ"), b"{not-json", None)).collect()
    assert [row.topic for row in rows] == ["transactions.validated"] + ["transactions.dlq"] * 3
    assert all(bytes(row.key) == b"acct_7310" for row in rows)
    assert json.loads(bytes(rows[0].value)) == VALID
    letters = [json.loads(bytes(row.value)) for row in rows[1:]]
    assert letters[0]["original_payload"]["currency"] == "ZZZ"
    assert letters[1]["original_payload"] == "{not-json"
    assert letters[2]["original_payload"] is None
    first = letters[0]
    assert (first["original_topic"], first["original_partition"], first["original_offset"]) == (
        "transactions.raw", 3, 18,
    )
    assert (first["schema_version"], first["validator_version"]) == (1, "1")
    assert first["failed_at"].endswith("Z")


def test_fault_cases_give_their_errors(spark):
    rows = events(spark, *[event(case, "10:01") for case in (*FAULT_CASES, "none")])
    case = F.when(F.col("transaction_id") != "none", F.col("transaction_id"))
    found = {
        row.transaction_id: row.error_type
        for row in validate_events(with_faults(rows, case)).collect()
    }
    assert found == {
        "json": "MALFORMED_JSON", "amount": "INVALID_AMOUNT", "enum": "INVALID_ENUM",
        "extra": "UNEXPECTED_FIELD", "coords": "INVALID_COORDINATES",
        "missing": "MISSING_FIELD", "none": None,
    }
    with pytest.raises(Exception, match="unknown fault case"):
        with_faults(rows, F.lit("other")).collect()


def test_peek(spark):
    records = raw(spark, value(), b"{broken", b"[1]", None)
    shown = peek_records(records, 3).orderBy("offset").collect()
    assert [row.problem for row in shown] == [None, "not JSON", "not an object"]
    assert json.loads(shown[0].payload)["amount"] == "842.60"
    with pytest.raises(ValueError):
        peek_records(records, 0)
