from decimal import Decimal

from riskflow.contract import GOLD_FEATURES, transaction_schema, wire_schema
from riskflow.functions.geo import grid_cell, haversine_km
from riskflow.functions.wire import canonical_value
from riskflow.operators.parse import deduplicate, parse_events, prepare_events
from riskflow.operators.signals import with_transaction_signals
from riskflow.operators.windows import account_window_features, window_features
from riskflow.settings import FeatureSettings
from pyspark.sql import functions as F
from tests.helpers import event, events, raw, value, window


def test_parse_types_and_values(spark):
    row = parse_events(raw(spark, value())).first()
    assert row.amount == Decimal("842.60")
    assert row.event_timestamp.isoformat() == "2026-03-17T08:24:51.406000"
    assert parse_events(raw(spark, value())).schema == transaction_schema()
    assert wire_schema().names == transaction_schema().names


def test_parse_needs_three_fraction_digits_and_an_offset(spark):
    texts = ["2026-01-01T10:00:00Z", "2026-01-01T10:00:00.123456Z", "2026-01-01T10:00:00.123"]
    rows = parse_events(raw(spark, *[value(event_timestamp=t) for t in texts])).collect()
    assert [row.event_timestamp for row in rows] == [None, None, None]


def test_parse_survives_broken_values(spark):
    rows = parse_events(raw(spark, b"{not-json", value(amount="abc"))).collect()
    assert rows[0].transaction_id is None
    assert rows[1].amount is None and rows[1].transaction_id == "pay_0417"


def test_offset_times_land_in_utc_windows(spark):
    parsed = parse_events(raw(spark, value(event_timestamp="2026-01-01T15:31:00.000+05:30")))
    assert window(account_window_features(parsed), "5m", "10:00").txn_count == 1


def test_deduplicate_keeps_the_earliest_copy(spark):
    rows = events(
        spark,
        event("dup", "10:05", "7.00"),
        event("dup", "10:01", "9.00"),
        event("other", "10:02", "5.00"),
    )
    kept = {row.transaction_id: row.amount for row in deduplicate(rows).collect()}
    assert kept == {"dup": Decimal("9.00"), "other": Decimal("5.00")}


def test_prepare_removes_copies(spark):
    assert prepare_events(raw(spark, value(), value())).count() == 1


def test_five_and_thirty_minute_sums(spark):
    rows = events(
        spark,
        event("1", "10:01", "10.00", merchant_id="m_1", device_id="a"),
        event("2", "10:03", "15.50", merchant_id="m_2", device_id="a"),
        event("3", "10:20", "5.00", merchant_id="m_3", device_id="b"),
    )
    features = account_window_features(rows)
    assert features.columns == list(GOLD_FEATURES)
    early = window(features, "5m", "10:00")
    assert (early.txn_count, early.amount_sum, early.amount_avg, early.amount_max) == (
        2, Decimal("25.50"), Decimal("12.75"), Decimal("15.50"),
    )
    assert (early.unique_merchants, early.unique_devices) == (2, 1)
    late = window(features, "5m", "10:20")
    assert (late.unique_merchants, late.unique_devices) == (1, 1)
    half = window(features, "30m", "10:00")
    assert (half.txn_count, half.unique_merchants, half.unique_devices) == (3, 3, 2)
    assert half.multi_device_signal and not early.multi_device_signal


def test_one_pass_equals_one_size_at_a_time(spark):
    rows = events(spark, *[event(str(n), f"10:{n:02d}", f"{n}.37") for n in range(1, 59)])
    together = account_window_features(rows)
    apart = window_features(rows, "5m", "5 minutes").unionByName(
        window_features(rows, "30m", "30 minutes")
    )
    sets = window_features(rows, "5m", "5 minutes", update_mode=True)
    assert together.exceptAll(apart).count() == apart.exceptAll(together).count() == 0
    assert sets.exceptAll(together.where("window_size = '5m'")).count() == 0


def test_high_amount_is_inclusive(spark):
    settings = FeatureSettings(high_amount_threshold=Decimal("100.00"))
    rows = events(spark, event("1", "10:01", "99.99"), event("2", "10:02", "100.00"))
    flags = with_transaction_signals(rows, settings).orderBy("transaction_id").collect()
    assert [row.is_high_amount for row in flags] == [False, True]
    assert window(account_window_features(rows, settings), "5m", "10:00").high_amount_count == 1


def test_rapid_signal_per_window(spark):
    settings = FeatureSettings(rapid_txn_count_threshold=3)
    rows = events(spark, *[event(c, c) for c in ("10:01", "10:02", "10:03", "10:21")])
    features = account_window_features(rows, settings)
    assert window(features, "5m", "10:00").rapid_transaction_signal
    assert not window(features, "5m", "10:20").rapid_transaction_signal
    assert window(features, "30m", "10:00").txn_count == 4


def test_location_signal_needs_distance(spark):
    paris = {"latitude": 48.8566, "longitude": 2.3522}
    same = events(spark, event("1", "10:01"), event("2", "10:02"))
    apart = events(spark, event("1", "10:01"), event("2", "10:02", **paris))
    near = window(account_window_features(same), "5m", "10:00")
    assert near.location_spread_km == 0.0 and not near.rapid_location_change_signal
    far = window(account_window_features(apart), "5m", "10:00")
    assert 1000 < far.location_spread_km < 1100 and far.rapid_location_change_signal


def test_window_start_belongs_to_the_window_and_null_time_to_none(spark):
    rows = events(spark, event("1", "10:05"), event("2", None))
    features = account_window_features(rows)
    assert window(features, "5m", "10:05").txn_count == 1
    assert features.count() == 2


def test_distance_and_grid_propagate_null(spark):
    null = F.lit(None).cast("double")
    row = spark.range(1).select(
        haversine_km(null, F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("km"),
        grid_cell(null, F.lit(1.0)).alias("cell"),
        grid_cell(F.lit(-0.0001), F.lit(12.97164)).alias("zero"),
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
    ).first()
    assert row.km is None and row.cell is None and row.zero == "0.0,12.972"
    assert abs(row.half - 20015.087) < 0.001


def test_canonical_text_cuts_to_milliseconds(spark):
    rows = events(spark, event("1", "10:01", "5.00"))
    moved = rows.withColumn("event_timestamp", F.expr("event_timestamp + interval 1.9999 seconds"))
    text = moved.select(canonical_value().alias("v")).first().v
    assert '"event_timestamp":"2026-01-01T10:01:01.999Z"' in text and '"amount":"5.00"' in text
