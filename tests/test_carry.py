"""The cut-and-carry windows against plain windows and brute force."""

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.operators import behaviour as B
from riskflow.operators import carry
from riskflow.operators.carry import in_parts, running_totals, with_previous
from tests.helpers import event, events


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = []
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    for n in range(400):
        # One account holds most rows, times collide, and there are long silences.
        made.append(
            event(
                f"t{n:03d}",
                "00:00",
                f"{rng.randint(1, 20000) / 100:.2f}",
                account_id=rng.choice(["hot"] * 6 + ["a", "b"]),
                device_id=rng.choice("xyz"),
                merchant_id=rng.choice("mn"),
                country=rng.choice(["IN", "US", "GB"]),
                event_timestamp=start
                + timedelta(minutes=rng.choice([0, 3000, 9000]) + rng.randint(0, 300)),
            )
        )
    return made


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_previous_row(spark, rows, parts):
    frame = events(spark, *rows)
    ordered = W.partitionBy("account_id").orderBy("event_timestamp", "transaction_id")
    plain = frame.withColumn("before", F.lag("amount").over(ordered))
    cut = with_previous(frame, ["account_id"], {"before": "amount"}, parts)
    assert cut.count() == len(rows)
    assert cut.select(plain.columns).exceptAll(plain).count() == 0


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_running_totals(spark, rows, parts):
    hour = 3_600_000_000
    totals = running_totals(
        events(spark, *rows),
        ["account_id"],
        {"n": F.lit(1), "sum": F.col("amount")},
        {"now": 0, "prior": 1, "hour": hour + 1},
        parts,
    )
    found = {row.transaction_id: row for row in totals.collect()}
    assert len(found) == len(rows)
    for row in rows:
        same = [r for r in rows if r["account_id"] == row["account_id"]]
        at = row["event_timestamp"]
        now = [r for r in same if r["event_timestamp"] <= at]
        prior = [r for r in same if r["event_timestamp"] < at]
        old = [r for r in same if r["event_timestamp"] < at - timedelta(hours=1)]
        got = found[row["transaction_id"]]
        assert (got.now_n, got.prior_n, got.hour_n) == (len(now), len(prior), len(old))
        assert got.prior_sum == sum((r["amount"] for r in prior), Decimal(0))


def test_one_hot_instant_is_split(spark):
    """One account, one instant: parts stay even, and ties get the totals of the whole instant."""
    frame = events(spark, event("t", "10:00", "2.00")).drop("transaction_id")
    many = frame.crossJoin(spark.range(4000)).withColumn("transaction_id", F.format_string("t%05d", "id")).drop("id")
    cut = in_parts(many, ["account_id", "event_timestamp", "transaction_id"], 8)
    sizes = [r["count"] for r in cut.groupBy("carry_part").count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) < 1000
    totals = running_totals(many, ["account_id"], {"n": F.lit(1)}, {"now": 0, "prior": 1}, 8)
    assert [(r.now_n, r.prior_n, r["count"]) for r in totals.groupBy("now_n", "prior_n").count().collect()] == [(4000, 0, 4000)]
    before = with_previous(many, ["account_id"], {"before": "transaction_id"}, 8)
    ordered = W.partitionBy("account_id").orderBy("transaction_id")
    plain = many.select("transaction_id", F.lag("transaction_id").over(ordered).alias("before"))
    assert before.select("transaction_id", "before").exceptAll(plain).count() == 0


def test_rows_without_time_stay(spark):
    frame = events(spark, event("a", "10:00"), event("b", "11:00"), event("c", "12:00"))
    at = F.when(F.col("transaction_id") != "b", F.col("event_timestamp"))
    frame = frame.withColumn("event_timestamp", at)
    counts = {r.transaction_id: r.txn_count_24h for r in B.rolling_velocity(frame).collect()}
    assert counts == {"a": 1, "b": None, "c": 2}
    seconds = {r.transaction_id: r.seconds_since_previous_txn for r in B.travel(frame).collect()}
    assert seconds == {"a": None, "b": None, "c": 7200.0}


def test_no_leakage_from_later_or_same_time_rows(spark, rows):
    """Changing the newest rows must not change the features of earlier ones."""
    newest = max(row["event_timestamp"] for row in rows)
    changed = [
        dict(row, amount=Decimal("9999.99"), country="AU") if row["event_timestamp"] == newest else row
        for row in rows
    ]
    def features(source):
        frame = events(spark, *source)
        labelled = frame.withColumn("is_fraud", F.col("amount") > 9000)
        tables = [
            B.amount_deviation(frame), B.merchant_history(labelled), B.travel(frame),
            B.rolling_velocity(frame), B.device_activity(frame), B.account_history(frame),
            B.countries_seen(frame), B.new_pairs(frame), B.category_risk(labelled), B.temporal(frame),
        ]
        keys = [row["transaction_id"] for row in rows if row["event_timestamp"] < newest]
        return [t.where(F.col("transaction_id").isin(keys)).orderBy("transaction_id").collect() for t in tables]

    assert features(rows) == features(changed)


def test_impossible_travel_without_elapsed_time(spark):
    pair = events(
        spark,
        event("a", "10:00"),
        event("b", "10:00", latitude=48.8566, longitude=2.3522),
        event("c", "23:00"),
    )
    rows = {r.transaction_id: r for r in B.travel(pair).collect()}
    assert rows["a"].impossible_travel is None
    assert rows["b"].impossible_travel is True and rows["b"].implied_speed_kmh is None
    assert rows["c"].impossible_travel is False


@pytest.mark.parametrize("part_rows", [5, 40, 100_000])
def test_totals_of_keys_cut_in_time(spark, rows, part_rows, monkeypatch):
    """Keys cut into many parts, one of them missing: totals and previous rows as from the range partitioner."""
    frame = events(spark, *rows).withColumn("account_id", F.when(F.col("account_id") != "a", F.col("account_id")))
    frame = frame.withColumn("event_timestamp", F.when(F.col("transaction_id") != "t007", F.col("event_timestamp")))
    arguments = (
        ["account_id"],
        {"n": F.lit(1), "sum": F.col("amount"), "squares": (F.col("amount") * 100).cast("decimal(19,0)") * 2},
        {"now": 0, "prior": 1, "hour": 3_600_000_001, "month": 2_592_000_000_001},
    )
    previous = {"before_time": "event_timestamp", "before_amount": "amount"}
    want = carry.running_totals(frame, *arguments, 7, previous)
    monkeypatch.setattr(carry, "PART_ROWS", part_rows)
    monkeypatch.setattr(carry, "CROWDED", 1_000)
    found = carry.running_totals(frame, *arguments, previous=previous)
    assert found.count() == len(rows) and found.schema == want.schema
    assert found.exceptAll(want).count() == 0


def test_totals_shuffle_one_row_per_effect(spark, rows):
    """Only effects that somebody can read are spread, and no row is gathered again from its probes."""
    frame = events(spark, *rows)
    totals = carry.running_totals(frame, ["account_id"], {"n": F.lit(1)}, {"now": 0, "prior": 1, "year": 31_536_000_000_001})
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 0 and "probe" not in plan
    assert {r.year_n for r in totals.collect()} == {0}


def test_copies_of_a_row_follow_each_other(spark):
    """Two copies of a row are one result, and its previous row is the other copy."""
    rows = [event("a", "10:00", country="IN"), event("b", "10:05", country="US"), event("b", "10:05", country="US"), event("c", "10:06")]
    found = carry.running_totals(events(spark, *rows), ["account_id"], {"n": F.lit(1)}, {"now": 0}, previous={"from": "country"})
    assert {r.transaction_id: (r.now_n, r["from"]) for r in found.collect()} == {"a": (1, None), "b": (3, "US"), "c": (4, "US")}
