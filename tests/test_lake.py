from decimal import Decimal

from pyspark.sql import functions as F

from riskflow.contract import GOLD_COLUMNS, SILVER_COLUMNS
from riskflow.operators import rules
from riskflow.operators.quality import population_stability, quality_report
from riskflow.operators.windows import account_window_features
from riskflow.plans.lake import lake_summary, replay, write_bronze, write_gold, write_silver
from riskflow.plans.pipeline import build_lake, upsert
from tests.helpers import event, events, raw, value


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_silver_round_trip(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(events(spark, event("1", "10:01"), event("2", "11:01")), path)
    assert (tmp_path / "silver" / "event_date=2026-01-01" / "event_hour=10").is_dir()
    table = spark.read.parquet(path)
    assert set(table.columns) == set(SILVER_COLUMNS)
    assert dict(table.dtypes)["amount"] == "decimal(12,2)"
    narrowed = table.where("event_date = date'2026-01-01' and event_hour = 10").select("account_id")
    assert narrowed.count() == 1
    text = plan(narrowed)
    assert "event_hour" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<account_id:string>" in text


def test_gold_round_trip(spark, tmp_path):
    path = str(tmp_path / "gold")
    write_gold(account_window_features(events(spark, event("1", "10:01"))), path)
    assert (tmp_path / "gold" / "window_date=2026-01-01").is_dir()
    table = spark.read.parquet(path)
    assert set(table.columns) == set(GOLD_COLUMNS)
    kinds = dict(table.dtypes)
    assert {kinds[n] for n in ("amount_sum", "amount_avg", "amount_max")} == {"decimal(12,2)"}


def test_build_and_summary(spark, tmp_path):
    silver, gold, dlq = (str(tmp_path / name) for name in ("silver", "gold", "dlq"))
    missing = {r.layer: r for r in lake_summary(spark, silver, gold).collect()}
    assert (missing["silver"].has_files, missing["silver"].gate_code) == (False, 2)
    assert missing["gold"].gate_code == 0
    build_lake(spark, raw(spark, value(), value(), value(currency="ZZZ"), None), silver, gold, dlq)
    ready = {r.layer: r for r in lake_summary(spark, silver, gold, require_gold=True).collect()}
    assert (ready["silver"].row_count, ready["gold"].row_count) == (1, 2)
    assert {r.gate_code for r in ready.values()} == {0}
    assert spark.read.parquet(dlq).count() == 2


def test_replay_reads_only_the_dates_it_needs(spark, tmp_path):
    path = str(tmp_path / "bronze")
    records = raw(spark, value(), value(), value()).withColumn(
        "timestamp", F.timestamp_seconds(F.lit(1767225600) + F.col("offset") * 86400)
    )
    write_bronze(records, path)
    found = replay(spark, path, "2026-01-18 00:00:00", "2026-01-19 00:00:00", "acct_7310")
    assert [row.offset for row in found.collect()] == [17]
    assert "arrival_date" in plan(found).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert replay(spark, path, account_id="other").count() == 0


def test_upsert_is_idempotent(spark):
    schema = "transaction_id string, amount int, processed_at int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], schema)
    new = spark.createDataFrame([("b", 5, 2), ("b", 4, 3), ("c", 6, 2)], schema)
    once = upsert(old, new)
    twice = upsert(once, new)
    expected = [("a", 1, 1), ("b", 4, 3), ("c", 6, 2)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected


def test_decisions_are_explained(spark):
    schema = """transaction_id string, impossible_travel boolean, txn_count_5m long, amount_zscore double,
      new_device_for_account boolean, is_high_amount boolean, merchant_fraud_rate double,
      country_count int, device_account_count long, p double"""
    rows = spark.createDataFrame(
        [
            ("quiet", False, 1, None, False, None, None, 1, 1, 0.1),
            ("model", False, 1, 0.0, False, False, 0.0, 1, 1, 0.7),
            ("all", True, 9, 5.0, True, True, 0.5, 4, 9, 0.9),
        ],
        schema,
    )
    scored = rules.apply_rules(rows).withColumn(
        "risk_score", rules.risk_score(F.col("p"), F.col("rule_risk_total"))
    )
    found = {r.transaction_id: r for r in rules.decide(scored).collect()}
    assert (found["quiet"].decision, found["quiet"].reason_codes) == ("APPROVE", [])
    assert (found["model"].decision, found["model"].reason_codes) == ("REVIEW", ["MODEL_SCORE"])
    assert (found["all"].decision, found["all"].risk_score) == ("BLOCK", 1.0)
    assert found["all"].rule_risk_total == Decimal("1.20") and len(found["all"].reason_codes) == 7
    kept = rules.alerts(rules.decide(scored.withColumn("account_id", F.lit("x"))), decision="BLOCK")
    assert [r.transaction_id for r in kept.collect()] == ["all"]


def test_quality_and_drift(spark):
    rows = events(spark, event("1", "10:00"), event("1", "10:00"), event("2", "23:00", currency="ZZZ"))
    now = F.lit("2026-01-01 12:00:00").cast("timestamp")
    report = {r.check_name: (r.failed, r.total) for r in quality_report(rows, now).collect()}
    assert report["transaction_id_unique"] == (1, 3)
    assert report["currency_allowed"] == (1, 3) and report["event_time_not_in_future"] == (1, 3)
    assert report["amount_positive"] == (0, 3)
    same = population_stability(rows, rows, F.col("currency"), "currency").first()
    assert same.psi == 0.0 and same.bins == 2
