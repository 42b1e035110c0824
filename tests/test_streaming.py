"""Streams fed by files, run with availableNow."""

import json

from pyspark.sql import functions as F

from riskflow.functions.wire import canonical_value
from riskflow.operators.parse import prepare_events
from riskflow.operators.windows import account_window_features
from riskflow.plans.lake import lake_summary
from riskflow.settings import LakeSettings, StreamSettings
from riskflow.sources.log import read_record_files, read_value_lines
from riskflow.streaming.metrics import progress_table
from riskflow.streaming.queries import (
    run_until,
    silver_stream,
    start_console,
    start_gold,
    start_lake,
    start_router_files,
    start_silver,
)
from tests.helpers import event, events, raw, timed_wave, value


def feed(frame, folder):
    """One more file of JSON lines."""
    frame.select(canonical_value().alias("value")).coalesce(1).write.mode("append").text(str(folder))


def run(query):
    query.awaitTermination()
    return query


def silver_run(spark, tmp_path, horizon="watermark"):
    values = read_value_lines(spark, str(tmp_path / "in"))
    return run(
        start_silver(
            prepare_events(values, "10 minutes", horizon),
            str(tmp_path / "silver"), str(tmp_path / "silver-cp"), None,
        )
    )


def gold_run(spark, tmp_path):
    values = read_value_lines(spark, str(tmp_path / "in"))
    features = account_window_features(prepare_events(values, "10 minutes"))
    return run(start_gold(features, str(tmp_path / "gold"), str(tmp_path / "gold-cp"), None))


def windows(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "gold")).collect()
    return sorted(
        (r.window_size, r.window_start.strftime("%H:%M"), r.txn_count, str(r.amount_sum)) for r in rows
    )


def ids(spark, tmp_path):
    return sorted(r.transaction_id for r in spark.read.parquet(str(tmp_path / "silver")).collect())


def test_late_wave_closes_both_early_windows(spark, tmp_path):
    feed(timed_wave(spark, "early", "r"), tmp_path / "in")
    gold_run(spark, tmp_path)
    feed(timed_wave(spark, "late", "r"), tmp_path / "in")
    gold_run(spark, tmp_path)  # restarts from the checkpoint
    assert windows(spark, tmp_path) == [("30m", "10:00", 2, "62.50"), ("5m", "10:00", 2, "62.50")]


def test_late_and_repeated_rows(spark, tmp_path):
    feed(timed_wave(spark, "early", "r"), tmp_path / "in")
    silver_run(spark, tmp_path)
    feed(timed_wave(spark, "late", "r"), tmp_path / "in")
    silver_run(spark, tmp_path)  # the watermark is now 10:42
    feed(
        events(
            spark,
            event("late", "10:02"),
            event("on_the_mark", "10:42"),
            event("in_time", "10:43"),
            event("wave_r_d", "10:52"),
        ),
        tmp_path / "in",
    )
    silver_run(spark, tmp_path)
    assert ids(spark, tmp_path) == ["in_time"] + [f"wave_r_{x}" for x in "abcd"]
    folders = {p.name for p in (tmp_path / "silver").glob("event_date=*")}
    assert folders == {"event_date=2026-01-01"}


def test_horizon_decides_whether_an_old_id_may_return(spark, tmp_path):
    for horizon, copies in (("watermark", 2), ("unbounded", 1)):
        base = tmp_path / horizon
        for step in (
            [event("again", "10:00")], [event("x", "12:00")], [event("y", "12:30")], [event("again", "13:00")],
        ):
            feed(events(spark, *step), base / "in")
            silver_run(spark, base, horizon)
        assert ids(spark, base).count("again") == copies


def test_gold_from_silver_equals_gold_from_values(spark, tmp_path):
    rows = [event(f"t{n}", f"{10 + n // 60}:{n % 60:02d}", f"{n}.25", device_id=f"d{n % 3}") for n in range(180)]
    feed(events(spark, *rows, *rows[:20]), tmp_path / "in")
    silver_run(spark, tmp_path)
    gold_run(spark, tmp_path)
    direct = windows(spark, tmp_path)
    stream = silver_stream(spark, str(tmp_path / "silver"), "10 minutes")
    run(start_gold(account_window_features(stream), str(tmp_path / "gold2"), str(tmp_path / "cp2"), None))
    again = spark.read.parquet(str(tmp_path / "gold2"))
    first = spark.read.parquet(str(tmp_path / "gold"))
    assert again.exceptAll(first).count() == first.exceptAll(again).count() == 0
    assert {size for size, *_ in direct} == {"5m", "30m"}
    # and both equal the batch result for the windows that are closed
    batch = account_window_features(events(spark, *rows)).where(
        F.col("window_end") <= F.lit("2026-01-01 12:49:00").cast("timestamp")
    )
    assert batch.exceptAll(first.select(batch.columns)).count() == 0
    assert batch.count() == first.count()


def remembered_ids(*queries):
    """(de-duplication states, rows in them) of finished queries, at their fullest."""
    states = {}
    for query in queries:
        for progress in query.recentProgress:
            for place, operator in enumerate(progress["stateOperators"]):
                if operator["operatorName"].startswith("dedupe"):
                    key = (query.name, place)
                    states[key] = max(states.get(key, 0), operator["numRowsTotal"])
    return len(states), sum(states.values())


def test_lake_remembers_ids_once(spark, tmp_path):
    """Silver, and Gold of two sizes: from values each holds all ids, from the Silver table only Silver does."""
    rows = [event(f"t{n}", f"10:{n % 60:02d}", f"{n}.25") for n in range(60)]
    feed(events(spark, *rows, *rows[:20]), tmp_path / "in")
    silver = silver_run(spark, tmp_path)
    apart = remembered_ids(silver, gold_run(spark, tmp_path))
    stream = silver_stream(spark, str(tmp_path / "silver"), "10 minutes")
    from_silver = run(start_gold(account_window_features(stream), str(tmp_path / "gold2"), str(tmp_path / "cp2"), None))
    together = remembered_ids(silver, from_silver)
    assert apart == (3, 3 * 60) and together == (1, 60)


def test_router_writes_each_record_once(spark, tmp_path):
    records = raw(spark, value(), value(currency="ZZZ"), b"{not-json", None)
    for _ in range(2):
        records.write.mode("append").parquet(str(tmp_path / "raw"))
        stream = read_record_files(spark, str(tmp_path / "raw"), 100)
        run(start_router_files(stream, str(tmp_path / "out"), str(tmp_path / "cp"), trigger_seconds=None))
    counts = {r.topic: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("topic").count().collect()}
    assert counts == {"transactions.validated": 2, "transactions.dlq": 6}
    row = spark.read.parquet(str(tmp_path / "out")).where("topic = 'transactions.validated'").first()
    assert json.loads(bytes(row.value))["transaction_id"] == "pay_0417"


def test_console_shows_open_windows(spark, tmp_path):
    feed(timed_wave(spark, "early", "r"), tmp_path / "in")
    values = read_value_lines(spark, str(tmp_path / "in"))
    features = account_window_features(prepare_events(values), update_mode=True)
    query = run(start_console(features, str(tmp_path / "cp"), None))
    assert query.exception() is None


def test_lake_runs_together_and_reports_progress(spark, tmp_path):
    feed(timed_wave(spark, "early", "r"), tmp_path / "in")
    lake = LakeSettings.under(str(tmp_path / "lake"), str(tmp_path / "cp"))
    started = start_lake(read_value_lines(spark, str(tmp_path / "in")), StreamSettings(lake=lake, trigger_seconds=1))
    for query in started:
        query.processAllAvailable()
    table = progress_table(spark, started)
    run_until(spark, started, timeout_seconds=1)
    assert not any(query.isActive for query in started)
    assert {row.query_name for row in table.collect()} == {"silver-transactions", "gold-account-features"}
    assert table.agg(F.sum("input_rows")).first()[0] >= 2
    summary = {r.layer: r for r in lake_summary(spark, lake.silver_path, lake.gold_path, True).collect()}
    assert (summary["silver"].row_count, summary["silver"].gate_code) == (2, 0)
    assert (summary["gold"].row_count, summary["gold"].gate_code) == (0, 3)


def test_unordered_files_lose_nothing(spark, tmp_path):
    """Six files whose times overlap and fall back: every id reaches Silver with the defaults."""
    hours = (14, 3, 21, 9, 0, 17)
    for number, hour in enumerate(hours):
        rows = [event(f"f{number}_{n}", f"{hour}:{n:02d}") for n in range(0, 60, 5)]
        feed(events(spark, *rows), tmp_path / "in")
    silver_run(spark, tmp_path)
    assert len(ids(spark, tmp_path)) == 12 * len(hours)
