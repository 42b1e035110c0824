"""Merges into partitioned tables: what is touched, what stays, and repeated batches."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.plans.lake import replay, write_bronze, write_table
from riskflow.plans.merge import merge_into, start_merge
from riskflow.settings import LakeSettings, StreamSettings
from riskflow.sources.log import read_value_lines
from riskflow.streaming.queries import run_until, start_lake
from tests.helpers import raw, timed_wave
from tests.test_streaming import feed

SCHEMA = "transaction_id string, amount decimal(12,2), processed_at timestamp, event_date date"


def rows(spark, *values):
    made = [(i, Decimal(a), datetime(2026, 1, 1, hour, tzinfo=timezone.utc), d and date(2026, 1, d)) for i, a, hour, d in values]
    return spark.createDataFrame(made, SCHEMA)


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def content(spark, path):
    found = spark.read.parquet(str(path)).collect()
    return sorted((r.transaction_id, str(r.amount), r.event_date and r.event_date.day) for r in found)


def test_merge_touches_only_its_partitions(spark, tmp_path):
    table = tmp_path / "table"
    first = rows(spark, ("a", "1", 1, 1), ("b", "2", 1, 1), ("c", "3", 1, 2), ("d", "4", 1, 3), ("e", "5", 1, 4))
    write_table(first, str(table), ("event_date",))
    before = files(table)
    # b changes; c, the only row of the second, moves to the third; f is new on a new date.
    changes = rows(spark, ("b", "20", 2, 1), ("b", "19", 1, 1), ("c", "30", 2, 3), ("f", "6", 2, 9))
    touched = merge_into(spark, str(table), changes, ["event_date"])
    assert [d.day for (d,) in touched] == [1, 2, 3, 9]
    want = [("a", "1.00", 1), ("b", "20.00", 1), ("c", "30.00", 3), ("d", "4.00", 3), ("e", "5.00", 4), ("f", "6.00", 9)]
    assert content(spark, table) == want
    after = files(table)
    untouched = {name: time for name, time in before.items() if "2026-01-04" in name}
    assert untouched and untouched.items() <= after.items()
    assert not (table / "event_date=2026-01-02").exists()
    merge_into(spark, str(table), changes, ["event_date"])
    assert content(spark, table) == want
    older = rows(spark, ("b", "7", 0, 1))
    merge_into(spark, str(table), older, ["event_date"])  # an update wins over what is stored
    assert ("b", "7.00", 1) in content(spark, table)


def test_merge_edges(spark, tmp_path):
    table = tmp_path / "table"
    assert merge_into(spark, str(table), rows(spark), ["event_date"]) == []
    merge_into(spark, str(table), rows(spark, ("a", "1", 1, None), ("b", "2", 1, 1)), ["event_date"])
    merge_into(spark, str(table), rows(spark, ("a", "3", 2, 1)), ["event_date"])
    assert content(spark, table) == [("a", "3.00", 1), ("b", "2.00", 1)]
    assert merge_into(spark, str(table), rows(spark), ["event_date"]) == []
    with pytest.raises(ValueError):
        odd = rows(spark, ("a", "1", 1, 1)).withColumn("place", F.lit("x/y")).select("transaction_id", "amount", "processed_at", "place")
        merge_into(spark, str(tmp_path / "odd"), odd, ["place"])
        merge_into(spark, str(tmp_path / "odd"), odd.withColumn("place", F.lit("z")), ["place"])


def test_two_partition_columns(spark, tmp_path):
    table = tmp_path / "table"
    with_hour = lambda frame: frame.withColumn("event_hour", F.hour("processed_at"))
    write_table(with_hour(rows(spark, ("a", "1", 1, 1), ("b", "2", 2, 1), ("c", "3", 3, 1))), str(table), ("event_date", "event_hour"))
    before = files(table)
    merge_into(spark, str(table), with_hour(rows(spark, ("b", "9", 5, 1))), ["event_date", "event_hour"])
    assert content(spark, table) == [("a", "1.00", 1), ("b", "9.00", 1), ("c", "3.00", 1)]
    assert {n for n in before if "event_hour=2" not in n} <= set(files(table)) and not list(table.glob("*/event_hour=2"))


def test_stream_of_changes_repeated(spark, tmp_path):
    """Two batches, a restart, and the whole stream once more from an empty checkpoint."""
    source, table = tmp_path / "in", tmp_path / "table"
    steps = [rows(spark, ("a", "1", 1, 1), ("b", "2", 1, 2)), rows(spark, ("a", "5", 3, 2), ("c", "3", 1, 1))]
    for step in steps:
        step.coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        start_merge(stream, str(table), str(tmp_path / "cp"), ["event_date"], trigger_seconds=None).awaitTermination()
    want = [("a", "5.00", 2), ("b", "2.00", 2), ("c", "3.00", 1)]
    assert content(spark, table) == want
    stream = spark.readStream.schema(SCHEMA).parquet(str(source))
    start_merge(stream, str(table), str(tmp_path / "again"), ["event_date"], trigger_seconds=None).awaitTermination()
    assert content(spark, table) == want


def test_lake_remembers_ids_once(spark, tmp_path):
    """Gold reads Silver, so only the Silver query keeps ids; Gold is that of the value stream."""
    lake = LakeSettings.under(str(tmp_path / "lake"), str(tmp_path / "cp"))
    feed(timed_wave(spark, "early", "r"), tmp_path / "in")
    feed(timed_wave(spark, "early", "r"), tmp_path / "in")
    feed(timed_wave(spark, "late", "r"), tmp_path / "in")
    started = start_lake(read_value_lines(spark, str(tmp_path / "in")), StreamSettings(lake=lake, trigger_seconds=1))
    for _ in range(2):  # Gold sees what Silver has written
        for query in started:
            query.processAllAvailable()
    names = {q.name: [o["operatorName"] for o in json.loads(q.lastProgress.json)["stateOperators"]] for q in started}
    run_until(spark, started, timeout_seconds=1)
    assert names["silver-transactions"] == ["dedupeWithinWatermark"]
    assert len(names["gold-account-features"]) == 4 and not any("dedupe" in o for o in names["gold-account-features"])
    gold = spark.read.parquet(lake.gold_path).collect()
    assert sorted((r.window_size, r.txn_count, str(r.amount_sum)) for r in gold) == [("30m", 2, "62.50"), ("5m", 2, "62.50")]


def test_replay_prunes_hours(spark, tmp_path):
    records = raw(spark, *[b"x"] * 48).withColumn("timestamp", F.expr("timestamp'2026-01-01 00:30:00' + make_interval(0, 0, 0, 0, cast(offset - 17 as int))"))
    write_bronze(records, str(tmp_path / "bronze"))
    slice_ = replay(spark, str(tmp_path / "bronze"), "2026-01-01 22:15:00", "2026-01-02 01:00:00")
    assert sorted(r.offset - 17 for r in slice_.collect()) == [22, 23, 24]
    plan = slice_._jdf.queryExecution().executedPlan().toString()
    assert "arrival_hour" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert {f.split("arrival_")[2].split("/")[0] for f in slice_.inputFiles()} >= {"hour=22", "hour=23", "hour=0"}
