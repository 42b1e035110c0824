"""Keyed-state streams against the batch functions, over files, restarts and idle keys."""

from __future__ import annotations



import random

import pytest
from pyspark import shuffle
from pyspark.sql import Row
from pyspark.sql import functions as F

from riskflow.contract import transaction_schema
from riskflow.operators import behaviour as B
from riskflow.operators.parse import with_event_time
from riskflow.operators.sessions import account_sessions, sliding_windows
from riskflow.streaming.keyed import _in_order, account_state, pair_state, pairs_by_transaction, start_keyed, temporal_stream, travel_stream
from tests.helpers import event, events


def made(many=90):
    rows = []
    for n in range(many):
        minute = n * 7 + n % 3
        rows.append(
            event(
                f"t{n:03d}", f"{minute // 60}:{minute % 60:02d}", account_id=f"a{n % 4}", device_id=f"d{n * n % 5}", merchant_id=f"m{n % 7}",
                country=("DE", "IN", "US")[n // 11 % 3], latitude=10.0 + n * 13 % 50, longitude=20.0 + n % 9,
            )
        )
    return rows


def run(spark, base, rows, transform, name):
    """One run over a new file, from the checkpoint of the last run."""
    events(spark, *rows).coalesce(1).write.mode("append").parquet(str(base / "in"))
    stream = with_event_time(spark.readStream.schema(transaction_schema()).parquet(str(base / "in")), "10 minutes")
    query = start_keyed(transform(stream), name, str(base / name), str(base / f"{name}-cp"), None, 3)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("name", ["travel", "pairs", "temporal"])
def test_streams_equal_batch_over_restarts(spark, tmp_path, name):
    rows = made()
    transform = {"travel": travel_stream, "pairs": pair_state, "temporal": lambda e: temporal_stream(e, min_history=3, unusual_share=0.2)}[name]
    for start in range(0, len(rows), 30):  # three files, three starts
        run(spark, tmp_path, rows[start : start + 30], transform, name)
    stored = spark.read.parquet(str(tmp_path / name))
    table = events(spark, *rows)
    batch = {"travel": B.travel, "pairs": B.new_pairs, "temporal": lambda e: B.temporal(e, min_history=3, unusual_share=0.2)}[name](table)
    stream = pairs_by_transaction(stored) if name == "pairs" else stored
    assert stream.count() == batch.count() == len(rows)
    stream = stream.select(batch.columns)
    assert stream.exceptAll(batch).count() == batch.exceptAll(stream).count() == 0



def test_idle_state_goes(spark, tmp_path):
    idle = lambda e: account_state(e, "1 hour")
    run(spark, tmp_path, [event("a", "1:00", account_id="x"), event("b", "1:05", account_id="y")], idle, "idle")
    run(spark, tmp_path, [event("c", "1:30", account_id="y")], idle, "idle")
    # The watermark reaches 2:10: x has been idle for more than an hour, y has not.
    query = run(spark, tmp_path, [event("d", "2:20", account_id="z")], idle, "idle")
    run(spark, tmp_path, [event("e", "2:21", account_id="x"), event("f", "2:22", account_id="y")], idle, "idle")
    found = {r.transaction_id: r for r in spark.read.parquet(str(tmp_path / "idle")).collect()}
    assert found["c"].previous_time is not None and found["c"].prior_count == 1
    assert found["e"].previous_time is None and found["e"].prior_count == 0  # forgotten
    assert found["f"].prior_count == 2
    assert query.exception() is None


def test_rows_out_of_order_and_without_time(spark, tmp_path):
    keep = lambda e: account_state(e, None)
    run(spark, tmp_path, [event("b", "1:05"), event("a", "1:00"), event("n", None)], keep, "late")
    run(spark, tmp_path, [event("l", "1:02"), event("c", "1:09")], keep, "late")
    found = {r.transaction_id: r for r in spark.read.parquet(str(tmp_path / "late")).collect()}
    assert found["a"].previous_time is None and found["b"].prior_count == 1
    assert found["l"].out_of_order and found["l"].previous_time is None and found["l"].prior_count == 2
    assert found["c"].previous_time.minute == 5 and found["c"].prior_count == 3
    assert found["n"].previous_time is None and not found["n"].out_of_order


@pytest.mark.parametrize("parts", [None, 6])
def test_sessions(spark, tmp_path, parts):
    """Gaps below, at and above the limit; one session over all parts; the stream's closed ones agree."""
    clock = [("x", "1:00"), ("x", "1:30"), ("x", "2:01"), ("y", "1:10"), ("y", "1:10"), ("y", "1:39"), ("z", None)]
    rows = [event(f"s{n}", at, account_id=account) for n, (account, at) in enumerate(clock)]
    rows += [event(f"long{n}", f"{n // 4}:{n % 4 * 15:02d}", account_id="long") for n in range(60)]
    found = {(r.account_id, r.session_start.strftime("%H:%M")): r for r in account_sessions(events(spark, *rows), parts=parts).collect()}
    counts = {key: (r.session_end.strftime("%H:%M"), r.txn_count) for key, r in found.items()}
    assert counts == {("x", "01:00"): ("02:00", 2), ("x", "02:01"): ("02:31", 1), ("y", "01:10"): ("02:09", 3), ("long", "00:00"): ("15:15", 60)}
    run(spark, tmp_path, rows, account_sessions, "sessions")
    run(spark, tmp_path, [event("end", "23:00", account_id="end")], account_sessions, "sessions")
    run(spark, tmp_path, [event("last", "23:30", account_id="end")], account_sessions, "sessions")
    stored = spark.read.parquet(str(tmp_path / "sessions"))
    batch = account_sessions(events(spark, *rows), parts=parts)
    assert stored.exceptAll(batch).count() == batch.exceptAll(stored).count() == 0


def test_sliding_windows(spark):
    rows = [event("a", "1:00", "5.00"), event("b", "1:19", "7.00"), event("c", None)]
    found = {r.window_start.strftime("%H:%M"): (r.txn_count, float(r.amount_sum)) for r in sliding_windows(events(spark, *rows)).collect()}
    assert found == {"00:40": (1, 5.0), "00:50": (2, 12.0), "01:00": (2, 12.0), "01:10": (1, 7.0)}
    assert sliding_windows(events(spark, *rows)).agg(F.sum("txn_count")).first()[0] == 6


def test_rows_of_a_key_are_sorted_on_disk():
    """No list of all rows of a key: beyond the worker's memory the sorter spills."""
    made_row = Row("transaction_id", "event_micros")
    many = list(range(300_000))
    random.Random(3).shuffle(many)
    spilled = shuffle.DiskBytesSpilled
    found = _in_order((made_row(f"t{n:06d}", None if n < 2 else n // 3) for n in many), 1)
    assert not isinstance(found, list) and shuffle.DiskBytesSpilled > spilled
    assert all(row.transaction_id == f"t{n:06d}" for n, row in enumerate(found))
