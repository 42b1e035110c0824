"""The account state over many rows of one key, and over values that frames can't tell apart."""

from __future__ import annotations

import functools
import math
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskflow.contract import transaction_schema
from riskflow.operators.parse import with_event_time
from riskflow.streaming import keyed, runs
from riskflow.streaming.keyed import AccountState, account_state, start_keyed

START = 1_704_067_200_000_000
NAN = float("nan")


class Kept:
    """A value state without Spark."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def frames(rows, size):
    names = ["account_id", "transaction_id", "event_micros", "latitude", "longitude", "country", "known"]
    for start in range(0, len(rows), size):
        yield pd.DataFrame(rows[start : start + size], columns=names)


def plain(rows, newest, hours):
    """One row after the other."""
    found = []
    for _, name, at, latitude, longitude, country, known in sorted(rows, key=lambda r: (r[2], r[1] or "")):
        if not known & 1:
            found.append((name, 0, 0, None, 0, 0, False))
            continue
        hour = at // 3_600_000_000 % 24
        place = (at, name or "")
        behind = newest is not None and place < newest[0]
        seen = newest[1] if newest and not behind else (0, 0, None)
        found.append((name, *seen, sum(hours), hours[hour], behind))
        hours[hour] += 1
        if not behind:
            newest = (place, (at, latitude, country))
    return found, newest


def made(many, seed, at=START):
    draw = random.Random(seed)
    rows = []
    for n in range(many):
        known = 7 if draw.random() > 0.02 else 6
        time = at + draw.randrange(40_000) * 9_000_000 if known & 1 else (1 << 63) - 1
        rows.append(("a", f"t{seed}-{n}", time, float(n), 2.0, ("DE", "IN")[n % 2], known))
    return rows


def test_rows_of_a_key_leave_in_small_frames(monkeypatch):
    """Spark sends a frame as it comes; ``Row`` objects of a key it gathers in one list and sends as one batch."""
    written = []
    counted = lambda *a: written.append(1) or kept(*a)
    kept = runs._written
    monkeypatch.setattr(runs, "_written", counted)
    monkeypatch.setattr(runs, "BLOCK_ROWS", 512)
    monkeypatch.setattr(keyed, "FRAME_ROWS", 1_000)
    monkeypatch.setattr(keyed, "in_order", functools.partial(runs.in_order, run_bytes=100_000, fan_in=3))
    state = AccountState(None)
    state.newest = Kept()
    newest, hours = None, [0] * 24
    for batch in range(2):  # the second starts amid the first
        rows = made(20_000, batch, START + batch * 200_000_000_000)
        found = []
        for frame in state.handleInputRows(("a",), frames(rows, 700), None):
            assert isinstance(frame, pd.DataFrame) and 0 < len(frame) <= 1_000
            assert set(frame["account_id"]) == {"a"}
            found += zip(
                frame["transaction_id"], frame["previous_event_micros"], frame["previous_latitude"],
                frame["previous_country"], frame["prior_count"], frame["prior_same_hour"], frame["out_of_order"],
            )
        expected, newest = plain(rows, newest, hours)
        assert sorted(found) == sorted(expected)
        assert any(row[-1] for row in found) == (batch == 1)
        assert state.newest.value[1] == newest[0][0] and state.newest.value[5] == hours
    assert len(written) > 20


@pytest.mark.parametrize("run_bytes", [1 << 30, 4_000])
def test_runs_are_merged_in_order(run_bytes, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK_ROWS", 64)
    draw = random.Random(5)
    rows = [(draw.randrange(40), draw.choice(["", "a", "é", "\U0001f600"]), n) for n in range(6_000)]
    parts = (rows[n : n + 90] for n in range(0, len(rows), 90))
    batches = (pa.record_batch([pa.array(column) for column in zip(*part)], ["at", "id", "n"]) for part in parts)
    tables = list(runs.in_order(batches, ("at", "id", "n"), run_bytes, 4))
    if run_bytes < 1 << 30:  # no table holds more than the blocks of the merged runs
        assert max(table.num_rows for table in tables) <= 4 * 3 * 64
    found = [tuple(row.values()) for table in tables for row in table.to_pylist()]
    assert found == sorted(rows)
    assert list(runs.in_order(iter([]), ("at",))) == []


def test_null_nan_and_far_times(spark, tmp_path):
    """NaN is not null, times beyond 2262 and before 1677 are kept, a row behind the watermark is dropped."""
    columns = "transaction_id string, account_id string, event_timestamp string, latitude double, longitude double, country string"
    files = [
        [("b", None, "2024-01-01 01:00:00.000001", NAN, None, None), (None, None, "2024-01-01 00:59:00", -0.0, math.inf, "DE"), ("n", None, None, NAN, None, "")],
        [("c", None, "2024-01-01 01:30:00", None, NAN, "IN"), ("far", "z", "9998-12-31 23:59:59.999999", 1.0, 2.0, "US"), ("old", "z", "1500-01-01 00:00:00", 3.0, 4.0, "US")],
    ]
    for rows in files:
        new = spark.createDataFrame(rows, columns).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
        new = new.select(*[(F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in transaction_schema()])
        new.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = with_event_time(spark.readStream.schema(transaction_schema()).parquet(str(tmp_path / "in")), "10 minutes")
        start_keyed(account_state(stream), "odd", str(tmp_path / "odd"), str(tmp_path / "odd-cp"), None, 3).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "odd"))
    texts = stored.select(*[F.col(name).cast("string").alias(name) for name in stored.columns])
    found = {row[0]: tuple(row)[2:] for row in texts.collect()}
    assert found == {
        None: ("2024-01-01 00:59:00", "-0.0", "Infinity", "DE", None, None, None, None, "0", "0", "false"),
        "b": ("2024-01-01 01:00:00.000001", "NaN", None, None, "2024-01-01 00:59:00", "-0.0", "Infinity", "DE", "1", "0", "false"),
        "n": (None, "NaN", None, "", None, None, None, None, "0", "0", "false"),
        "c": ("2024-01-01 01:30:00", None, "NaN", "IN", "2024-01-01 01:00:00.000001", "NaN", None, None, "2", "1", "false"),
        "far": ("9998-12-31 23:59:59.999999", "1.0", "2.0", "US", None, None, None, None, "0", "0", "false"),
    }
