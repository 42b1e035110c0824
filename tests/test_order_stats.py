"""Rank and rolling median of amounts against a sort of every window."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest

from riskflow.operators import order_stats
from riskflow.operators.order_stats import amount_order

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def made(rng, many, accounts, amounts):
    rows = []
    for n in range(many):
        at = START + timedelta(minutes=rng.randrange(900)) if rng.random() < 0.97 else None
        amount = None if rng.random() < 0.05 else Decimal(rng.choice(amounts)).scaleb(-2)
        rows.append({"transaction_id": f"t{n}", "account_id": f"a{rng.randrange(accounts)}", "event_timestamp": at, "amount": amount})
    return rows


def plain(rows, minutes, quantile):
    out = {}
    for row in rows:
        at, own = row["event_timestamp"], row["amount"]
        if at is None:
            out[row["transaction_id"]] = (0, None, None, None)
            continue
        earlier = sorted(
            other["amount"]
            for other in rows
            if other["account_id"] == row["account_id"]
            and None not in (other["event_timestamp"], other["amount"])
            and at - timedelta(minutes=minutes) <= other["event_timestamp"] < at
        )
        n = len(earlier)
        median = float(earlier[max(1, math.ceil(n * quantile)) - 1]) if n else None
        share = sum(a <= own for a in earlier) / n if n and own is not None else None
        ratio = float(own) / median if median and own is not None else None
        out[row["transaction_id"]] = (n, share, median, ratio)
    return out


def frame(spark, rows):
    schema = "transaction_id string, account_id string, event_timestamp timestamp, amount decimal(12,2)"
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in ("transaction_id", "account_id", "event_timestamp", "amount")) for r in rows], schema)


@pytest.mark.parametrize(
    "accounts, amounts, parts, quantile",
    [
        (4, range(100, 60_000, 7), None, 0.5),
        (1, range(-500, 500), 8, 0.5),  # one account holds all rows, in eight parts
        (1, (250,), 8, 0.5),  # and one amount
        (2, (1, 10**12 - 1, -(10**11)), 3, 0.9),  # the whole range of the contract's money
    ],
)
def test_amount_order(spark, accounts, amounts, parts, quantile):
    rows = made(random.Random(accounts), 260, accounts, amounts)
    found = amount_order(frame(spark, rows), "2 hours", quantile, parts).collect()
    want = plain(rows, 120, quantile)
    assert len(found) == len(rows)
    for r in found:
        got = (r.prior_amount_count, r.amount_percentile, r.rolling_median, r.amount_vs_median)
        assert got[0] == want[r.transaction_id][0]
        for one, other in zip(got[1:], want[r.transaction_id][1:]):
            assert one is other if other is None else one == pytest.approx(other, rel=1e-9)


def test_one_instant_and_nothing(spark):
    same = [{"transaction_id": f"t{n}", "account_id": "a", "event_timestamp": START, "amount": Decimal(n)} for n in range(40)]
    late = [{"transaction_id": "late", "account_id": "a", "event_timestamp": START + timedelta(seconds=1), "amount": Decimal("9.50")}]
    found = {r.transaction_id: r for r in amount_order(frame(spark, same + late), parts=5).collect()}
    assert all(found[f"t{n}"].prior_amount_count == 0 and found[f"t{n}"].rolling_median is None for n in range(40))
    assert (found["late"].prior_amount_count, found["late"].amount_percentile, found["late"].rolling_median) == (40, 0.25, 19.0)
    assert amount_order(frame(spark, [])).count() == 0
    bare = [{"transaction_id": "x", "account_id": "a", "event_timestamp": None, "amount": None}]
    assert amount_order(frame(spark, bare)).first().prior_amount_count == 0


@pytest.mark.parametrize(
    "bin_rows, shared, amounts",
    [
        (3_000_000, 50_000, (1, 10**12 - 1, -(10**11))),
        (3_000_000, 30, range(100, 60_000, 7)),
        (70, 30, range(100, 60_000, 7)),
        (16, 4, (*range(-2_000, 2_000, 9), *(77,) * 300)),  # one amount fills more than a bin
    ],
)
def test_accounts_of_all_sizes(spark, monkeypatch, bin_rows, shared, amounts):
    """Small accounts share a task, larger ones have their own, the largest are cut into bins until these fit."""
    monkeypatch.setattr(order_stats, "BIN_ROWS", bin_rows)
    monkeypatch.setattr(order_stats, "SHARED_ROWS", shared)
    rng = random.Random(bin_rows)
    rows = made(rng, 200, 3, amounts) + [dict(r, transaction_id=f"b{n}", account_id=None) for n, r in enumerate(made(rng, 25, 1, amounts))]
    want = plain(rows, 120, 0.5)
    found = amount_order(frame(spark, rows), "2 hours").collect()
    assert len(found) == len(rows)
    for r in found:
        got = (r.prior_amount_count, r.amount_percentile, r.rolling_median, r.amount_vs_median)
        for one, other in zip(got, want[r.transaction_id]):
            assert one is other if other is None else one == pytest.approx(other, rel=1e-9)


def test_small_accounts_need_no_digits(spark, monkeypatch):
    """Accounts that fit a task are read in one pass; passes over digits are for larger ones."""
    monkeypatch.setattr(order_stats, "_window_counts", None)
    rows = made(random.Random(5), 100, 3, range(1, 10**6))
    assert {r.transaction_id: r.prior_amount_count for r in amount_order(frame(spark, rows), "2 hours").collect()} == {
        name: found[0] for name, found in plain(rows, 120, 0.5).items()
    }
