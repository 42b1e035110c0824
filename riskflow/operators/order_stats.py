"""Order statistics of an account's recent amounts: rank of the own amount, and the rolling median.

Accounts of up to ``BIN_ROWS`` rows are each finished in one task, several small ones together: rows in order of
time make a window a range of positions, and a pass over the bits of the amounts' places, from the top, answers all
windows at once with counts of zeros (a wavelet matrix in arrays).

Larger accounts are first cut into bins of amounts. Amounts are whole numbers of cents, read as digits
of four bits from the top. One pass per digit counts, for each transaction, the digits of the earlier rows
of its window that share a prefix: the prefix of its own amount, which adds up to its rank,
and the prefix found so far of the median, which grows by the digit where the count reaches the middle.
A count over a window is the difference of two running totals, and these run through
``riskflow.operators.carry``, keyed by account and prefix and cut by count, so an account that holds all rows
is spread over tasks. As soon as no bin holds more than ``BIN_ROWS`` amounts, the bins are finished like small accounts,
many searches of one bin in several tasks. The number of passes follows from the range of the amounts, at most eleven
for the contract's money, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.behaviour import HISTORY_DAYS
from riskflow.operators.carry import micros, totals_at
from riskflow.session import drop_folder, shared_folder, ship_package, stored_table

BITS = 4
DIGITS = 1 << BITS
# Rows of one account, or amounts of one bin, that a task holds; rows of small accounts that share a task.
BIN_ROWS = 3_000_000
SHARED_ROWS = 50_000
_COUNTS = [f"d{digit}" for digit in range(DIGITS)]


def _shifted(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def _digit(value: Column, shift: int) -> Column:
    return _shifted(value, shift).bitwiseAND(DIGITS - 1)


def _window_counts(state: DataFrame, history: str, shift: int, parts: int | None) -> DataFrame:
    """``of_median`` and ``of_own`` per transaction: counts of the next digit of the window's rows."""
    added = state.where("value is not null").select(
        "account_id",
        _shifted(F.col("value"), shift + BITS).alias("prefix"),
        "at",
        "transaction_id",
        *[(_digit(F.col("value"), shift) == digit).cast("bigint").alias(name) for digit, name in enumerate(_COUNTS)],
    )
    own = _shifted(F.col("value"), shift + BITS)
    # A window is [t - history, t): rows up to just before t, less rows up to just before its start.
    points = [
        F.struct(F.lit(tag).alias("probe"), prefix.alias("prefix"), (F.col("at") - F.lit(offset)).alias("at"))
        for tag, prefix in (("median", F.col("median")), ("own", own))
        for tag, offset in ((f"{tag}_now", 1), (f"{tag}_edge", micros(history) + 1))
    ]
    reads = state.select("account_id", "transaction_id", F.inline(F.array(*points))).where("prefix is not null")
    totals = totals_at(added, reads, ["account_id", "prefix"], _COUNTS, parts)

    def within(tag: str) -> Column:
        def read(point: str, name: str) -> Column:
            return F.coalesce(F.max(F.when(F.col("probe") == f"{tag}_{point}", F.col(name))), F.lit(0))

        return F.array(*[read("now", name) - read("edge", name) for name in _COUNTS]).alias(f"of_{tag}")

    return totals.groupBy("transaction_id").agg(within("median"), within("own"))


def _added_up(counts: Column, upto: Column) -> Column:
    """Sum of the first ``upto`` counts."""
    return F.aggregate(F.slice(counts, F.lit(1), upto.cast("int")), F.lit(0).cast("bigint"), lambda total, n: total + n)


def _positions(values: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, place: np.ndarray):
    """Per range ``[left, right)`` of positions: how many values are ``own`` or less, and the value at ``place`` (from 0)
    of the sorted range."""
    distinct, codes = np.unique(values, return_inverse=True)
    codes = codes.astype(np.int32)
    upto = np.searchsorted(distinct, own, "right").astype(np.int32)
    low, high, k = left.astype(np.int32), right.astype(np.int32), place.astype(np.int32)
    own_low, own_high = low.copy(), high.copy()
    count, found = np.zeros(len(low), np.int32), np.zeros(len(low), np.int32)
    zeros = np.zeros(len(codes) + 1, np.int32)
    for bit in reversed(range(len(distinct).bit_length())):
        one = (codes >> bit & 1).astype(bool)
        np.cumsum(~one, out=zeros[1:])
        first_one = zeros[-1]
        z_low, z_high = zeros[low], zeros[high]
        up = k >= z_high - z_low
        k -= np.where(up, z_high - z_low, 0)
        found |= up.astype(np.int32) << bit
        low, high = np.where(up, low - z_low + first_one, z_low), np.where(up, high - z_high + first_one, z_high)
        z_low, z_high = zeros[own_low], zeros[own_high]
        up = (upto >> bit & 1).astype(bool)
        count += np.where(up, z_high - z_low, 0)
        own_low = np.where(up, own_low - z_low + first_one, z_low)
        own_high = np.where(up, own_high - z_high + first_one, z_high)
        codes = np.concatenate([codes[~one], codes[one]])
    if not len(distinct):
        return count, np.zeros(len(low), np.int64)
    return count, distinct[np.minimum(found, len(distinct) - 1)]


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values, 0 where there is none, and which are there."""
    return pc.fill_null(column, 0).to_numpy(), pc.is_valid(column).to_numpy()


def _whole_accounts(span: int, quantile: float):
    """All windows of a few accounts that are there with all their rows."""

    def found(rows: pa.Table) -> pa.Table:
        account = pc.dictionary_encode(rows["account_id"].combine_chunks(), null_encoding="encode").indices.to_numpy()
        order = np.lexsort((rows["at"].to_numpy(), account))
        account, at = account[order], rows["at"].to_numpy()[order]
        value, priced = (part[order] for part in _numbers(rows["value"]))
        before = np.concatenate([[0], np.cumsum(priced)])
        left, right = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        edges = [0, *(np.flatnonzero(np.diff(account)) + 1), len(at)]
        for start, end in zip(edges[:-1], edges[1:]):
            own = at[start:end]
            left[start:end] = before[start + np.searchsorted(own, own - span)]
            right[start:end] = before[start + np.searchsorted(own, own)]
        n = right - left
        place = np.maximum(np.ceil(n * quantile), 1).astype(np.int64) - 1
        below, median = _positions(value[priced], left, right, value, place)
        # A row without an id has no history of its own, though it is in those of others.
        taken = rows.select(["transaction_id", "cents"]).take(pa.array(order))
        n = np.where(pc.is_valid(taken["transaction_id"]).to_numpy(), n, 0)
        none = n == 0
        return pa.table(
            {
                "transaction_id": taken["transaction_id"],
                "cents": taken["cents"],
                "n": pa.array(n, pa.int64()),
                "below": pa.array(below.astype(np.int64), mask=none | ~priced),
                "median": pa.array(median.astype(np.int64), mask=none),
            }
        )

    return found


def _in_bin(span: int):
    """Searches in one bin: amounts of a window up to one's own, or the amount at a place of the sorted window."""

    def found(amounts: pa.Table, searches: pa.Table) -> pa.Table:
        at, value = amounts["at"].to_numpy(), amounts["value"].to_numpy()
        order = np.argsort(at, kind="stable")
        at, value = at[order], value[order]
        until, want = searches["at"].to_numpy(), searches["want"].to_numpy()
        left, right = np.searchsorted(at, until - span), np.searchsorted(at, until)
        of_own = pc.equal(searches["search"], "own").to_numpy()
        count, placed = _positions(value, left, right, want, np.where(of_own, 0, want - 1))
        return pa.table(
            {
                "transaction_id": searches["transaction_id"],
                "search": searches["search"],
                "found": pa.array(np.where(of_own, count, placed).astype(np.int64)),
            }
        )

    return found


def _finished(state: DataFrame, history: str, shift: int) -> DataFrame:
    """``state`` with ``below`` and ``median`` complete: each bin of ``shift`` undecided bits fits a task."""
    place = ["account_id", "bin"]
    own = F.struct(F.lit("own").alias("search"), _shifted(F.col("value"), shift).alias("bin"), F.col("value").alias("want"))
    middle = F.struct(F.lit("median").alias("search"), F.col("median").alias("bin"), F.col("rank").alias("want"))
    searches = state.select("transaction_id", "account_id", "at", F.inline(F.array(own, middle))).where("bin is not null")
    # Many searches of one bin are dealt to several tasks, each with the bin's amounts.
    tasks = searches.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / BIN_ROWS).cast("int").alias("tasks")).where("tasks > 1")
    tasks = F.broadcast(tasks.select(F.col("account_id").alias("of_account"), F.col("bin").alias("of_bin"), "tasks"))
    same = F.col("account_id").eqNullSafe(F.col("of_account")) & (F.col("bin") == F.col("of_bin"))
    many = F.coalesce("tasks", F.lit(1))
    searches = searches.join(tasks, same, "left").withColumn("task", F.pmod(F.xxhash64("transaction_id"), many).cast("int"))
    amounts = state.where("value is not null").select("account_id", _shifted(F.col("value"), shift).alias("bin"), "at", "value")
    amounts = amounts.join(tasks, same, "left").withColumn("task", F.explode(F.sequence(F.lit(0), many - 1)))
    # Both come from one table: columns of the same name have to be told apart.
    apart = [F.col(name).alias(name) for name in (*place, "task", "at", "value")]
    found = (
        amounts.select(*apart)
        .groupBy(*place, "task")
        .cogroup(searches.select(*place, "task", "transaction_id", "search", "at", "want").groupBy(*place, "task"))
        .applyInArrow(_in_bin(micros(history)), "transaction_id string, search string, found bigint")
    )
    of = {search: F.max(F.when(F.col("search") == search, F.col("found"))) for search in ("own", "median")}
    found = found.groupBy("transaction_id").agg(of["own"].alias("of_own"), of["median"].alias("of_median"))
    return state.join(found, "transaction_id", "left").select(
        "transaction_id", "cents", "n", (F.col("below") + F.coalesce("of_own", F.lit(0))).alias("below"), F.col("of_median").alias("median")
    )


def _large_accounts(
    timed: DataFrame, history: str, quantile: float, parts: int | None, most: int, span: int
) -> DataFrame:
    """Place and median of accounts that are cut into bins of ``most`` amounts; ``value`` is at most ``span``."""
    spark = timed.sparkSession
    steps = max(1, -(-span.bit_length() // BITS))
    nothing = F.lit(0).cast("bigint")
    state = timed.withColumns(
        {"median": nothing, "rank": F.lit(None).cast("bigint"), "below": nothing, "n": nothing}
    )
    folder = None
    for step in range(steps):
        shift = BITS * (steps - 1 - step)
        found = state.join(_window_counts(state, history, shift, parts), "transaction_id", "left")
        counts, own = F.col("of_median"), F.col("of_own")
        if step == 0:
            n = _added_up(counts, F.lit(DIGITS))
            found = found.withColumn("n", F.coalesce(n, nothing)).withColumn(
                "rank", F.greatest(F.ceil(F.col("n") * F.lit(quantile)), F.lit(1))
            )
        # The first digit at which the counts reach the wanted rank.
        digits = F.sequence(F.lit(0), F.lit(DIGITS - 1))
        reached = F.filter(digits, lambda d: _added_up(counts, d + 1) >= F.col("rank"))
        smaller = F.coalesce(_added_up(own, _digit(F.col("value"), shift)), nothing)
        last = F.coalesce(F.element_at(own, (_digit(F.col("value"), shift) + 1).cast("int")), nothing)
        found = (
            found.withColumn("digit", F.when(F.size(reached) > 0, F.get(reached, F.lit(0))))
            .withColumn("rank", F.col("rank") - _added_up(counts, F.col("digit")))
            .withColumn("median", F.col("median") * DIGITS + F.col("digit"))
            .withColumn("below", F.col("below") + smaller + (last if step == steps - 1 else nothing))
            .select(*state.columns)
        )
        before, folder = folder, shared_folder(spark, "order-stats")
        found.write.parquet(folder)
        state = spark.read.schema(found.schema).parquet(folder)
        if before:
            drop_folder(spark, before)
        if shift and most:
            bins = state.where("value is not null").groupBy("account_id", _shifted(F.col("value"), shift).alias("bin"))
            if bins.count().agg(F.max("count")).first()[0] <= most:
                return _finished(state, history, shift)
    return state.select("transaction_id", "cents", "n", "below", "median")


def amount_order(
    events: DataFrame, history: str = HISTORY_DAYS, quantile: float = 0.5, parts: int | None = None
) -> DataFrame:
    """The amount's place among the account's earlier amounts of ``history``, and their median.

    ``transaction_id``, ``prior_amount_count``, ``amount_percentile`` (share of earlier amounts that are no
    larger), ``rolling_median`` (the ``ceil(quantile * n)``-th smallest of n) and ``amount_vs_median``.
    Rows at the same instant are not earlier. A row without an amount has no percentile and counts
    for nobody; without time, or without earlier amounts, everything but the count is NULL. ``transaction_id``
    must be unique.
    """
    ship_package(events.sparkSession)
    cents = (F.col("amount") * 100).cast("bigint")
    base = events.select("transaction_id", "account_id", F.unix_micros("event_timestamp").alias("at"), cents.alias("cents"))
    timed = base.where("at is not null")
    low, high, rows = timed.agg(F.min("cents"), F.max("cents"), F.count(F.lit(1))).first()
    timed = timed.withColumn("value", F.col("cents") - F.lit(low or 0))
    most = 0 if parts else BIN_ROWS
    # At most one row per ``SHARED_ROWS`` rows, so it may be broadcast.
    sizes = timed.groupBy(F.col("account_id").alias("of_account")).agg(F.count(F.lit(1)).alias("size"))
    sizes = stored_table(sizes.where(F.col("size") > min(most, SHARED_ROWS)), "account-sizes")
    sized = timed.join(F.broadcast(sizes), F.col("account_id").eqNullSafe(F.col("of_account")), "left")
    alone = F.col("size").isNotNull()
    shared = F.pmod(F.xxhash64("account_id"), F.lit(max(1, -(-rows // SHARED_ROWS))))
    whole = sized.where(~alone | (F.col("size") <= most)).select(
        "transaction_id", "account_id", "at", "value", "cents",
        F.when(alone, F.col("account_id")).alias("own_task"), F.when(~alone, shared).alias("shared_task"),
    )
    ordered = whole.groupBy("own_task", "shared_task").applyInArrow(
        _whole_accounts(micros(history), quantile),
        "transaction_id string, cents bigint, n bigint, below bigint, median bigint",
    )
    if not sizes.where(F.col("size") > most).isEmpty():
        large = sized.where(F.col("size") > most).select(*timed.columns)
        cut = _large_accounts(large, history, quantile, parts, most, int((high or 0) - (low or 0)))
        ordered = ordered.unionByName(cut)
    known = F.col("n") > 0
    median = F.when(known, (F.col("median") + F.lit(low or 0)) / 100)
    percentile = F.when(known & F.col("cents").isNotNull(), F.col("below") / F.col("n"))
    found = ordered.select(
        "transaction_id",
        F.col("n").alias("prior_amount_count"),
        percentile.alias("amount_percentile"),
        median.alias("rolling_median"),
        (F.col("cents") / 100 / F.nullif(median, F.lit(0.0))).alias("amount_vs_median"),
    )
    untimed = base.where("at is null").select("transaction_id", F.lit(0).cast("bigint").alias("prior_amount_count"))
    return found.unionByName(untimed, allowMissingColumns=True)
