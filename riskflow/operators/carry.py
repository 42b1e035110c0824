"""Ordered history per key without putting a whole key into one task.

A window partitioned by account alone sends a hot account to a single task. Here rows are
cut by count: Spark's range partitioner orders them by key, time and id into parts of
about equal size, wherever a key or an instant begins or ends, and the parts are written as a
table. A map-side pre-aggregated pass computes what each part of a key passes on to the
next; that summary (one row per key and part) is turned into a *carry row* placed at the
front of the part it is meant for, and the ordinary window then runs per (part, key). Results
equal those of the uncut window, also where one instant is spread over several parts.

Rows without a time belong to no history: they stay in the result with NULLs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.session import stored_table

MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}
# Rows of a key in one part of running totals, the sampled rows of a part, and how many cuts may fall on one instant.
PART_ROWS = 100_000
MARKS = 64
CROWDED = 8


def micros(span: str) -> int:
    """``"30 minutes"`` -> microseconds."""
    amount, unit = span.split()
    return int(amount) * MICROS[unit.rstrip("s")]


def in_parts(rows: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows with ``carry_part``, the number of the range of ``order`` they fall into.

    Written, because the summary and the window must see the same cuts. Without ``parts``
    Spark chooses how many, from the data's size.
    """
    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    return stored_table(ranged.withColumn("carry_part", F.spark_partition_id()), "parts")


def _total_type(measure: T.DataType) -> T.DataType:
    """The type a sum of the measure keeps, so that carried sums can be summed again."""
    if isinstance(measure, T.DecimalType):
        return T.DecimalType(38, measure.scale)
    return T.LongType() if isinstance(measure, T.IntegralType) else T.DoubleType()


def with_previous(
    events: DataFrame,
    key: Sequence[str],
    columns: Mapping[str, str],
    parts: int | None = None,
) -> DataFrame:
    """Add columns of the same key's preceding row by (event_timestamp, transaction_id).

    ``columns`` maps a new name to the source column, as in
    ``{"previous_country": "country"}``; the first row of a key gets NULLs.
    """
    ordering = ["event_timestamp", "transaction_id"]
    current = F.struct(*[F.col(source).alias(new) for new, source in columns.items()])
    timed = events.where(F.col("event_timestamp").isNotNull()).withColumn("current", current)
    rows = in_parts(timed, [*key, *ordering], parts)
    passed = rows.groupBy(*key, "carry_part").agg(
        F.max_by("current", F.struct(*ordering)).alias("current")
    )
    carry = passed.select(
        *key,
        F.lead("carry_part").over(W.partitionBy(*key).orderBy("carry_part")).alias("carry_part"),
        "current",
    ).where(F.col("carry_part").isNotNull())
    # A carry row has no time, so it sorts first.
    ordered = W.partitionBy("carry_part", *key).orderBy(*ordering)
    linked = (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumn("before", F.lag("current").over(ordered))
        .where(F.col("event_timestamp").isNotNull())
        .select(*events.columns, *[F.col(f"before.{new}").alias(new) for new in columns])
    )
    untimed = events.where(F.col("event_timestamp").isNull())
    return linked.unionByName(untimed, allowMissingColumns=True)


def _cuts(timed: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key`` and ``cuts``: the times at which a key with many rows is cut, one per ``PART_ROWS`` rows.

    They come from the times of a hash sample, as those of Spark's range partitioner; the sample decides where a
    key is cut and nothing else. ``repeated`` counts cuts that fall on an instant that has one already.
    """
    marks = min(MARKS, PART_ROWS)
    drawn = timed.where(F.pmod(F.xxhash64("transaction_id", "at"), F.lit(PART_ROWS // marks)) == 0)
    times = drawn.groupBy(*key).agg(F.sort_array(F.collect_list("at")).alias("times"))
    every = F.filter("times", lambda _, n: (n > 0) & (n % marks == 0))
    cuts = times.select(*key, F.array_distinct(every).alias("cuts"), F.size(every).alias("repeated"))
    return cuts.where("repeated > 0").withColumn("repeated", F.col("repeated") - F.size("cuts"))


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Rows of one key; a missing key is a key of its own, as in a window."""
    return reduce(and_, [one.eqNullSafe(other) for one, other in zip(left, right)])


def _part_of(at: Column, cuts: Column, most: int) -> Column:
    """How many of the sorted ``cuts`` (``most`` or fewer) are not after ``at``, by bisection."""
    strides = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])

    def further(found: Column, stride: Column) -> Column:
        return found + F.when(F.get(cuts, found + stride - 1) <= at, stride).otherwise(0)

    return F.when(cuts.isNull(), 0).otherwise(F.aggregate(strides, F.lit(0), further))


def running_totals(
    events: DataFrame,
    key: Sequence[str],
    measures: Mapping[str, Column],
    probes: Mapping[str, int],
    parts: int | None = None,
    previous: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exact totals per key up to several points in time before each transaction.

    ``probes`` maps a name to how many microseconds before the event to look: probe
    ``p`` of measure ``m`` is the sum of ``m`` over the key's rows with
    ``time <= event time - offset``, as column ``p_m`` next to ``transaction_id``.
    The difference of two probes is a rolling total. Measures should be whole numbers
    or decimals, so that the differences are exact. ``transaction_id`` must be unique.

    ``previous`` adds columns of the key's preceding row by (event_timestamp, transaction_id), as
    ``with_previous`` does, from the same parts.

    A row adds to probe ``p`` from ``offset`` after its time on, so each row finds its totals where it
    stands. Keys are cut in time; with ``parts``, or where one instant holds many parts, by the range partitioner.
    """
    names, previous = list(measures), previous or {}
    if parts:
        return _totals_by_range(events, key, measures, probes, parts, previous)
    before_it = F.struct(*[F.col(source).alias(new) for new, source in previous.items()]) if previous else F.lit(None)
    typed = events.select(
        *key,
        "transaction_id",
        F.unix_micros("event_timestamp").alias("at"),
        *[measure.alias(name) for name, measure in measures.items()],
        before_it.alias("current"),
    )
    types = {name: _total_type(typed.schema[name].dataType) for name in names}
    typed = typed.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
    timed = typed.where("at is not null")
    newest = timed.agg(F.max("at")).first()[0]
    cuts = stored_table(_cuts(timed, key), "cuts")
    most, repeated = cuts.agg(F.max(F.size("cuts")), F.max("repeated")).first()
    if (repeated or 0) >= CROWDED:
        return _totals_by_range(events, key, measures, probes, None, previous)

    # Kind 0 is the row itself, which the probes of its own time read; others are its later effect on a probe.
    kinds = {tag: kind for kind, tag in enumerate((tag for tag, offset in probes.items() if offset > 1), 1)}
    points = [F.struct(F.lit(0).alias("kind"), F.col("at").alias("seen_at"))]
    points += [F.struct(F.lit(kind).alias("kind"), (F.col("at") + probes[tag]).alias("seen_at")) for tag, kind in kinds.items()]
    spread = timed.select(*key, "transaction_id", *names, "current", F.inline(F.array(*points)))
    # Nobody reads after the newest row.
    spread = spread.where((F.col("kind") == 0) | (F.col("seen_at") <= F.lit(newest))).withColumns(
        {name: F.when(F.col("kind") == 0, F.col(name)) for name in ("transaction_id", "current")}
    )
    if most:
        of_key = cuts.select(*[F.col(name).alias(f"cut_{name}") for name in key], "cuts")
        same = _same([F.col(name) for name in key], [F.col(f"cut_{name}") for name in key])
        spread = spread.join(F.broadcast(of_key), same, "left").withColumn("part", _part_of(F.col("seen_at"), F.col("cuts"), most))
    else:
        spread = spread.withColumn("part", F.lit(0))

    ordered = W.partitionBy(*key, "part").orderBy("seen_at")
    frames = {
        tag: ordered.rangeBetween(W.unboundedPreceding, -1 if offset == 1 else 0) for tag, offset in probes.items()
    }

    def of_kind(name: str, kind: int) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col(name)))

    summed = spread.select(
        *key, "part", "kind", "seen_at", "transaction_id", "current",
        *[of_kind(name, kinds.get(tag, 0)).over(frames[tag]).alias(f"{tag}_{name}") for tag in probes for name in names],
    ).where("kind = 0")
    if previous:
        line = W.partitionBy(*key, "part").orderBy("seen_at", "transaction_id")
        again = F.coalesce(F.lag("transaction_id").over(line) == F.col("transaction_id"), F.lit(False))
        summed = summed.withColumns({"before": F.lag("current").over(line), "again": again})
    if most:
        # At most one row per cut, so it may be broadcast.
        place = [F.col(name) for name in (*key, "part")]
        carry_place = [F.col(f"carry_{name}") for name in (*key, "part")]
        crossing = spread.where("cuts is not null")
        held = [of_kind(name, kind).alias(f"kind{kind}_{name}") for kind in (0, *kinds.values()) for name in names]
        per_part = crossing.groupBy(*key, "part").agg(*held)
        per_part = per_part.select(*[one.alias(f"carry_{name}") for name, one in zip((*key, "part"), place)], *per_part.columns[len(place):])
        if previous:
            last = crossing.where("kind = 0").groupBy(*key, "part").agg(
                F.max_by("current", F.struct("seen_at", "transaction_id")).alias("last_before")
            )
            per_part = per_part.join(last, _same(place, carry_place), "left").drop(*key, "part")
        earlier = W.partitionBy(*carry_place[:-1]).orderBy("carry_part").rowsBetween(W.unboundedPreceding, -1)
        carry = per_part.select(
            *carry_place,
            *[F.sum(f"kind{kind}_{name}").over(earlier).alias(f"kind{kind}_{name}") for kind in (0, *kinds.values()) for name in names],
            *([F.last("last_before", ignorenulls=True).over(earlier).alias("last_before")] if previous else []),
        )
        summed = summed.join(F.broadcast(carry), _same(place, carry_place), "left")

    def total(tag: str, name: str) -> Column:
        nothing = F.lit(0).cast(types[name])
        own = F.coalesce(F.col(f"{tag}_{name}"), nothing)
        # The sum keeps its type: a decimal sum would widen it.
        return ((own + F.coalesce(F.col(f"kind{kinds.get(tag, 0)}_{name}"), nothing)) if most else own).cast(types[name])

    totals = [total(tag, name).alias(f"{tag}_{name}") for tag in probes for name in names]
    if previous:
        # Of copies of a row the last one counts, which follows another copy.
        before = F.coalesce("before", "last_before") if most else F.col("before")
        totals.append(F.struct("seen_at", "again", before.alias("row")).alias("before"))
    found = summed.select("transaction_id", *totals)
    found = found.unionByName(typed.where("at is null").select("transaction_id"), allowMissingColumns=True)
    if previous:
        found = found.where("transaction_id is not null")
    # Dealt before they are grouped: ids are unique, so a map-side step would only sort them once more.
    found = found.repartition("transaction_id").groupBy("transaction_id").agg(*[F.max(name).alias(name) for name in found.columns[1:]])
    return found.select("*", *[F.col(f"before.row.{new}").alias(new) for new in previous]).drop("before")


def _totals_by_range(
    events: DataFrame,
    key: Sequence[str],
    measures: Mapping[str, Column],
    probes: Mapping[str, int],
    parts: int | None,
    previous: Mapping[str, str],
) -> DataFrame:
    """``running_totals`` in parts of Spark's range partitioner, which also cuts a single instant."""
    names = list(measures)
    before_it = F.struct(*[F.col(source).alias(new) for new, source in previous.items()]) if previous else F.lit(None)
    typed = events.select(
        *key,
        "transaction_id",
        F.unix_micros("event_timestamp").alias("at"),
        *[measure.alias(name) for name, measure in measures.items()],
        before_it.alias("current"),
    )
    types = {name: _total_type(typed.schema[name].dataType) for name in names}
    # Only the rows that add to their key carry measures.
    held = F.struct(*[F.col(name).cast(types[name]).alias(name) for name in names], "current")
    added = F.when(F.col("at").isNotNull(), held)

    def point(probe: str | None, offset: int) -> Column:
        """What the row adds to its key, or a place where the totals are read."""
        return F.struct(
            (F.col("at") - F.lit(offset)).alias("seen_at"),
            F.lit(probe).cast("string").alias("probe"),
            (added if probe is None else F.lit(None)).cast(_struct_type(typed, types)).alias("adds"),
        )

    points = [point(None, 0), *[point(tag, offset) for tag, offset in probes.items()]]
    # At one instant all that is added (probe NULL) comes before all that is read.
    ordering = ["seen_at", "probe", "transaction_id"]
    spread = typed.select(*key, "transaction_id", F.inline(F.array(*points)))
    rows = in_parts(spread, [*key, *ordering], parts)
    latest = F.max_by("adds.current", F.when(F.col("adds").isNotNull(), F.struct(*ordering)))
    sums = [F.sum(f"adds.{name}").alias(name) for name in names]
    per_part = rows.groupBy(*key, "carry_part").agg(*sums, latest.alias("current"))
    earlier = W.partitionBy(*key).orderBy("carry_part").rowsBetween(W.unboundedPreceding, -1)
    carried = [F.sum(name).over(earlier).alias(name) for name in names]
    last = F.last("current", ignorenulls=True).over(earlier).alias("current")
    carry = per_part.select(
        *key, "carry_part", F.count(F.lit(1)).over(earlier).alias("parts_before"), F.struct(*carried, last).alias("adds")
    )
    # A carry row has no time, so it sorts before all rows that have one.
    carry = carry.where("parts_before > 0").drop("parts_before")
    ordered = W.partitionBy("carry_part", *key).orderBy(*ordering)
    upto = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = [F.coalesce(F.sum(f"adds.{name}").over(upto), F.lit(0)).alias(name) for name in names]
    if previous:
        strictly = ordered.rowsBetween(W.unboundedPreceding, -1)
        totals.append(F.last("adds.current", ignorenulls=True).over(strictly).alias("before"))
    summed = rows.unionByName(carry, allowMissingColumns=True).select(
        "transaction_id", "probe", "seen_at", *totals
    )

    def read(tag: str, name: str) -> Column:
        here = (F.col("probe") == tag) & F.col("seen_at").isNotNull()
        return F.max(F.when(here, F.col(name))).alias(f"{tag}_{name}")

    own = F.max_by("before", F.when(F.col("probe").isNull() & F.col("seen_at").isNotNull(), F.lit(1))).alias("before")
    kept = summed.where(F.col("transaction_id").isNotNull()) if previous else summed.where(F.col("probe").isNotNull())
    found = kept.groupBy("transaction_id").agg(*[read(tag, name) for tag in probes for name in names], *([own] if previous else []))
    if not previous:
        return found
    return found.select("*", *[F.col(f"before.{new}").alias(new) for new in previous]).drop("before")


def _struct_type(typed: DataFrame, types: Mapping[str, T.DataType]) -> T.StructType:
    fields = [T.StructField(name, kind) for name, kind in types.items()]
    return T.StructType([*fields, T.StructField("current", typed.schema["current"].dataType)])


def totals_at(
    added: DataFrame,
    reads: DataFrame,
    key: Sequence[str],
    measures: Sequence[str],
    parts: int | None = None,
) -> DataFrame:
    """Exact totals per key up to given points in time; what is read need not be what is added.

    ``added`` has ``key``, ``at`` (a number), ``transaction_id`` and ``measures`` (whole numbers); ``reads``
    has ``key``, ``at``, ``transaction_id`` and ``probe``. Each row of ``reads`` comes back
    with the sums of the measures over the rows of its key with ``at`` no later than its own.
    Only added rows carry measures.
    """
    held = F.struct(*[F.col(name).cast("bigint").alias(name) for name in measures]).alias("adds")
    place = [*key, "at", "transaction_id"]
    both = added.select(*place, F.lit(None).cast("string").alias("probe"), held).unionByName(
        reads.select(*place, "probe"), allowMissingColumns=True
    )
    # At one instant all that is added (probe NULL) comes before all that is read.
    ordering = ["at", "probe", "transaction_id"]
    rows = in_parts(both, [*key, *ordering], parts)
    sums = [F.sum(f"adds.{name}").alias(name) for name in measures]
    per_part = rows.groupBy(*key, "carry_part").agg(*sums)
    earlier = W.partitionBy(*key).orderBy("carry_part").rowsBetween(W.unboundedPreceding, -1)
    before = [F.sum(name).over(earlier).alias(name) for name in measures]
    carry = per_part.select(*key, "carry_part", F.struct(*before).alias("adds"))
    carry = carry.where(F.col(f"adds.{measures[0]}").isNotNull())
    upto = (
        W.partitionBy("carry_part", *key)
        .orderBy(*ordering)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    totals = [F.coalesce(F.sum(f"adds.{name}").over(upto), F.lit(0)).alias(name) for name in measures]
    # A carry row has no time, so it sorts before all rows that have one.
    summed = rows.unionByName(carry, allowMissingColumns=True).select(*key, "at", "transaction_id", "probe", *totals)
    return summed.where(F.col("probe").isNotNull())


def first_of_pair(events: DataFrame, pair: Sequence[str], flag: str) -> DataFrame:
    """``(transaction_id, flag)`` for rows where all of ``pair`` meet for the first time.

    The earliest row of each pair is found by a map-side minimum; join the result to the
    events on ``transaction_id``, which is never skewed.
    """
    earliest = F.min(F.struct("event_timestamp", "transaction_id")).alias("seen")
    return (
        events.where(F.col("event_timestamp").isNotNull())
        .groupBy(*pair)
        .agg(earliest)
        .select(F.col("seen.transaction_id").alias("transaction_id"), F.lit(True).alias(flag))
    )
