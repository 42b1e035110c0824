"""Running totals over the whole order of a column, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from riskflow.operators.carry import in_parts
from riskflow.session import stored_table

#: Distinct values that one task sorts.
PART_ROWS = 1_000_000


def stored_parts(points: DataFrame, parts: int | None = None, value: str = "value") -> DataFrame:
    """``points`` written in ranges of ``value`` that hold about equally many rows, as many as their number asks for."""
    stored = stored_table(points, "points")
    return in_parts(stored, [value], parts or -(-stored.count() // PART_ROWS) or 1)


def running_over_values(
    points: DataFrame, totals: Mapping[str, str], value: str = "value", parts: int | None = None
) -> DataFrame:
    """``points`` (one row per distinct value) with exact running sums in rising order.

    ``totals`` maps a column to the name of its running sum. Each range is summed in its own task on
    top of what the ranges before it hold. Any cuts give the same sums.
    """
    ranged = stored_parts(points, parts, value)
    # A row per range reaches the pass over the ranges.
    before = W.orderBy("carry_part").rowsBetween(W.unboundedPreceding, -1)
    held = ranged.groupBy("carry_part").agg(*[F.sum(name).alias(name) for name in totals])
    held = held.select("carry_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in totals])
    within = W.partitionBy("carry_part").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    return ranged.join(F.broadcast(held), "carry_part").select(
        *points.columns,
        *[(F.sum(n).over(within) + F.col(f"{n}_before")).alias(upto) for n, upto in totals.items()],
    )
