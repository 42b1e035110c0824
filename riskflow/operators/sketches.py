"""Mergeable sketches: distinct counts that unite over windows, and quantiles that unite over days.

Exact features stay the default. A sketch is stored once per key and window (or day), next to the
table it was made from, and any longer span is united from them without reading the events again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.session import stored_table

#: Base-2 logarithm of the slots of a distinct-count sketch.
LG_K = 12
#: Size of a quantile sketch; its rank error is about 2.3 / KLL_K ** 0.9.
KLL_K = 800


def distinct_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error of a distinct count that is exceeded with the chance of so many standard deviations."""
    return deviations * 1.04 / (1 << lg_k) ** 0.5


def distinct_sketches(
    events: DataFrame, values: Mapping[str, str], duration: str = "5 minutes", key: str = "account_id", lg_k: int = LG_K
) -> DataFrame:
    """One row per key and window with a sketch per value, ready to be kept beside Gold.

    ``values`` maps the name of a sketch column to the column whose values it counts. Sketches are
    made in tasks before the shuffle, so a hot key moves a few kilobytes per task.
    """
    window = F.window("event_timestamp", duration)
    sketches = [F.hll_sketch_agg(column, lg_k).alias(name) for name, column in values.items()]
    made = events.groupBy(key, window.alias("window")).agg(*sketches)
    return made.select(key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *values)


def united_distincts(sketches: DataFrame, names: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """Estimated distinct counts of each group of sketch rows."""
    united = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names]
    return sketches.groupBy(*by).agg(*united)


def quantile_sketches(events: DataFrame, features: Mapping[str, Column], by: Column) -> DataFrame:
    """Per period and feature: the number of values and a sketch of them; NULLs are left out.

    Values are whole numbers (cents, metres, milliseconds).
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), c.cast("bigint").alias("value")) for n, c in features.items()]))
    valued = events.select(by.alias("period"), pairs).where("value is not null")
    return valued.groupBy("period", "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_bigint("value", F.lit(KLL_K)).alias("sketch")
    )


def sketched_stability(sketches: DataFrame, is_old: Column, is_new: Column, bins: int = 10) -> DataFrame:
    """PSI per feature between two periods of ``quantile_sketches``, over bins that hold equal shares of the older.

    Bins are ``(cut, next cut]``; equal cuts fall together. Counts are ranks in the two united sketches, smoothed by
    one half like in ``population_stability``.
    """

    def side(which: Column, name: str) -> DataFrame:
        found = sketches.where(which).groupBy("feature")
        return found.agg(F.sum("rows").alias(f"{name}_rows"), F.kll_merge_agg_bigint("sketch").alias(name))

    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    both = stored_table(side(is_old, "old").join(side(is_new, "new"), "feature"), "periods")
    # Spark wants the points of a rank to be constants: bins - 1 numbers per feature come to the driver.
    found = both.select("feature", F.array_distinct(F.kll_sketch_get_quantile_bigint("old", shares)).alias("cuts")).collect()
    tables = [_stability(both.where(F.col("feature") == row.feature), row.cuts) for row in sorted(found)]
    return reduce(DataFrame.unionByName, tables) if tables else both.selectExpr("feature", "0L as bins", "double(0) as psi")


def _stability(both: DataFrame, cuts: list[int]) -> DataFrame:
    points, many = F.array(*[F.lit(cut).cast("bigint") for cut in cuts]), len(cuts) + 1

    def counts(name: str) -> Column:
        upto = F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_bigint(name, points), F.array(F.lit(1.0)))
        part = F.transform(F.sequence(F.lit(1), F.lit(many)), lambda i: F.element_at(upto, i + 1) - F.element_at(upto, i))
        return F.transform(part, lambda share: share * F.col(f"{name}_rows"))

    spread = F.lit(0.5 * many)

    def gain(old: Column, new: Column) -> Column:
        p = (old + 0.5) / (F.col("old_rows") + spread)
        q = (new + 0.5) / (F.col("new_rows") + spread)
        return (q - p) * F.log(q / p)

    gains = F.zip_with(counts("old"), counts("new"), gain)
    psi = F.aggregate(gains, F.lit(0.0), lambda total, part: total + part)
    return both.select("feature", F.lit(many).cast("bigint").alias("bins"), psi.alias("psi"))
