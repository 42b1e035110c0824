"""Approximate nearest neighbours: stable projections, kd-tree, chi-square stopping test.

Unit vectors are projected to a few dimensions by a Gaussian (2-stable) matrix. For a pair at
distance ``r`` the squared projected distance is ``r**2`` times a chi-square variable, so once all
points within a projected radius ``R`` are verified, a better neighbour than the k-th found at
distance ``d`` is still unseen with probability at most ``1 - chi2(R**2 / d**2)``. A search takes
projected neighbours in order, leaf by leaf of a kd-tree, verifies them on the original vectors and
stops when that test holds.

The upper levels of the tree are fitted on a bounded sample and cut the projected space into
regions; the rows of a region that is still too large fit a tree of their own on a bounded sample of
that region. Every row is indexed in the leaf it falls into. Each query first searches its own
leaf; the distance found there limits the other leaves it is sent to, by the same test. Leaves
above ``region_rows`` rows and crowds of queries for one leaf are split by count, so that a
task sees at most about ``region_rows`` of each and builds the kd-tree of its share.

Copies of a vector beyond the first ``k + 1`` ids can be nobody's neighbour, since equal scores go to the
smaller id; they stay out of the leaves. Queries with equal vectors search once, for ``2 * k`` rows,
of which each takes those that are not its own.

* vectors that are null, zero, of another length than the most common one, or hold null or
  non-finite components take no part, neither as query nor as candidate;
* equal scores go to the smaller id; a repeated id is two candidates, and never its own neighbour;
  one that is asked with two vectors has an answer for each;
* fewer candidates than wanted: all of them; an empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import kept_table

LEAF = 32
#: Squared distance that rounding may put between projections of equal vectors.
ROUNDING = 1e-12


def chi_square(x: np.ndarray, dims: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, float), 1e6) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, dims // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_point(p: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle), dims) < p else (low, middle)
    return high


@dataclass(frozen=True)
class Regions:
    """Boxes of the upper tree levels; the leaves of splits fitted on a sample."""

    splits: list[tuple[int, float, int, int]]  # dimension, value, low child, high child; leaf: -1, 0, number, 0
    low: np.ndarray
    high: np.ndarray

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        dim = np.array([s[0] for s in self.splits])
        value = np.array([s[1] for s in self.splits])
        low, high = np.array([s[2] for s in self.splits]), np.array([s[3] for s in self.splits])
        while (open_ := dim[at] >= 0).any():
            rows = np.flatnonzero(open_)
            node = at[rows]
            at[rows] = np.where(points[rows, dim[node]] < value[node], low[node], high[node])
        return low[at]

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each region's box."""
        out = np.zeros((len(points), len(self.low)))
        for d in range(points.shape[1]):
            p = points[:, d, None]
            out += np.maximum(np.maximum(self.low[:, d] - p, p - self.high[:, d]), 0.0) ** 2
        return out


def fit_regions(sample: np.ndarray, many: int, within: tuple[np.ndarray, np.ndarray] | None = None) -> Regions:
    """At most ``many`` boxes of about equal numbers of sampled points; ``within`` is the box they divide."""
    dims = sample.shape[1]
    splits: list[tuple[int, float, int, int]] = []
    lows, highs = [], []

    def grow(part: np.ndarray, leaves: int, low: np.ndarray, high: np.ndarray) -> int:
        me = len(splits)
        splits.append((-1, 0.0, 0, 0))
        dim = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
        value = float(np.median(part[:, dim])) if len(part) else 0.0
        below = part[:, dim] < value
        if leaves < 2 or len(part) < 2 or not below.any():
            splits[me] = (-1, 0.0, len(lows), 0)
            lows.append(low)
            highs.append(high)
            return me
        top, bottom = high.copy(), low.copy()
        top[dim] = bottom[dim] = value
        one = grow(part[below], leaves // 2, low, top)
        two = grow(part[~below], leaves - leaves // 2, bottom, high)
        splits[me] = (dim, value, one, two)
        return me

    outer = within or (np.full(dims, -np.inf), np.full(dims, np.inf))
    grow(sample, max(1, many), *outer)
    return Regions(splits, np.array(lows), np.array(highs))


class Tree:
    """kd-tree leaves over projected points: boxes and the rows of each."""

    def __init__(self, points: np.ndarray) -> None:
        self.rows: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                self.rows.append(rows)
                continue
            own = points[rows]
            dim = int(np.argmax(np.ptp(own, axis=0)))
            order = np.argpartition(own[:, dim], len(rows) // 2)
            todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.low = np.array([points[r].min(axis=0) for r in self.rows])
        self.high = np.array([points[r].max(axis=0) for r in self.rows])

    def order(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves by squared distance of their box to a projected point, nearest first."""
        away = (np.maximum(np.maximum(self.low - point, point - self.high), 0.0) ** 2).sum(axis=1)
        order = np.argsort(away, kind="stable")
        return order, away[order]


def _nearest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(scores) > 4 * k + 16:
        bound = -np.partition(-scores, k - 1)[k - 1]
        near = np.flatnonzero(scores >= bound)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(tree: Tree, vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, query: np.ndarray, norm: float, point: np.ndarray, own: int | None, k: int, worst: float, stop: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and cosines of the k nearest found; ``worst`` is a k-th cosine known already.

    Leaves come in projected order, a few at a time; the test uses the box distance of the next
    leaf, so all nearer projected points have been verified when it holds.
    """
    order, away = tree.order(point)
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    at, step = 0, 2
    while at < len(order):
        limit = max(worst, best[k - 1]) if len(best) >= k else worst
        if limit > -2 and away[at] > 0 and away[at] >= stop * max(2 - 2 * limit, ROUNDING):
            break
        rows = np.concatenate([tree.rows[leaf] for leaf in order[at : at + step]])
        if own is not None:
            rows = rows[ids[rows] != own]
        scores = (vectors[rows] * query).sum(axis=1) / (norms[rows] * norm)
        both, names = np.concatenate([best, scores]), np.concatenate([best_ids, ids[rows]])
        near = _nearest(both, names, k)
        best, best_ids = both[near], names[near]
        at, step = at + step, min(2 * step, 64)
    return best_ids, best


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


#: What tells two vectors apart, and two candidates.
SAME = ("one", "two")
ROW = ("vec_id", *SAME)


def _share(share: Column, purpose: str) -> Column:
    """A share of the candidates, by hash."""
    return F.pmod(F.xxhash64(*ROW, F.lit(purpose)), F.lit(1 << 20)) < share * (1 << 20)

TREE = "region long, dim array<int>, value array<double>, below array<int>, above array<int>, low array<double>, high array<double>"


def _tree_row(region: int, tree: Regions) -> pa.Table:
    dim, value, below, above = zip(*tree.splits)
    parts = (np.array(dim, np.int32), np.array(value), np.array(below, np.int32), np.array(above, np.int32), tree.low.ravel(), tree.high.ravel())
    return pa.table([pa.array([region], pa.int64()), *[pa.array([part]) for part in parts]], names=["region", "dim", "value", "below", "above", "low", "high"])


def _tree_of(row: dict, dims: int) -> Regions:
    splits = list(zip(row["dim"], row["value"], row["below"], row["above"]))
    return Regions(splits, np.array(row["low"]).reshape(-1, dims), np.array(row["high"]).reshape(-1, dims))


def inner_trees(crowded: DataFrame, counts: dict[int, int], regions: Regions, dims: int, region_rows: int, sample: int) -> DataFrame:
    """A tree for each region in ``counts``, fitted on at most about ``sample`` of its rows."""
    taken = crowded.where(_share(F.lit(float(sample)) / F.col("many"), "inner sample"))

    def fit(key: tuple, rows: pa.Table) -> pa.Table:
        region = key[0].as_py()
        points = _matrix(rows["point"], dims)
        leaves = min(-(-counts[region] // region_rows), max(1, len(points) // 8))
        return _tree_row(region, fit_regions(points, leaves, (regions.low[region], regions.high[region])))

    return taken.select("region", "point").groupBy("region").applyInArrow(fit, TREE)


def beside_trees(rows: DataFrame, trees: DataFrame, size: int, handle: Callable[[pa.Table, Regions], pa.Table], schema: str, dims: int, by: tuple[str, ...]) -> DataFrame:
    """Rows of a region next to its tree, about ``size`` rows a group; rows of regions without a tree go."""
    many = rows.join(F.broadcast(trees.select("region")), "region", "left_semi").groupBy("region").agg(F.ceil(F.count("*") / size).alias("parts"))
    many = kept_table(many, "parts")  # a row per region, which the first sample bounds
    dealt = rows.join(F.broadcast(many), "region").withColumn("part", F.pmod(F.xxhash64(*by), "parts")).drop("parts")
    copies = trees.join(F.broadcast(many), "region").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")

    names = [field.split()[0] for field in schema.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return handle(left, _tree_of(right.to_pylist()[0], dims)).select(names)

    return dealt.groupBy("region", "part").cogroup(copies.groupBy("region", "part")).applyInArrow(run, schema)


def dealt(base: DataFrame, sent: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Candidates and queries by ``(region, leaf, salt, chunk)``: about ``size`` of each meet in a group.

    A leaf with more candidates has several salts, each of which sees all queries of the leaf; a
    leaf asked more often has several chunks of queries, each of which sees all its candidates.
    """
    place = ["region", "leaf"]
    crowds = base.groupBy(place).agg(F.ceil(F.count("*") / size).alias("salts")).where("salts > 1")
    asked = sent.groupBy(place).agg(F.ceil(F.count("*") / size).alias("chunks")).where("chunks > 1")
    split = kept_table(crowds.join(asked, place, "full").select(*place, *[F.coalesce(c, F.lit(1).cast("long")).alias(c) for c in ("salts", "chunks")]), "splits")

    def spread(frame: DataFrame, by: tuple[str, ...], own: str, count: str, other: str, many: str) -> DataFrame:
        known = frame.join(split, place, "left")
        known = known.withColumn(own, F.pmod(F.xxhash64(*by, F.lit(own)), F.coalesce(count, F.lit(1))))
        return known.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(many, F.lit(1)) - 1))).drop("salts", "chunks")

    return spread(base, ROW, "salt", "salts", "chunk", "chunks"), spread(sent, SAME, "chunk", "chunks", "salt", "salts")


FOUND = "one long, two long, want int, vec_id long, score double"


def _searched(base: DataFrame, sent: DataFrame, size: int, width: int, dims: int, stop: float) -> DataFrame:
    """Nearest candidates per query in every leaf that it was sent to."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name: [] for name in ("one", "two", "want", "vec_id", "score")}
        if left.num_rows and right.num_rows:
            vectors, points, ids = _matrix(left["vector"], width), _matrix(left["point"], dims), left["vec_id"].to_numpy()
            norms, tree = np.sqrt((vectors * vectors).sum(axis=1)), Tree(points)
            asked, at = _matrix(right["vector"], width), _matrix(right["point"], dims)
            rest = [right[c].to_pylist() for c in ("one", "two", "own", "want", "worst")]
            for query, point, one, two, own, want, worst in zip(asked, at, *rest):
                found, scores = search(tree, vectors, norms, ids, query, math.sqrt((query * query).sum()), point, own, want, worst, stop)
                near = scores >= worst
                for name, value in (("one", one), ("two", two), ("want", want)):
                    out[name].append(np.full(near.sum(), value, np.int32 if name == "want" else np.int64))
                out["vec_id"].append(found[near])
                out["score"].append(scores[near])
        empty = {"want": np.int32, "score": np.float64}
        return pa.table({n: np.concatenate([np.zeros(0, empty.get(n, np.int64)), *v]) for n, v in out.items()})

    left, right = dealt(base, sent, size)
    group = ["region", "leaf", "salt", "chunk"]
    return left.groupBy(group).cogroup(right.groupBy(group)).applyInArrow(run, FOUND)


def _best(found: DataFrame, query: list[str], k: int) -> DataFrame:
    """The k nearest of each query; Spark applies the limit before the rows meet, too."""
    order = Window.partitionBy(query).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def without_far_copies(rows: DataFrame, k: int) -> DataFrame:
    """Of equal vectors only those that can be among the k nearest of any row: the k + 1 smallest ids.

    A repeated id keeps k of its rows. Only vectors with more copies are looked at.
    """
    often = kept_table(rows.groupBy(*SAME).agg(F.count("*").alias("many")).where(F.col("many") > k + 1).select(*SAME), "copied-vectors")
    if not often.limit(1).count():
        return rows
    copies = rows.join(often, [*SAME], "left_semi")
    copies = copies.withColumn("place", F.row_number().over(Window.partitionBy(*SAME, "vec_id").orderBy("vec_id"))).where(F.col("place") <= k)
    copies = copies.withColumn("place", F.dense_rank().over(Window.partitionBy(*SAME).orderBy("vec_id"))).where(F.col("place") <= k + 1)
    return rows.join(often, [*SAME], "left_anti").unionByName(copies.drop("place")).select(rows.columns)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, dims: int = 8, confidence: float = 0.98, region_rows: int = 8192, sample: int = 20_000, seed: int = 5, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest of each row whose id is a multiple of ``every``.

    ``sample`` bounds the rows that the upper tree levels, and the inner tree of each crowded region, are
    fitted on (taken by hash). Each level has at most an eighth of its sample as leaves, 2,500 and
    2,500 times 2,500 by default; leaves above ``region_rows`` rows after that are split by count.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = rows.where("exists(vector, x -> x != 0)")
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("many"))
    first = lengths.orderBy(F.desc("many"), F.desc("length")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = first.length, first.many
    plane = np.random.default_rng(seed).standard_normal((width, dims))
    stop = chi_square_point(confidence, dims)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            with np.errstate(all="ignore"):
                x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
                points = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))) @ plane
            lists = pa.ListArray.from_arrays(np.arange(0, points.size + 1, dims, dtype=np.int32), points.ravel())
            yield batch.append_column("point", lists)

    fields = "vec_id long, vector array<double>, one long, two long, point array<double>"
    rows = rows.where(F.size("vector") == width).select("vec_id", "vector", F.xxhash64("vector").alias("one"), F.xxhash64("vector", F.lit("two")).alias("two"))
    rows = kept_table(rows.mapInArrow(project, fields), "projected")
    candidates = without_far_copies(rows, k)
    fitted = _matrix(candidates.where(_share(F.lit(sample / total), "region sample")).select("point").toArrow()["point"], dims)
    regions = fit_regions(fitted, min(-(-total // region_rows), max(1, len(fitted) // 8)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("region", pa.array(regions.of(_matrix(batch.column("point"), dims))))

    base = candidates.mapInArrow(place, fields + ", region long")
    # An id with several vectors asks alone with each, since its own rows may be any number of the nearest.
    asked = rows.where(F.col("vec_id") % every == 0)
    several = asked.groupBy("vec_id").agg(F.min("one").alias("low"), F.max("one").alias("high")).where("low != high")
    asked = asked.join(several, "vec_id", "left").select("*", *[F.when(F.col("low").isNull(), F.col(c)).otherwise(F.xxhash64(c, "vec_id")).alias(f"asked_{c}") for c in SAME])
    asked = asked.select("vec_id", "vector", "point", *[F.col(f"asked_{c}").alias(c) for c in SAME])
    names = asked.select(F.col("vec_id").alias("query_id"), *SAME).distinct()
    asked = asked.groupBy(*SAME).agg(F.min("vec_id").alias("own"), F.max("vec_id").alias("last"), F.first("vector").alias("vector"), F.first("point").alias("point"))
    alone = F.col("own") == F.col("last")
    asked = asked.select("vector", *SAME, "point", F.when(alone, F.col("own")).alias("own"), F.when(alone, F.lit(k)).otherwise(F.lit(2 * k)).alias("want"))
    query = "vector array<double>, one long, two long, point array<double>, own long, want int"
    asked = asked.mapInArrow(place, query + ", region long")

    # Regions above the size that a task may hold get a tree of their own.
    counts = {r.region: r.many for r in base.groupBy("region").agg(F.count("*").alias("many")).where(F.col("many") > region_rows).collect()}
    split: list[int] = []
    if counts:
        sizes = vectors.sparkSession.createDataFrame(list(counts.items()), "region long, many long")
        base, asked = kept_table(base, "placed"), kept_table(asked, "queries")
        trees = kept_table(inner_trees(base.join(F.broadcast(sizes), "region"), counts, regions, dims, region_rows, sample), "inner-trees")
        split = [r.region for r in trees.select("region").collect()]
    if split:
        whole = trees.select("region")

        def leaf_of(part: pa.Table, tree: Regions) -> pa.Table:
            return part.append_column("leaf", pa.array(tree.of(_matrix(part["point"], dims))))

        def leaves(frame: DataFrame, schema: str, by: tuple[str, ...]) -> DataFrame:
            deep = beside_trees(frame, trees, 4 * region_rows, leaf_of, schema + ", region long, leaf long", dims, by)
            return frame.join(F.broadcast(whole), "region", "left_anti").withColumn("leaf", F.lit(0).cast("long")).unionByName(deep)

        base, asked = leaves(base, fields, ROW), leaves(asked, query, SAME)
    else:
        base, asked = [frame.withColumn("leaf", F.lit(0).cast("long")) for frame in (base, asked)]
    base, asked = kept_table(base, "leaves"), kept_table(asked, "asked")

    home = kept_table(_best(_searched(base, asked.withColumn("worst", F.lit(-3.0)), region_rows, width, dims, stop), [*SAME], 2 * k), "home-neighbours")
    # Only a full list says how far the last neighbour is at most.
    worst = home.where(F.col("rank") == F.col("want")).select(*SAME, F.col("score").alias("worst"))
    again = asked.join(worst, [*SAME], "left").withColumn("worst", F.coalesce("worst", F.lit(-3.0)))
    # Vectors follow when the leaves are known; a query may reach many.
    again = again.select(*SAME, "point", "own", "want", F.col("region").alias("home"), F.col("leaf").alias("home_leaf"), "worst")

    def reached(boxes: Regions, rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Rows and boxes that may still hold a nearer neighbour."""
        away = boxes.distances(_matrix(rows.column("point"), dims))
        limit = stop * np.maximum(2 - 2 * rows.column("worst").to_numpy(), ROUNDING)
        return np.nonzero((away < limit[:, None]) | (away == 0))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with every region to be searched, its own among them if that has a tree."""
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                at, region = reached(regions, part)
                open_ = (region != part.column("home").to_numpy()[at]) | np.isin(region, split)
                at, region = at[open_], region[open_].astype(np.int64)
                for few in range(0, len(at), 8192):
                    yield part.take(pa.array(at[few : few + 8192])).append_column("region", pa.array(region[few : few + 8192]))

    def deeper(part: pa.Table, tree: Regions) -> pa.Table:
        """Each query with every leaf of the region to be searched but its own."""
        at, leaf = reached(tree, part)
        other = (part["region"].to_numpy()[at] != part["home"].to_numpy()[at]) | (leaf != part["home_leaf"].to_numpy()[at])
        return part.take(pa.array(at[other])).append_column("leaf", pa.array(leaf[other].astype(np.int64)))

    carried = query.removeprefix("vector array<double>, ") + ", home long, home_leaf long, worst double, region long"
    again = again.mapInArrow(elsewhere, carried)
    if not split:
        again = again.withColumn("leaf", F.lit(0).cast("long"))
    else:
        again = kept_table(again, "reached")
        deep = beside_trees(again, trees, max(1, region_rows // 8), deeper, carried + ", leaf long", dims, SAME)
        again = again.join(F.broadcast(whole), "region", "left_anti").withColumn("leaf", F.lit(0).cast("long")).unionByName(deep)
    again = kept_table(again.drop("home", "home_leaf").join(asked.select(*SAME, "vector"), [*SAME]), "sent")
    found = _searched(base, again, region_rows, width, dims, stop).unionByName(home.drop("rank"))
    best = _best(found, [*SAME], 2 * k).drop("rank", "want")
    answers = _best(best.join(names, [*SAME]).where("vec_id != query_id"), ["query_id", *SAME], k)
    return answers.select("query_id", "rank", "vec_id", "score")
