"""Isolation forest in column expressions.

Trees grow from a bounded, repeatable sample of rows: random splits between the smallest and largest value
of a random feature, down to single rows or the usual depth. They are small tables of nodes, filled up to full
trees so that a step is one comparison and the sides follow from the place; scoring walks them with array functions, so rows are scored in the scan that reads them, without Python workers or a join.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A full tree: feature and value of each split, the sides of ``n`` being ``2n + 1`` and ``2n + 2``, and the path of each end.
FULL_TREES = "array<struct<f:array<int>,cut:array<double>,path:array<double>>>"


def usual_path(n: int) -> float:
    """Average path length of an unsuccessful search in a random binary tree of ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    features: tuple[str, ...]
    trees: tuple[tuple[dict, ...], ...]
    sample: int
    depth: int


def _grown(rows: list[list[float]], depth: int, rng: random.Random) -> list[dict]:
    nodes: list[dict] = []

    def grow(own: list[list[float]], left: int) -> int:
        place = len(nodes)
        nodes.append({})
        ranges = [(min(column), max(column)) for column in zip(*own)] if left and len(own) > 1 else []
        open_ = [i for i, (low, high) in enumerate(ranges) if low < high]
        if not open_:
            nodes[place] = {"f": 0, "cut": 0.0, "low": 0, "high": 0, "rest": usual_path(len(own))}
            return place
        f = rng.choice(open_)
        low, high = ranges[f]
        cut = min(rng.uniform(low, high), math.nextafter(high, low))
        sides = [[r for r in own if r[f] <= cut], [r for r in own if r[f] > cut]]
        nodes[place] = {"f": f + 1, "cut": cut, "rest": 0.0}
        # Places are numbered from 1, as array functions do.
        nodes[place] |= {"low": grow(sides[0], left - 1) + 1, "high": grow(sides[1], left - 1) + 1}
        return place

    grow(rows, depth)
    return nodes


def fit_forest(
    rows: DataFrame, features: Sequence[str], key: str = "transaction_id", trees: int = 50, sample: int = 256, seed: int = 42
) -> Forest:
    """Grow ``trees`` trees of ``sample`` rows each; ``trees * sample`` rows come to the driver at most.

    The sample is the rows with the smallest hashes of their key; a missing value counts as zero.
    """
    values = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in features]
    drawn = rows.select(F.xxhash64(F.lit(seed), key).alias("draw"), F.array(*values).alias("values"))
    found = [row["values"] for row in drawn.orderBy("draw", "values").limit(trees * sample).collect()]
    rng = random.Random(seed)
    rng.shuffle(found)
    held = max(1, min(sample, len(found) // trees))
    depth = max(1, math.ceil(math.log2(held)))
    grown = [tuple(_grown(found[i * held : (i + 1) * held] or [[0.0] * len(features)], depth, rng)) for i in range(trees)]
    return Forest(tuple(features), tuple(grown), held, depth)


def _full(tree: Sequence[dict], depth: int) -> dict[str, list]:
    """A tree filled up to ``depth``: below a leaf both sides lead to its path."""
    inner = (1 << depth) - 1
    full = {"f": [0] * inner, "cut": [0.0] * inner, "path": [0.0] * (inner + 1)}

    def fill(place: int, node: dict, level: int, steps: int) -> None:
        if level == depth:
            full["path"][place - inner] = steps + node["rest"]
            return
        sides = [node, node]
        if node["f"]:
            full["f"][place], full["cut"][place] = node["f"] - 1, node["cut"]
            sides = [tree[node["low"] - 1], tree[node["high"] - 1]]
        for side, below in enumerate(sides, 1):
            fill(2 * place + side, below, level + 1, steps + bool(node["f"]))

    fill(0, tree[0], 0, 0)
    return full


def anomaly_score(forest: Forest) -> Column:
    """``2 ** -(average path / usual path)``: near 1 for rows that few splits set apart, below 0.5 for usual ones."""
    values = F.array(*[F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in forest.features])
    full = [_full(tree, forest.depth) for tree in forest.trees]
    trees = F.from_json(F.lit(json.dumps(full)), FULL_TREES)  # a constant of the plan
    levels = F.array(*[F.lit(0)] * forest.depth)

    def walked(value: Column) -> Column:
        def path(tree: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                low = F.get(value, F.get(tree["f"], at)) <= F.get(tree["cut"], at)
                return at + at + F.when(low, 1).otherwise(2)

            return F.get(tree["path"], F.aggregate(levels, F.lit(0), step) - ((1 << forest.depth) - 1))

        return F.aggregate(F.transform(trees, path), F.lit(0.0), lambda a, b: a + b)

    # Bound once per row, not built again at every step.
    total = F.transform(F.array(values), walked)[0]
    usual = usual_path(forest.sample) or 1.0
    return F.pow(F.lit(2.0), -total / F.lit(len(forest.trees) * usual)).alias("anomaly_score")


def score_forest(forest: Forest, rows: DataFrame) -> DataFrame:
    return rows.select("*", anomaly_score(forest))
