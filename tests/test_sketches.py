"""Sketches, drift from sketches, the isolation forest and the progress history."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import quality
from riskflow.operators.ordered import running_over_values, stored_parts
from riskflow.operators.sketches import distinct_error, distinct_sketches, quantile_sketches, sketched_stability, united_distincts
from riskflow.operators.validate import route
from riskflow.plans import forest
from riskflow.streaming.history import ProgressHistory, dead_letter_rate, history, observed_routing
from riskflow.streaming.queries import start_table
from tests.helpers import raw, value


def test_distincts_unite(spark):
    """Two accounts of one thousand devices each, seen in many windows, and an account without any row with a device."""
    made = spark.range(20_000).select(
        (F.col("id") % 2).cast("string").alias("account_id"),
        F.timestamp_seconds(1_767_225_600 + F.col("id") * 3).alias("event_timestamp"),
        (F.col("id") % 2000).cast("string").alias("device_id"),
    )
    made = made.unionByName(made.limit(1).select(F.lit("none").alias("account_id"), "event_timestamp", F.lit(None).cast("string").alias("device_id")))
    found = distinct_sketches(made, {"devices": "device_id"})
    assert found.count() > 100
    united = {r.account_id: r.devices for r in united_distincts(found, ["devices"], ["account_id"]).collect()}
    assert united["none"] == 0
    assert all(abs(united[a] - 1000) <= 1000 * distinct_error() for a in "01")


def test_drift_from_sketches(spark):
    rng = random.Random(4)
    rows = [(day, int(rng.gauss(1000 + 40 * day, 200))) for day in range(4) for _ in range(4000)] + [(0, None)]
    table = spark.createDataFrame(rows, "day int, cents long")
    sketches = quantile_sketches(table, {"cents": F.col("cents"), "same": F.lit(5)}, F.col("day"))
    assert sketches.count() == 8
    psi = {r.feature: (r.bins, r.psi) for r in sketched_stability(sketches, F.col("period") < 2, F.col("period") >= 2).collect()}
    old, new = table.where("day < 2 and cents is not null"), table.where("day >= 2")
    cuts = old.agg(F.percentile_approx("cents", [i / 10 for i in range(1, 10)], 1_000_000)).first()[0]
    bin_of = sum(((F.col("cents") > cut).cast("int") for cut in cuts), F.lit(0))
    exact = quality.population_stability(old, new, bin_of, "cents").first().psi
    assert exact > 0.05 and psi["cents"][0] == 10 and abs(psi["cents"][1] - exact) < 0.02
    assert psi["same"][0] == 2 and abs(psi["same"][1]) < 0.001
    assert sketched_stability(sketches.limit(0), F.lit(True), F.lit(True)).count() == 0


def plain_score(grown, row):
    total = 0.0
    for tree in grown.trees:
        place, steps = 0, 0
        while tree[place]["f"]:
            node = tree[place]
            place, steps = (node["low"] if row[node["f"] - 1] <= node["cut"] else node["high"]) - 1, steps + 1
        total += steps + tree[place]["rest"]
    return 2 ** (-total / len(grown.trees) / (forest.usual_path(grown.sample) or 1.0))


def test_forest_scores(spark):
    rng = random.Random(6)
    rows = [(f"t{n}", rng.gauss(0, 1), rng.gauss(0, 1)) for n in range(3000)] + [("odd", 9.0, -9.0), ("null", None, 0.0)]
    table = spark.createDataFrame(rows, "transaction_id string, a double, b double").repartition(6)
    grown = forest.fit_forest(table, ["a", "b"], trees=30, sample=64)
    assert forest.fit_forest(table.repartition(3), ["a", "b"], trees=30, sample=64) == grown
    assert len(grown.trees) == 30 and grown.sample == 64 and all(len(t) < 2 * 64 for t in grown.trees)
    scored = forest.score_forest(grown, table)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
    found = {r.transaction_id: r.anomaly_score for r in scored.collect()}
    for name, a, b in rows:
        assert found[name] == pytest.approx(plain_score(grown, (a or 0.0, b or 0.0)))
    usual = sorted(found.values())
    assert found["odd"] >= usual[-5] > 0.6 and usual[1500] < 0.55
    none = forest.fit_forest(table.limit(0), ["a", "b"])
    assert forest.score_forest(none, table).select("anomaly_score").distinct().count() == 1


def test_forest_step_builds_no_rows(spark):
    """A step of the walk is a comparison of places in full trees, whatever the shape; unbalanced trees keep their paths."""
    leaf = {"f": 0, "cut": 0.0, "low": 0, "high": 0}
    tree = (
        {"f": 2, "cut": 1.5, "rest": 0.0, "low": 2, "high": 3},
        leaf | {"rest": 0.25},
        {"f": 1, "cut": -1.0, "rest": 0.0, "low": 4, "high": 5},
        leaf | {"rest": 0.0},
        leaf | {"rest": 2.0},
    )
    grown = forest.Forest(("a", "b"), (tree, (leaf | {"rest": 3.0},)), 8, 3)
    rows = [("x", 0.0, 1.5), ("y", -1.0, 2.0), ("z", -0.9, 1.6), ("n", None, None), ("nan", float("nan"), float("nan"))]
    scored = forest.score_forest(grown, spark.createDataFrame(rows, "transaction_id string, a double, b double"))
    want = {"x": 4.25, "y": 5.0, "z": 7.0, "n": 4.25, "nan": 7.0}
    assert {r.transaction_id: r.anomaly_score for r in scored.collect()} == {
        name: pytest.approx(2 ** (-total / 2 / forest.usual_path(8))) for name, total in want.items()
    }
    plan = scored._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "named_struct" not in plan and "steps" not in plan


def test_history_survives_restarts(spark, tmp_path):
    """Three runs of one router, one micro-batch each: every batch is there, and the rates are those of a count."""
    schema = raw(spark).schema
    batches = [[value(), value(currency="ZZZ"), b"{x"], [value(), None], [value()] * 4]
    for batch in batches:
        raw(spark, *batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        listener = ProgressHistory(spark, str(tmp_path / "history"))
        spark.streams.addListener(listener)
        routed = observed_routing(route(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))))
        query = start_table(routed, "routing", str(tmp_path / "out"), str(tmp_path / "cp"), None)
        query.awaitTermination()
        assert listener.wait_for(query.runId)
        spark.streams.removeListener(listener)
    kept = history(spark, str(tmp_path / "history")).where("input_rows > 0")
    assert sorted((r.batch_id, r.input_rows) for r in kept.collect()) == [(0, 3), (1, 2), (2, 4)]
    rate = dead_letter_rate(kept).first()
    letters = spark.read.parquet(str(tmp_path / "out")).where("topic = 'transactions.dlq'").count()
    assert (rate.rows, rate.dead_letters) == (9, letters) == (9, 3) and rate.dead_letter_rate == pytest.approx(1 / 3)



def test_ranges_follow_the_number_of_values(spark):
    """Running sums over ten thousand values; no range holds more than about twice its share."""
    points = spark.range(10_000).select((F.col("id") * F.col("id") % 10_007).cast("double").alias("value"), F.lit(1).alias("n"))
    points = points.groupBy("value").agg(F.sum("n").alias("n"))
    found = running_over_values(points, {"n": "upto"}, parts=16).orderBy("value").collect()
    total = 0
    for r in found:
        total += r.n
        assert r.upto == total
    parts = stored_parts(points, 16).groupBy("carry_part").count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 2 * 10_000 / 16
