import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators.evaluate import curve_areas
from riskflow.plans import catalog, models

FEATURES = ["x", "y"]


def planted(spark, n=2000):
    """Fraud mostly where x - y is large; some features and labels are missing."""
    draw = random.Random(3)
    rows = []
    for i in range(n):
        x, y = draw.gauss(0, 3), draw.gauss(5, 1)
        fraud = x - y + draw.gauss(0, 1) > -3
        rows.append((i, None if i % 17 == 0 else x, float("nan") if i % 19 == 0 else y, None if i % 5 == 0 else fraud))
    return spark.createDataFrame(rows, "id long, x double, y double, is_fraud boolean")


def test_models_find_a_planted_rule(spark):
    rows = planted(spark)
    early, late = rows.where("id < 1000"), rows.where("id >= 1000")
    for kind in models.MODEL_KINDS:
        scored = models.score(models.train(early, FEATURES, kind), late, FEATURES)
        assert scored.count() == 1000
        assert curve_areas(scored, "fraud_probability").first().roc_auc > 0.9


def test_logistic_scores_follow_from_the_weights(spark):
    rows = planted(spark)
    model = models.train(rows, FEATURES, "logistic")
    intercept, weights, middle = models.logistic_weights(model, FEATURES)
    assert weights["x"] > 0 > weights["y"] and set(middle) == set(FEATURES)
    scored = models.score(model, rows, FEATURES).withColumn("formula", models.logistic_probability(model, FEATURES))
    assert scored.where(F.abs(F.col("formula") - F.col("fraud_probability")) > 1e-9).count() == 0


def test_labels_are_joined_once(spark, tmp_path, monkeypatch):
    """The features of a model read events that are stored with their labels, one row per event."""
    events = spark.range(40).selectExpr(
        "id as event_id", "timestamp_ntz '2024-01-02' + make_dt_interval(0, 0, id) as ts", "id % 4 as user_id",
        "'view' as event_type", "double(id) as value", "'{\"k\": 3}' as props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(0, 40, 2).selectExpr("id as doc_id", "id % 4 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []

    def read_by(events, *_):
        seen.append(events)
        raise StopIteration

    monkeypatch.setattr(catalog.B, "rolling_velocity", read_by)
    with pytest.raises(StopIteration):
        catalog.QUERIES["model_boosted_trees"](spark, str(tmp_path))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and (seen[0].count(), seen[0].where("is_fraud is not null").count()) == (40, 20)
