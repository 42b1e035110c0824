"""Fraud models with Spark ML: a logistic baseline and boosted trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MODEL_KINDS = ("logistic", "boosted_trees")


def with_class_weights(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Add ``weight`` so that both classes count the same.

    The class sizes are one row per class, which is why they may be broadcast.
    """
    labelled = rows.where(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    total = F.sum("size").over(W.partitionBy())
    weights = sizes.select("label", (total / (F.col("size") * 2)).alias("weight"))
    return labelled.join(F.broadcast(weights), "label")


def train(
    rows: DataFrame, features: Sequence[str], kind: str = "logistic", label: str = "is_fraud"
) -> PipelineModel:
    """Fit on labelled rows; features are point-in-time, gaps are filled with the median."""
    if kind not in MODEL_KINDS:
        raise ValueError(f"unknown model kind {kind!r}")
    filled = [f"{name}_filled" for name in features]
    steps = [
        Imputer(inputCols=list(features), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="assembled"),
    ]
    if kind == "logistic":
        steps += [
            StandardScaler(inputCol="assembled", outputCol="vector"),
            LogisticRegression(featuresCol="vector", weightCol="weight", regParam=0.01),
        ]
    else:
        steps.append(
            GBTClassifier(featuresCol="assembled", weightCol="weight", maxIter=10, maxDepth=4, seed=42)
        )
    numeric = with_class_weights(rows, label).withColumns(
        {name: F.col(name).cast("double") for name in features}
    )
    return Pipeline(stages=steps).fit(numeric)


def score(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``fraud_probability``."""
    numeric = rows.withColumns({name: F.col(name).cast("double") for name in features})
    kept = [F.col(name) for name in rows.columns]
    probability = vector_to_array("probability")[1].alias("fraud_probability")
    return model.transform(numeric).select(*kept, probability)


def logistic_weights(model: PipelineModel, features: Sequence[str]) -> tuple[float, dict[str, float], dict[str, float]]:
    """Intercept, weight per unit of each feature, and what stands for a missing value of it."""
    imputer, _, scaler, regression = model.stages
    middle = imputer.surrogateDF.first().asDict()
    weights = regression.coefficients.toArray()
    per_unit = {name: float(w / sd) if sd else 0.0 for name, w, sd in zip(features, weights, scaler.std.toArray())}
    return float(regression.intercept), per_unit, {name: float(middle[name]) for name in features}


def logistic_probability(model: PipelineModel, features: Sequence[str]) -> Column:
    """A logistic model as one column expression: scores rows in generated code, without vectors."""
    intercept, weights, middle = logistic_weights(model, features)
    total = F.lit(intercept)
    for name in features:
        value = F.col(name).cast("double")
        known = F.when(value.isNull() | F.isnan(value), F.lit(middle[name])).otherwise(value)
        total = total + known * F.lit(weights[name])
    return 1 / (1 + F.exp(-total))
