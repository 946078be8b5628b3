"""Supervised scoring, reconstruction error, ensemble and surrogate as pyspark.ml stages."""

from __future__ import annotations

from math import ceil, log2

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ledgerlight.ml import forest
from ledgerlight.ml.prep import flag_top, stratified_split
from ledgerlight.operators.cells import quantile
from ledgerlight.operators.evaluate import class_weights
from ledgerlight.session import cut

# Weights of the ensemble.
ENSEMBLE_WEIGHTS = {"isolation_forest": 0.3, "random_forest": 0.7}
ENSEMBLE_QUANTILE = 0.97
SURROGATE_QUANTILE = 0.9


def dealt(df: DataFrame) -> DataFrame:
    """The rows over at least as many tasks as the session has cores: a table of few files would be one task's work."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def fit_random_forest(df: DataFrame, features: list[str], label: str = "is_fraud", n_trees: int = 1000, depth: int = 15, seed: int = 42):
    """A pipeline of one stage: the forest with balanced class weights and, at each node, log2 of the columns."""
    df = cut(dealt(df.select(label, *features)), "known")
    weights = {int(r[label]): float(r["weight"]) for r in class_weights(df, label).where(F.col(label).isNotNull()).collect()}
    tried = max(1, ceil(log2(len(features))))
    return PipelineModel([forest.fit(df, features, label, weights, n_trees, depth, 5, tried, seed)])


def score_random_forest(df: DataFrame, model, name: str = "rf_score") -> DataFrame:
    out = model.transform(df if df.isStreaming else dealt(df))
    return out.withColumn(name, F.col("probability")[1]).drop("probability")


def importances(model, features: list[str]) -> list[tuple[str, float]]:
    return sorted(zip(features, map(float, model.stages[-1].featureImportances)), key=lambda p: (-p[1], p[0]))


def fit_reconstruction(scaled: DataFrame, features: list[str], k: int | None = None):
    """Linear reconstruction: principal components of the scaled matrix."""
    k = k or max(1, min(32, len(features) // 2))
    stages = [
        VectorAssembler(inputCols=features, outputCol="features"),
        PCA(k=k, inputCol="features", outputCol="components"),
    ]
    return Pipeline(stages=stages).fit(scaled)


def score_reconstruction(scaled: DataFrame, model, features: list[str], name: str = "reconstruction_error") -> DataFrame:
    """Mean squared residual. Components are orthonormal, so it is what their squares leave of the row's square."""

    def square(v):
        return F.aggregate(vector_to_array(v), F.lit(0.0), lambda a, x: a + x * x)

    out = model.transform(scaled)
    left = F.greatest(square("features") - square("components"), F.lit(0.0))
    return out.withColumn(name, left / len(features)).drop("features", "components")


def ensemble(
    df: DataFrame, iso: str = "iso_score", rf: str | None = "rf_score", q: float = ENSEMBLE_QUANTILE, known: DataFrame | None = None
) -> DataFrame:
    """Min-max scaled forest score and supervised score by weight; above the quantile is flagged.

    Minimum, maximum and quantile are those of `known` (by default of the rows themselves), so later rows can be scored
    by what earlier ones have shown.
    """
    if rf is None or rf not in df.columns:
        return df.withColumns({"ensemble_score": F.col(iso)})
    known = df if known is None else known
    ends = known.agg(F.min(iso).alias("lo"), F.max(iso).alias("hi")).first()
    lo, width = ends["lo"], ends["hi"] - ends["lo"] + 1e-8
    score = (
        ENSEMBLE_WEIGHTS["isolation_forest"] * (F.col(iso) - lo) / width + ENSEMBLE_WEIGHTS["random_forest"] * F.col(rf)
    )
    out = df.withColumn("ensemble_score", score)
    return flag_top(out, "ensemble_score", 1.0 - q, "ensemble_flag", known=known.withColumn("ensemble_score", score))


def fit_surrogate(
    df: DataFrame,
    features: list[str],
    score: str,
    key: str = "transaction_id",
    iterations: int = 100,
    depth: int = 6,
    rate: float = 0.1,
    seed: int = 42,
):
    """Boosted trees that imitate 'score above its 90 % quantile'; returns the model and the split frame."""
    limit = quantile(df, score, SURROGATE_QUANTILE).first()[0]
    labelled = df.withColumn("label", (F.col(score) > limit).cast("int"))
    split = stratified_split(labelled, key, "label")
    boosted = GBTClassifier(featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth, stepSize=rate, seed=seed)
    stages = [VectorAssembler(inputCols=features, outputCol="features"), boosted]
    return Pipeline(stages=stages).fit(dealt(split.filter("is_train = 1"))), split


def accuracy(model, split: DataFrame) -> DataFrame:
    out = model.transform(split)
    return out.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
    )
