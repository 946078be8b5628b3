"""Evaluation of scores and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.functions.scalar import ratio
from ledgerlight.operators.cells import Measure, ranged, running


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    def cell(y, p):
        return F.count(F.when((F.col(label) == y) & (F.col(predicted) == p), 1))

    return df.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn"))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def precision_recall(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 (0 where undefined), alert rate and fraud rate."""
    c = confusion(df, label, predicted)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    rows = tp + fp + tn + fn
    return c.select(
        _or_zero(ratio(tp, tp + fp)).alias("precision"),
        _or_zero(ratio(tp, tp + fn)).alias("recall"),
        _or_zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        _or_zero(ratio(tp + fp, rows)).alias("alert_rate"),
        _or_zero(ratio(tp + fn, rows)).alias("fraud_rate"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve with half credit for ties, 0 where a class is missing.

    Scores are counted per distinct value and ranked by running counts over ranges of scores.
    """
    rows = df.select(F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("s")).dropna()
    counts = rows.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    upto = running(ranged(counts, ["s"]), [], [Measure("_neg", F.col("neg")), Measure("_pos", F.col("pos"))], order=["s"])
    wins = F.col("pos") * (F.col("_neg") - F.col("neg") / 2.0)
    # A count can pass 2^53; the product of both class sizes is taken in doubles.
    pairs = F.max("_neg_all").cast("double") * F.max("_pos_all").cast("double")
    return upto.agg(_or_zero(ratio(F.sum(wins), pairs)).alias("auc"))


def evaluate(df: DataFrame, method: str, label: str, predicted: str, score: str) -> DataFrame:
    auc = roc_auc(df, label, score)
    return precision_recall(df, label, predicted).select(
        F.lit(method).alias("method"), "precision", "recall", F.col("f1").alias("f1_score"), auc.scalar().alias("auc")
    )


def best_method(results: DataFrame) -> DataFrame:
    return results.agg(
        F.max_by("method", F.struct("f1_score", "method")).alias("method"), F.max("f1_score").alias("f1_score")
    )


def status_band(metrics: DataFrame) -> DataFrame:
    """Status and recommendations for a row with precision, recall and f1."""
    p, r, f1 = F.col("precision"), F.col("recall"), F.col("f1")
    return metrics.select(
        F.when((p >= 0.85) & (r >= 0.70), "excellent").when(f1 >= 0.60, "good").otherwise("needs improvement").alias("status"),
        (p < 0.85).cast("int").alias("improve_precision"),
        (r < 0.70).cast("int").alias("improve_recall"),
    )


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    risky = F.when(F.col("overdraft_risk") == 1, F.col("account_id"))
    return forecasts.agg(
        F.count(F.lit(1)).alias("total_forecasts"),
        F.countDistinct("account_id").alias("unique_accounts"),
        F.avg("forecast").alias("avg_forecast_value"),
        F.countDistinct(risky).alias("overdraft_risk_accounts"),
        F.countDistinct("date").alias("forecast_horizon_days"),
        F.avg(F.col("upper_bound") - F.col("lower_bound")).alias("avg_forecast_spread"),
    )


def forecast_accuracy(pairs: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, MAPE, RMSE and means over rows where both values are present."""
    a, p = F.col(actual), F.col(predicted)
    both = pairs.dropna(subset=[actual, predicted]).filter(~F.isnan(a) & ~F.isnan(p))
    return both.agg(
        F.avg(F.abs(a - p)).alias("mae"),
        (F.avg(F.abs(ratio(a - p, a + 1e-6))) * 100).alias("mape"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        F.avg(a).alias("mean_actual"),
        F.avg(p).alias("mean_predicted"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class). The class table is a handful of rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    whole = counts.agg((F.sum("class_rows") / F.count(F.lit(1))).alias("mean_rows"))
    return counts.withColumn("weight", whole.scalar() / F.col("class_rows"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram between minimum and maximum; the maximum falls in the last bin."""
    ends = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place = F.floor(F.try_divide(F.col(value) - lo, hi - lo) * bins) + 1
    return (
        df.filter(F.col(value).isNotNull())
        .select(F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
