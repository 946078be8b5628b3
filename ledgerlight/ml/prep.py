"""Model matrices: imputation, variance filter, scaling, splits.

A fitted step is a handful of numbers per column; only those ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.functions.scalar import cyclic_features, finite
from ledgerlight.operators.cells import Measure, at_shares, percentile_rank, running
from ledgerlight.plans.profiles import available


def stacked(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), finite(F.col(c)).alias("v")) for c in columns])
    return df.select(F.explode(pairs).alias("x")).select("x.*").filter("v is not null")


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, median) over the finite values, exact."""
    counts = stacked(df, columns).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    return at_shares(counts, ["feature"], "v", [0.5]).select("feature", ((F.col("lo_0") + F.col("hi_0")) / 2).alias("median"))


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    return {r["feature"]: r["median"] for r in medians(df, columns).collect()}


def impute(df: DataFrame, fill: dict[str, float]) -> DataFrame:
    """Nulls, NaN and infinities become the column's median."""
    return df.withColumns({c: F.coalesce(finite(F.col(c)), F.lit(v)) for c, v in fill.items()})


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    return impute(df, fit_medians(df, columns))


def variances(df: DataFrame, columns: list[str], threshold: float = 0.05) -> DataFrame:
    """(feature, variance, kept): population variance against the threshold."""
    return (
        stacked(df, columns)
        .groupBy("feature")
        .agg(F.var_pop("v").alias("variance"))
        .withColumn("kept", (F.col("variance") > threshold).cast("int"))
    )


def select_by_variance(df: DataFrame, columns: list[str], threshold: float = 0.05) -> list[str]:
    kept = {r["feature"] for r in variances(df, columns, threshold).filter("kept = 1").collect()}
    return [c for c in columns if c in kept]


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column is divided by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / F.lit(s) for c, (m, s) in scaler.items()})


def basic_matrix(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """Available features with nulls and infinities imputed."""
    have = available(df, features)
    if not have:
        raise ValueError("no feature columns available")
    return impute_median(df, have), have


def enhanced_matrix(df: DataFrame, features: list[str], threshold: float = 0.05) -> tuple[DataFrame, list[str]]:
    """Adds log amount, amount percentile in the account and cyclic time, imputes, drops low-variance columns."""
    columns = available(df, features)
    extra = []
    if "amount" in columns:
        df = df.withColumn("amount_log", F.when(F.col("amount") > -1, F.log1p("amount")))
        df = percentile_rank(df, "account_id", "amount", "amount_percentile")
        extra += ["amount_log", "amount_percentile"]
    if {"hour_of_day", "day_of_week"} <= set(columns):
        df = cyclic_features(df)
        extra += ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
    columns = list(dict.fromkeys(columns + extra))
    df = impute_median(df, columns)
    return df, select_by_variance(df, columns, threshold)


SPLIT_CELLS = 2**36


def hash_place(key: Column, seed: int = 42) -> Column:
    """52 bits of a row's hash as a whole number, the same on any engine with md5."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(str(seed)))), 1, 13), 16, 10).cast("long")


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds `is_train`: within each label the rows whose hash ranks in the first `share`.

    Ranks come from running counts over hash buckets, so the frequent label is spread over many tasks.
    """
    placed = df.withColumn("_h", hash_place(F.col(key), seed)).withColumn(
        "_cell", F.floor(F.col("_h") / SPLIT_CELLS).cast("long")
    )
    ranked = running(placed, [label], [Measure("_rank", F.lit(1))], order=["_h", key])
    place = F.try_divide((F.col("_rank") - 1).cast("double"), (F.col("_rank_all") - 1).cast("double"))
    return ranked.withColumn("is_train", (F.coalesce(place, F.lit(0.0)) <= share).cast("int")).drop(
        "_h", "_cell", "_rank", "_rank_all"
    )


def flag_top(df: DataFrame, score: str, share: float, name: str, known: DataFrame | None = None) -> DataFrame:
    """1 for scores above the (1 - share) quantile of `known`, by default of the rows themselves."""
    from ledgerlight.operators.cells import quantile

    return df.withColumn(name, (F.col(score) > quantile(df if known is None else known, score, 1.0 - share).scalar()).cast("int"))
