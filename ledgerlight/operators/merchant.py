"""Merchant and category features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.functions.scalar import flag, money, squared, unit_std, units
from ledgerlight.operators.cells import Measure, number_rows, ranged, running, same_key


def value_frequency(source: DataFrame, column: str, name: str) -> DataFrame:
    return source.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def merchant_frequency(df: DataFrame, source=None) -> DataFrame:
    """Rows of the merchant in the whole data, rare at five or fewer."""
    counts = value_frequency(df if source is None else source, "merchant_name", "merchant_frequency")
    return same_key(df, counts, ["merchant_name"]).withColumn(
        "is_rare_merchant", flag(F.col("merchant_frequency") <= 5)
    )


def account_merchant_frequency(df: DataFrame, source=None) -> DataFrame:
    """Rows of the account at the merchant; new means the only one in the whole data."""
    source = df if source is None else source
    counts = source.groupBy("account_id", "merchant_name").agg(F.count(F.lit(1)).alias("merch_freq_account"))
    return same_key(df, counts, ["account_id", "merchant_name"]).withColumn(
        "is_new_merchant", flag(F.col("merch_freq_account") == 1)
    )


def merchant_stats(source: DataFrame) -> DataFrame:
    u = units("amount")
    sums = source.groupBy("merchant_name").agg(
        F.count(F.lit(1)).alias("merch_txn_count"),
        F.sum(u).alias("_s"),
        F.sum(squared(u)).alias("_q"),
        F.avg("is_fraud").alias("merch_fraud_rate"),
    )
    return sums.select(
        "merchant_name",
        (money(F.col("_s")) / F.col("merch_txn_count")).alias("merch_amt_mean"),
        F.coalesce(unit_std(F.col("merch_txn_count"), F.col("_s"), F.col("_q")), F.lit(0.0)).alias("merch_amt_std"),
        "merch_txn_count",
        "merch_fraud_rate",
    )


def with_merchant_stats(df: DataFrame, source=None) -> DataFrame:
    return same_key(df, merchant_stats(df if source is None else source), ["merchant_name"])


def category_risk(df: DataFrame, source=None) -> DataFrame:
    source = df if source is None else source
    stats = source.groupBy("merchant_category").agg(
        F.count(F.lit(1)).alias("merch_cat_freq"), F.avg("is_fraud").alias("merch_cat_risk")
    )
    return same_key(df, stats, ["merchant_category"])


def merchant_defaults(df: DataFrame) -> DataFrame:
    """What stands in for the merchant and category features where the table lacks those columns."""
    if "merchant_name" not in df.columns:
        u = units("amount")
        whole = df.agg(F.count(F.lit(1)).alias("n"), F.sum(u).alias("s"), F.sum(squared(u)).alias("q"))
        mean = whole.select(money(F.col("s")) / F.col("n")).scalar()
        std = whole.select(unit_std(F.col("n"), F.col("s"), F.col("q"))).scalar()
        df = df.withColumns(
            {
                "merch_freq_account": F.lit(1),
                "merch_amt_mean": mean,
                "merch_amt_std": std,
                "merch_txn_count": F.lit(1),
                "merch_fraud_rate": F.lit(0.0),
            }
        )
    if "merchant_category" not in df.columns:
        df = df.withColumns({"merch_cat_freq": F.lit(1), "merch_cat_risk": F.lit(0.5)})
    return df.withColumn("is_new_merchant", flag(F.col("merch_freq_account") == 1))


def prior_merchant_risk(df: DataFrame, source=None) -> DataFrame:
    """Leak-free merchant fraud rate: earlier transactions of the merchant only, null where there are none."""
    rows = running(
        df,
        ["merchant_name"],
        [Measure("_seen", F.lit(1)), Measure("_fraud", F.col("is_fraud"))],
        source=source,
    )
    seen = F.col("_seen") - 1
    return rows.withColumn(
        "merch_fraud_rate_prior", F.when(seen > 0, (F.col("_fraud") - F.col("is_fraud")) / seen)
    ).drop("_seen", "_fraud", "_seen_all", "_fraud_all")


def first_seen_merchant(df: DataFrame, source=None) -> DataFrame:
    """1 on the account's first transaction at a merchant, in (time, id) order."""
    source = df if source is None else source
    first = source.groupBy("account_id", "merchant_name").agg(
        F.min(F.struct("timestamp", "transaction_id")).alias("_first")
    )
    return (
        same_key(df, first, ["account_id", "merchant_name"])
        .withColumn("is_new_merchant", flag(F.col("_first") == F.struct("timestamp", "transaction_id")))
        .drop("_first")
    )


def category_codes(source: DataFrame) -> DataFrame:
    """Category -> code in alphabetical order, numbered over ranges of the distinct names."""
    names = source.select("merchant_category").where("merchant_category IS NOT NULL").distinct()
    numbered = number_rows(ranged(names, ["merchant_category"]), [], order=["merchant_category"], name="_place")
    return numbered.select("merchant_category", (F.col("_place") - 1).cast("int").alias("category_encoded"))


def with_category_codes(df: DataFrame, source=None) -> DataFrame:
    return same_key(df, category_codes(df if source is None else source), ["merchant_category"])
