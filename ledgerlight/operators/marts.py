"""Reporting tables behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.functions.scalar import money, ratio, units
from ledgerlight.operators.cells import quantile
from ledgerlight.operators.evaluate import histogram


def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.avg("is_fraud").alias("fraud_rate"),
        F.countDistinct("account_id").alias("active_accounts"),
        (money(F.sum(units("amount"))) / F.count("amount")).alias("avg_amount"),
    )


def daily(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count("transaction_id").alias("transaction_count"),
        money(F.sum(units("amount"))).alias("total_amount"),
        F.sum("is_fraud").alias("fraud_count"),
    )


def category(df: DataFrame, column: str = "merchant_category") -> DataFrame:
    total = money(F.sum(units("amount")))
    return df.groupBy(column).agg(
        F.count("amount").alias("txn_count"),
        F.round(total, 2).alias("total_amount"),
        F.round(total / F.count("amount"), 2).alias("avg_amount"),
    )


def ingest_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg("is_fraud").alias("fraud_rate"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.countDistinct("account_id").alias("accounts"),
    )


def top_accounts(df: DataFrame, n: int = 10, min_transactions: int = 30) -> DataFrame:
    counts = df.groupBy("account_id").agg(F.count(F.lit(1)).alias("txn_count"))
    return (
        counts.filter(F.col("txn_count") >= min_transactions)
        .orderBy(F.col("txn_count").desc(), "account_id")
        .limit(n)
    )


def anomaly_overview(scored: DataFrame, score: str = "anomaly_score", flag: str = "is_anomaly", bins: int = 50) -> DataFrame:
    """One row: anomalies, their rate and precision, the score's 95 % quantile and its histogram, a count for each bin."""
    p95 = quantile(scored, score, 0.95)
    counts = histogram(scored, score, bins).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    bars = counts.select(F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0))))
    hits = F.sum(F.col("is_fraud") * F.col(flag))
    return scored.agg(
        F.sum(flag).alias("anomaly_count"),
        F.avg(flag).alias("anomaly_rate"),
        ratio(hits, F.greatest(F.sum(flag), F.lit(1))).alias("precision"),
    ).withColumns({"score_p95": p95.scalar(), "score_histogram": bars.scalar()})


def recent_anomalies(scored: DataFrame, n: int = 20, flag: str = "is_anomaly") -> DataFrame:
    return scored.filter(F.col(flag) == 1).orderBy(F.col("timestamp").desc(), "transaction_id").limit(n)


def current_balance(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """(account_id, current_balance): the latest balance, or the sum of amounts where the table has no balances."""
    latest = F.max_by("balance", time) if "balance" in df.columns else money(F.sum(units("amount")))
    return df.groupBy("account_id").agg(latest.alias("current_balance"))


def account_card(days: DataFrame, forecasts: DataFrame, as_of: str, transactions: DataFrame | None = None) -> DataFrame:
    """Per forecast account: current balance, lowest forecast, any overdraft, days until the first one.

    The balance is that of the latest day, or by `current_balance` of the transactions if they are given.
    """
    now = current_balance(days, "ds") if transactions is None else current_balance(transactions)
    first = F.min(F.when(F.col("overdraft_risk") == 1, F.col("date")))
    ahead = forecasts.groupBy("account_id").agg(
        F.min("forecast").alias("min_forecast"),
        F.max("overdraft_risk").alias("overdraft_risk"),
        F.greatest(F.lit(0), F.datediff(first, F.lit(as_of).cast("date"))).alias("_days"),
        first.alias("_first"),
    )
    return ahead.join(now, "account_id", "left").select(
        "account_id",
        "current_balance",
        "min_forecast",
        "overdraft_risk",
        F.when(F.col("_first").isNotNull(), F.col("_days")).alias("days_to_overdraft"),
    )


def balance_timeline(days: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Observed balances followed by forecast and band, in one long table."""
    past = days.select("account_id", F.col("ds").alias("date"), F.lit("actual").alias("kind"), F.col("balance").alias("value"))
    ahead = forecasts.select(
        "account_id", "date", F.lit("forecast").alias("kind"), F.col("forecast").alias("value"), "lower_bound", "upper_bound"
    )
    return past.unionByName(ahead, allowMissingColumns=True)


def transaction_detail(df: DataFrame, transaction_id: str) -> DataFrame:
    indicators = [c for c in df.columns if c.startswith("risk_") or c in ("is_night", "is_weekend", "rapid_fire", "is_new_merchant")]
    return df.filter(F.col("transaction_id") == transaction_id).select(
        "transaction_id", "account_id", "timestamp", "amount", "merchant_name", "merchant_category", *indicators
    )
