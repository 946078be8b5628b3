"""Account level features: age, daily spend, weekend ratio, pay days, balance, profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.functions.scalar import flag, money, ratio, units
from ledgerlight.operators.cells import (
    DAY,
    Measure,
    distinct_per_key,
    key_totals,
    running,
    same_key,
    trailing,
)
from ledgerlight.operators.velocity import previous, with_previous

ACCOUNT = ["account_id"]
DAY_US = DAY * 1_000_000


def account_age(df: DataFrame, source=None) -> DataFrame:
    """Whole days since the account's first transaction."""
    source = df if source is None else source
    first = key_totals(source, ACCOUNT, {"_later": ("max", -F.col("_us"))})
    return (
        same_key(df, first, ["account_id", "_cell"])
        .withColumn("account_age_days", F.floor((F.col("_us") + F.col("_later")) / DAY_US))
        .drop("_later")
    )


def average_daily_spending(source: DataFrame) -> DataFrame:
    """Mean over an account's active days of the day's summed amount."""
    days = source.groupBy("account_id", F.to_date("timestamp").alias("_day")).agg(F.sum(units("amount")).alias("_s"))
    return days.groupBy("account_id").agg(
        (money(F.sum("_s")) / F.count(F.lit(1))).alias("avg_daily_spending")
    )


def weekend_ratio(source: DataFrame, weekend: Column) -> DataFrame:
    """Weekend over weekday amount per account; 0 for all where the table has only one kind of day."""
    u = units("amount")
    sums = source.groupBy("account_id").agg(
        F.sum(F.when(weekend == 1, u).otherwise(0)).alias("_w"),
        F.sum(F.when(weekend == 0, u).otherwise(0)).alias("_d"),
    )
    kinds = source.select((F.coalesce(F.max(weekend), F.lit(0)) - F.coalesce(F.min(weekend), F.lit(0))).alias("k"))
    return sums.select(
        "account_id",
        F.when(kinds.scalar() == 1, ratio(money(F.col("_w")), money(F.col("_d")) + 1e-6))
        .otherwise(0.0)
        .alias("weekend_spending_ratio"),
    )


def account_side(source: DataFrame, *tables: DataFrame) -> DataFrame:
    """Account tables brought to (account, cell) grain, where the rows join without meeting a hot account."""
    cells = source.select("account_id", "_cell").distinct()
    for t in tables:
        cells = cells.join(t, "account_id", "left")
    return cells


def with_account_tables(df: DataFrame, *tables: DataFrame, source=None) -> DataFrame:
    return same_key(df, account_side(df if source is None else source, *tables), ["account_id", "_cell"])


def merchant_diversity(source: DataFrame) -> DataFrame:
    return distinct_per_key(
        source, "account_id", {"merchant_diversity": "merchant_name", "category_diversity": "merchant_category"}
    )


# What counts as a pay day in the card data.
PAYDAY_THRESHOLD = -500.0
PAYDAY_CATEGORIES = ("other", "utilities")


def payday_features(
    df: DataFrame, categories=PAYDAY_CATEGORIES, threshold: float = PAYDAY_THRESHOLD, source=None
) -> DataFrame:
    """Large credits as pay days; whole days since the latest one, 999 where there was none."""
    payday = flag(
        (F.col("amount") < threshold)
        & (F.col("merchant_category").isin(*categories) | F.col("merchant_category").isNull())
    )
    df = running(
        df,
        ACCOUNT,
        [Measure("_payday", F.when(payday == 1, F.col("_us")), "max")],
        order=["_us"],
        source=source,
        peers=True,
    )
    since = F.coalesce(F.floor((F.col("_us") - F.col("_payday")) / DAY_US), F.lit(999))
    return df.withColumns(
        {"is_potential_payday": payday, "days_since_payday": since, "is_post_payday": flag(since <= 3)}
    ).drop("_payday", "_payday_all")


def running_balance(df: DataFrame, opening: DataFrame, source=None) -> DataFrame:
    """Opening balance less the amounts up to the row; also the row's place in the account, `account_row`."""
    df = running(
        df, ACCOUNT, [Measure("_spent", units("amount")), Measure("account_row", F.lit(1))], source=source
    )
    df = with_account_tables(df, opening, source=source)
    return df.withColumn(
        "balance", money(units("opening_balance") - F.col("_spent"))
    ).drop("_spent", "_spent_all", "account_row_all")


def balance_change(df: DataFrame, source=None, default=0.0) -> DataFrame:
    df = with_previous(df, ["balance"], source)
    change = F.col("balance") - previous("balance")
    return df.withColumn("balance_change", change if default is None else F.coalesce(change, F.lit(default)))


def trend_measures(days: int = 7) -> list[Measure]:
    """What `trend_slope` needs from the trailing days. Needs `balance` and `account_row`."""
    y, place, spans = units("balance"), F.col("account_row"), (f"{days}d",)
    return [
        Measure("_tn", F.lit(1), spans=spans),
        Measure("_ty", y, spans=spans),
        Measure("_tp", place.cast("decimal(19,0)") * y.cast("decimal(18,0)"), spans=spans),
        Measure("_last", place, "max", spans=spans),
    ]


def trend_slope(days: int = 7) -> Column:
    """Least-squares slope of the balance on its position among the rows of the trailing days, 0 for one row.

    Positions in the window are the account's row numbers less a constant, so sums of row number * balance
    are enough.
    """
    s = f"{days}d"
    n, last = F.col(f"_tn_{s}"), F.col(f"_last_{s}")
    centred = 2 * F.col(f"_tp_{s}") - (2 * last - n + 1).cast("decimal(19,0)") * F.col(f"_ty_{s}").cast("decimal(18,0)")
    size = n.cast("double")
    return F.when(n > 1, money(centred) / 2 / (size * (size * size - 1) / 12)).otherwise(0.0)


def balance_trend(df: DataFrame, days: int = 7, source=None) -> DataFrame:
    measures = trend_measures(days)
    df = trailing(df, ACCOUNT, {f"{days}d": days * DAY}, measures, source=source)
    return df.withColumn(f"balance_trend_{days}d", trend_slope(days)).drop(*[f"{m.name}_{days}d" for m in measures])


def balance_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"is_low_balance": flag(F.col("balance") < 100), "is_negative_balance": flag(F.col("balance") < 0)}
    )


def city_change(df: DataFrame, source=None) -> DataFrame:
    df = with_previous(df, ["city"], source).withColumnRenamed("_prev_city", "prev_city")
    prev = F.col("prev_city")
    return df.withColumn("is_different_city", flag((F.col("city") != prev) & prev.isNotNull()))


def account_profile(df: DataFrame, attributes: list[str]) -> DataFrame:
    """First non-null value of each attribute in (time, id) order, and the first time seen."""
    at = F.struct("timestamp", "transaction_id")
    return df.groupBy("account_id").agg(
        *[F.min_by(a, F.when(F.col(a).isNotNull(), at)).alias(a) for a in attributes],
        F.min("timestamp").alias("created_date"),
    )
