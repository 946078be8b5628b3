"""Transactions, accounts, calendar and daily history in their canonical shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlight.functions.scalar import channel_of, padded
from ledgerlight.operators.cells import cell_of
from ledgerlight.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Event rows as card transactions; also fits a streaming `events`."""
    k = F.get_json_object("props", "$.k").cast("int")
    shaped = events.withColumn("_k", k).select(
        F.concat(F.lit("txn_"), padded(F.col("event_id"), 8)).alias("transaction_id"),
        F.concat(F.lit("acc_"), padded(F.col("user_id"), 4)).alias("account_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        # Money has two decimals; ten times a double may not.
        F.when(F.col("event_type") == "signup", F.round(F.col("value") * -10, 2))
        .otherwise(F.col("value"))
        .alias("amount"),
        F.concat(F.lit("m_"), F.col("_k").cast("string")).alias("merchant_name"),
        F.col("event_type").alias("merchant_category"),
        F.when(F.col("_k") % 4 == 0, "pos")
        .when(F.col("_k") % 4 == 1, "online")
        .when(F.col("_k") % 4 == 2, "atm")
        .otherwise("mobile")
        .alias("channel"),
        F.when((F.col("value") > 120) & (F.col("_k") % 3 == 0), 1).otherwise(0).alias("is_fraud"),
        (F.col("_k") % 25).alias("_nation"),
    )
    # An event without a readable or known nation stays, with no city.
    cities = nation.select(F.col("n_nationkey").alias("_nation"), F.col("n_name").alias("city"))
    return shaped.join(cities, "_nation", "left").drop("_nation")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return transactions_from_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"))


def opening_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    c = table(spark, sf_dir, "customer")
    return c.select(account_key("c_custkey").alias("account_id"), F.col("c_acctbal").alias("opening_balance"))


def account_key(key: str) -> Column:
    return F.concat(F.lit("acc_"), padded(F.col(key), 4))


def account_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account attributes; the market segment stands for the account segment, pay cycle has no source."""
    configure(spark)
    c = table(spark, sf_dir, "customer")
    return c.select(
        account_key("c_custkey").alias("account_id"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(None).cast("string").alias("pay_cycle"),
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a second, several years long transaction history (it holds ties in time)."""
    configure(spark)
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("ord_"), padded(F.col("o_orderkey"), 12)).alias("transaction_id"),
        account_key("o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.col("o_orderpriority").alias("merchant_category"),
        F.col("o_orderstatus").alias("channel"),
    )


def canonical_card(raw: DataFrame) -> DataFrame:
    """Card data set to canonical names; the id comes from the row's own transaction number."""
    renamed = raw.withColumnsRenamed(
        {
            "trans_date_trans_time": "timestamp",
            "cc_num": "account_id",
            "merchant": "merchant_name",
            "category": "merchant_category",
            "amt": "amount",
            "unix_time": "unix_timestamp",
        }
    )
    return renamed.withColumns(
        {
            "timestamp": F.col("timestamp").cast("timestamp"),
            "transaction_id": F.concat(F.lit("txn_"), padded(F.col("trans_num"), 8)),
            "account_id": F.concat(F.lit("acc_"), F.col("account_id").cast("string")),
            "channel": channel_of(F.col("merchant_category")),
        }
    )


def union_splits(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# The holidays known by default.
HOLIDAYS = {
    "2023-01-01": "New Year",
    "2023-07-04": "Independence Day",
    "2023-12-25": "Christmas",
    "2024-01-01": "New Year",
    "2024-07-04": "Independence Day",
    "2024-12-25": "Christmas",
}


def calendar_attributes(days: DataFrame, holidays: dict[str, str] = HOLIDAYS) -> DataFrame:
    """Attributes of each row's `date`; a row per day, so the lookup stays a map literal."""
    pairs = [F.lit(x) for kv in holidays.items() for x in kv]
    name = (
        F.try_element_at(F.create_map(*pairs), F.date_format("date", "yyyy-MM-dd"))
        if pairs
        else F.lit(None).cast("string")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekday("date").alias("weekday"),
        (F.weekday("date") >= 5).cast("int").alias("is_weekend"),
        (F.col("date") == F.last_day("date")).cast("int").alias("is_month_end"),
        name.isNotNull().cast("int").alias("is_holiday"),
        name.alias("holiday_name"),
    )


def calendar_between(bounds: DataFrame, first: str, last: str, holidays=HOLIDAYS) -> DataFrame:
    """Calendar over the span given by a one-row frame with the two date columns."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date"))
    return calendar_attributes(days, holidays)


def calendar_of(df: DataFrame, ts: str = "timestamp", holidays=HOLIDAYS) -> DataFrame:
    """Calendar over the days a table spans."""
    bounds = df.agg(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b")).filter("a is not null")
    return calendar_between(bounds, "a", "b", holidays)


def enrich(df: DataFrame, calendar: DataFrame, accounts: DataFrame) -> DataFrame:
    """Left joins to the calendar and the account dimension.

    An account's attributes go to its (account, hour) rows first, so the rows of a hot account are never one key.
    """
    cal = calendar.select(F.col("date").alias("_date"), "is_weekend", "is_holiday", "holiday_name")
    hour = F.coalesce(cell_of(F.unix_micros("timestamp")), F.lit(-1))
    rows = df.withColumns({"_date": F.to_date("timestamp"), "_hour": hour})
    hours = rows.select("account_id", "_hour").distinct().join(accounts, "account_id", "left")
    return rows.join(cal, "_date", "left").drop("_date").join(hours, ["account_id", "_hour"], "left").drop("_hour")
