"""Scans, sinks, filters and ingest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.functions import scalar as fn
from ledgerlight.plans.profiles import numeric_columns
from ledgerlight.plans.registry import TXN, padded_sql, query
from ledgerlight.session import configure, scratch_dir
from ledgerlight.sources import canonical as src
from ledgerlight.sources import files

TXN_COLUMNS = "transaction_id, account_id, amount, merchant_name, merchant_category, channel, city, is_fraud"


def _seen(df, ts="timestamp"):
    return df.withColumn(ts, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


TEXT_TIME = "strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp"


@query("scan_transactions", f"WITH {TXN} SELECT {TXN_COLUMNS}, {TEXT_TIME} FROM txn", "amount")
def scan_transactions(spark, d):
    """CSV written from the canonical rows and scanned back with an explicit schema."""
    t = src.transactions(spark, d)
    return _seen(files.read_transactions_csv(spark, files.write_csv(t, scratch_dir(spark, "transactions")))).select(
        *TXN_COLUMNS.split(", "), "timestamp"
    )


@query("scan_rejects", f"""WITH {TXN}, m AS (SELECT *, CAST(right(transaction_id, 2) AS INT) AS k FROM txn)
SELECT channel, count(*) FILTER (WHERE k >= 5) AS n_rows, sum(amount) FILTER (WHERE k >= 5) AS total, count(*) FILTER (WHERE k < 5) AS n_rejected
FROM m GROUP BY channel""", "total")
def scan_rejects(spark, d):
    """Files with differently ordered columns, in which every twentieth line is broken: what is read, and what is not."""
    t = src.transactions(spark, d).withColumn("k", F.substring("transaction_id", -2, 2).cast("int"))
    t = t.withColumn("text", F.when(F.col("k") < 3, "n/a").otherwise(F.col("amount").cast("string")))
    folder = scratch_dir(spark, "mixed")
    left = t.select("transaction_id", "account_id", "timestamp", F.col("text").alias("amount"), "channel").where("k < 3 OR k >= 50")
    right = t.select("channel", F.col("text").alias("amount"), "city", "timestamp", "account_id", "transaction_id").where("k >= 5 AND k < 50")
    # A value too few: the number of values differs from the header's.
    short = t.where("k IN (3, 4)").select(F.concat_ws(",", "channel", "transaction_id").alias("value"))
    files.write_csv(left, f"{folder}/a")
    files.write_csv(right, f"{folder}/b")
    header = spark.range(1).select(F.lit("channel,transaction_id,amount").alias("value"))
    header.union(short).coalesce(1).write.text(f"{folder}/c")
    rows, rejects = files.scan_csv(spark, f"{folder}/*")
    kept = rows.select("channel", F.col("amount"), F.lit(0).alias("bad"))
    # A rejected line's channel: the last value of the first kind of file, the first one of the last kind.
    name = F.when(F.col("line").contains("n/a"), F.substring_index("line", ",", -1)).otherwise(F.substring_index("line", ",", 1))
    both = kept.unionByName(rejects.select(name.alias("channel"), F.lit(None).cast("double").alias("amount"), F.lit(1).alias("bad")))
    return both.groupBy("channel").agg(
        F.sum(1 - F.col("bad")).alias("n_rows"), fn.money(F.sum(fn.units("amount").cast("decimal(19,0)"))).alias("total"), F.sum("bad").alias("n_rejected")
    )


@query("scan_accounts", f"SELECT concat('acc_', {padded_sql('c_custkey', 4)}) AS account_id, "
       "c_mktsegment AS segment FROM customer")
def scan_accounts(spark, d):
    path = files.write_csv(src.account_dim(spark, d).withColumn("created_date", F.lit(None).cast("date")), scratch_dir(spark, "accounts"))
    return files.read_accounts_csv(spark, path).select("account_id", "segment")


@query("scan_first_n", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 50", "value")
def scan_first_n(spark, d):
    configure(spark)
    return files.first_n(src.table(spark, d, "events"), "event_id", 50).select("event_id", "event_type", "value")


@query("canonical_transactions", f"WITH {TXN} SELECT {TXN_COLUMNS}, {TEXT_TIME}, opening_balance FROM txn", "amount opening_balance")
def canonical_transactions(spark, d):
    t = src.transactions(spark, d).join(src.opening_balances(spark, d), "account_id", "left")
    return _seen(t)


@query("scan_ordered_limit", f"WITH {TXN} SELECT account_id, amount, {TEXT_TIME} FROM txn "
       "ORDER BY txn.account_id, txn.timestamp, txn.transaction_id LIMIT 100", "amount")
def scan_ordered_limit(spark, d):
    t = src.transactions(spark, d)
    return _seen(t.orderBy("account_id", "timestamp", "transaction_id").limit(100)).select("account_id", "amount", "timestamp")


@query("sample_n", f"WITH {TXN} SELECT transaction_id, amount FROM txn ORDER BY md5(concat(transaction_id, '42')) LIMIT 200", "amount")
def sample_n(spark, d):
    return files.sample_rows(src.transactions(spark, d), "transaction_id", 200, seed=42).select("transaction_id", "amount")


@query("labelled_scan", f"WITH {TXN} SELECT transaction_id, coalesce(is_fraud, 0) AS is_fraud, {TEXT_TIME} FROM txn")
def labelled_scan(spark, d):
    t = src.transactions(spark, d)
    return _seen(t.withColumn("is_fraud", F.coalesce("is_fraud", F.lit(0)))).select("transaction_id", "is_fraud", "timestamp")


@query("sink_roundtrip", f"WITH {TXN} SELECT transaction_id, account_id, amount, strftime(timestamp, '%Y-%m-%d') AS txn_date FROM txn", "amount")
def sink_roundtrip(spark, d):
    t = src.transactions(spark, d)
    path = files.write_table(t.filter("is_fraud = 1"), scratch_dir(spark, "store"), "overwrite")
    files.write_table(t.filter("is_fraud = 0"), path, "append")
    back = spark.read.parquet(path)
    return back.select("transaction_id", "account_id", "amount", F.date_format("txn_date", "yyyy-MM-dd").alias("txn_date"))


@query("union_splits", f"""WITH {TXN} SELECT part, count(*) AS n, sum(amount) AS total FROM (
  SELECT CASE WHEN timestamp < TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS part, amount FROM txn) x GROUP BY 1""", "total")
def union_splits(spark, d):
    t = src.transactions(spark, d)
    cut = F.lit("2024-01-20").cast("timestamp")
    train = t.filter(F.col("timestamp") < cut).withColumn("part", F.lit("train"))
    test = t.filter(F.col("timestamp") >= cut).withColumn("part", F.lit("test")).drop("city")
    return src.union_splits(train, test).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), fn.money(F.sum(fn.units("amount"))).alias("total")
    )


@query("filter_account", f"WITH {TXN} SELECT transaction_id, account_id, amount FROM txn WHERE account_id = 'acc_0003'", "amount")
def filter_account(spark, d):
    return src.transactions(spark, d).filter(F.col("account_id") == F.lit("acc_0003")).select("transaction_id", "account_id", "amount")


@query("numeric_features", f"WITH {TXN} SELECT transaction_id, amount, opening_balance FROM txn", "amount opening_balance")
def numeric_features(spark, d):
    t = src.transactions(spark, d).join(src.opening_balances(spark, d), "account_id", "left")
    return t.select("transaction_id", *numeric_columns(t, ["is_fraud"]))


@query("channel_map", f"""WITH {TXN} SELECT transaction_id,
  CASE WHEN category IN ('grocery_net', 'misc_net', 'shopping_net') THEN 'online' ELSE 'pos' END AS channel, account_key
  FROM (SELECT *, concat('acc_', lpad(merchant_name, 10, '0')) AS account_key,
    CASE merchant_category WHEN 'click' THEN 'shopping_net' WHEN 'view' THEN 'misc_net' WHEN 'purchase' THEN 'grocery_pos'
      WHEN 'error' THEN 'gas_transport' ELSE merchant_category END AS category FROM txn) x""")
def channel_map(spark, d):
    t = src.transactions(spark, d)
    c = F.col("merchant_category")
    card = F.when(c == "click", "shopping_net").when(c == "view", "misc_net").when(c == "purchase", "grocery_pos").when(
        c == "error", "gas_transport"
    ).otherwise(c)
    return t.select(
        "transaction_id",
        fn.channel_of(card).alias("channel"),
        F.concat(F.lit("acc_"), fn.padded(F.col("merchant_name"), 10)).alias("account_key"),
    )


@query("calendar_dim", """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders
  UNION ALL SELECT CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events),
days AS (SELECT CAST(unnest(generate_series((SELECT min(a) FROM b), (SELECT max(z) FROM b), INTERVAL 1 DAY)) AS DATE) AS d),
h(d, holiday_name) AS (VALUES ('2023-01-01', 'New Year'), ('2023-07-04', 'Independence Day'), ('2023-12-25', 'Christmas'),
  ('2024-01-01', 'New Year'), ('2024-07-04', 'Independence Day'), ('2024-12-25', 'Christmas'))
SELECT strftime(days.d, '%Y-%m-%d') AS date, CAST(year(days.d) AS INT) AS year, CAST(month(days.d) AS INT) AS month,
  CAST(day(days.d) AS INT) AS day, CAST(isodow(days.d) - 1 AS INT) AS weekday,
  CASE WHEN isodow(days.d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN days.d = last_day(days.d) THEN 1 ELSE 0 END AS is_month_end,
  CASE WHEN h.d IS NULL THEN 0 ELSE 1 END AS is_holiday, holiday_name
FROM days LEFT JOIN h ON h.d = strftime(days.d, '%Y-%m-%d')""")
def calendar_dim(spark, d):
    configure(spark)
    ts = src.table(spark, d, "orders").select(F.col("o_orderdate").alias("timestamp")).unionByName(
        src.table(spark, d, "events").select(F.col("ts").alias("timestamp"))
    )
    return src.calendar_of(ts).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("enrich_calendar_account", f"""WITH {TXN} SELECT transaction_id, c_mktsegment AS segment,
  CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN strftime(timestamp, '%Y-%m-%d') = '2024-01-01' THEN 1 ELSE 0 END AS is_holiday,
  CASE WHEN strftime(timestamp, '%Y-%m-%d') = '2024-01-01' THEN 'New Year' END AS holiday_name
  FROM txn LEFT JOIN customer ON account_id = concat('acc_', {padded_sql('c_custkey', 4)})""")
def enrich_calendar_account(spark, d):
    t = src.transactions(spark, d)
    return src.enrich(t, src.calendar_of(t), src.account_dim(spark, d)).select(
        "transaction_id", "segment", "is_weekend", "is_holiday", "holiday_name"
    )
