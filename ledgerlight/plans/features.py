"""Feature queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerlight.functions import scalar as fn
from ledgerlight.operators import account as acc
from ledgerlight.operators import diversity as div
from ledgerlight.operators import merchant as mer
from ledgerlight.operators import velocity as vel
from ledgerlight.operators.cells import DAY, percentile_rank, with_time_cell
from ledgerlight.plans import profiles
from ledgerlight.plans.registry import BALANCED, BY_TIME, TXN, mean_sql, padded_sql, query, trailing_sql
from ledgerlight.sources import canonical as src

ID = "transaction_id"


def txn(spark, d):
    return with_time_cell(src.transactions(spark, d))


def balanced(spark, d):
    return profiles.with_balance(src.transactions(spark, d), src.opening_balances(spark, d))


def names(prefixes: str, spans) -> list[str]:
    return [f"{p}_{s}" for s in spans for p in prefixes.split()]


# --- scalar features ---------------------------------------------------------------------------------------


@query("time_features", f"""WITH {TXN}, p AS (SELECT transaction_id, CAST(hour(timestamp) AS INT) AS hour_of_day,
  CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CAST(month(timestamp) AS INT) AS month,
  CAST(day(timestamp) AS INT) AS day_of_month FROM txn)
SELECT *, CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour_of_day >= 22 OR hour_of_day <= 6 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN hour_of_day BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
  CASE WHEN day_of_month >= 25 THEN 1 ELSE 0 END AS is_month_end_week,
  CASE WHEN month IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS is_quarter_end FROM p""")
def time_features(spark, d):
    return fn.time_features(src.transactions(spark, d).select(ID, "timestamp")).drop("timestamp")


@query("amount_features", f"""WITH {TXN} SELECT transaction_id, abs(amount) AS amount_abs,
  CASE WHEN amount > 0 THEN 1 ELSE 0 END AS is_debit, CASE WHEN amount < 0 THEN 1 ELSE 0 END AS is_credit,
  ln(1 + abs(amount)) AS amount_log,
  CASE WHEN amount = 0 THEN NULL WHEN abs(amount) <= 25 THEN 'micro' WHEN abs(amount) <= 100 THEN 'small'
    WHEN abs(amount) <= 500 THEN 'medium' WHEN abs(amount) <= 2000 THEN 'large' ELSE 'xlarge' END AS amount_category,
  CASE WHEN amount = 0 THEN NULL WHEN abs(amount) <= 25 THEN 0 WHEN abs(amount) <= 100 THEN 1
    WHEN abs(amount) <= 500 THEN 2 WHEN abs(amount) <= 2000 THEN 3 ELSE 4 END AS amount_category_rank,
  CASE WHEN amount % 10 = 0 THEN 1 ELSE 0 END AS is_round_amount,
  CASE WHEN amount % 100 = 0 THEN 1 ELSE 0 END AS is_very_round FROM txn""", "amount_abs amount_log")
def amount_features(spark, d):
    return fn.amount_features(src.transactions(spark, d).select(ID, "amount")).drop("amount")


@query("cyclic_features", f"""WITH {TXN} SELECT transaction_id, sin(2 * pi() * hour(timestamp) / 24) AS hour_sin,
  cos(2 * pi() * hour(timestamp) / 24) AS hour_cos, sin(2 * pi() * (isodow(timestamp) - 1) / 7) AS dow_sin,
  cos(2 * pi() * (isodow(timestamp) - 1) / 7) AS dow_cos FROM txn""", "hour_sin hour_cos dow_sin dow_cos")
def cyclic_features(spark, d):
    t = fn.time_features(src.transactions(spark, d))
    return fn.cyclic_features(t).select(ID, "hour_sin", "hour_cos", "dow_sin", "dow_cos")


@query("category_codes", f"""WITH {TXN}, c AS (SELECT merchant_category, CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS INT)
  AS category_encoded FROM (SELECT DISTINCT merchant_category FROM txn) x),
l(code, label) AS (VALUES (0, 'Entertainment'), (1, 'Food & Dining'), (2, 'Gas & Transport'), (3, 'Grocery (POS)'), (4, 'Grocery (Online)'))
SELECT transaction_id, category_encoded, coalesce(label, 'Unknown') AS category_display
FROM txn JOIN c USING (merchant_category) LEFT JOIN l ON code = category_encoded""")
def category_codes(spark, d):
    t = mer.with_category_codes(src.transactions(spark, d))
    return t.select(ID, "category_encoded", fn.category_label(F.col("category_encoded")).alias("category_display"))


# --- preceding transactions --------------------------------------------------------------------------------


@query("time_since_last", f"""WITH {TXN} SELECT transaction_id,
  coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 3.6e9, 24) AS time_since_last,
  coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 3.6e9, 0) AS time_since_last_txn
  FROM txn WINDOW w AS ({BY_TIME})""", "time_since_last time_since_last_txn")
def time_since_last(spark, d):
    t = txn(spark, d)
    t = vel.with_previous(t, ["_us"])
    return t.select(
        ID, vel.hours_since_previous(24.0).alias("time_since_last"), vel.hours_since_previous(0.0).alias("time_since_last_txn")
    )


@query("amount_change", f"""WITH {TXN}, p AS (SELECT transaction_id, amount, coalesce(lag(amount) OVER ({BY_TIME}), 0) AS prev_amount FROM txn)
SELECT transaction_id, prev_amount, amount - prev_amount AS amount_change,
  CASE WHEN prev_amount + 1 <> 0 THEN amount / (prev_amount + 1) END AS amount_ratio FROM p""", "prev_amount amount_change amount_ratio")
def amount_change(spark, d):
    t = vel.previous_amount_features(vel.with_previous(txn(spark, d), ["amount"]))
    return t.select(ID, "prev_amount", "amount_change", "amount_ratio")


@query("txn_count_last_n", f"""WITH {TXN}, p AS (SELECT transaction_id, row_number() OVER ({BY_TIME}) - 1 AS n FROM txn)
SELECT transaction_id, CAST(least(n, 5) AS INT) AS txn_count_last_5, CAST(least(n, 10) AS INT) AS txn_count_last_10,
  CAST(least(n, 20) AS INT) AS txn_count_last_20 FROM p""")
def txn_count_last_n(spark, d):
    t = vel.number_rows(txn(spark, d), vel.ACCOUNT)
    return t.select(ID, *[vel.count_before(n).alias(f"txn_count_last_{n}") for n in vel.COUNT_STEPS])


ROW_STATS = [f"amount_{s}_last_{n}" for n in (5, 10, 20) for s in ("mean", "std", "max")]


def _row_sql(n):
    w = f"({BY_TIME} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return (
        f"coalesce(avg(amount) OVER {w}, avg(amount) OVER (PARTITION BY account_id)) AS amount_mean_last_{n}, "
        f"coalesce(stddev_samp(amount) OVER {w}, 0) AS amount_std_last_{n}, "
        f"coalesce(max(amount) OVER {w}, avg(amount) OVER (PARTITION BY account_id)) AS amount_max_last_{n}"
    )


@query("rolling_rows", f"WITH {TXN} SELECT transaction_id, {', '.join(_row_sql(n) for n in (5, 10, 20))} FROM txn", " ".join(ROW_STATS))
def rolling_rows(spark, d):
    t = txn(spark, d)
    return vel.row_window_features(vel.with_recent(vel.with_account_amounts(vel.number_rows(t, vel.ACCOUNT), t))).select(ID, *ROW_STATS)


# --- trailing time windows ---------------------------------------------------------------------------------

ROLLING = names("debit_sum credit_sum amount_mean amount_std amount_max", vel.ROLLING_DAYS)
ROLLING_SQL = ", ".join(
    f"count(*) OVER w{s} AS txn_count_{s}, sum(greatest(amount, 0)) OVER w{s} AS debit_sum_{s}, "
    f"sum(least(amount, 0)) OVER w{s} AS credit_sum_{s}, {mean_sql('abs(amount)', f'w{s}')} AS amount_mean_{s}, "
    f"coalesce(stddev_samp(abs(amount)) OVER w{s}, 0) AS amount_std_{s}, max(abs(amount)) OVER w{s} AS amount_max_{s}"
    for s in vel.ROLLING_DAYS
)
ROLLING_WINDOWS = "WINDOW " + ", ".join(f"w{s} AS ({trailing_sql(sec)})" for s, sec in vel.ROLLING_DAYS.items())


@query("rolling_days", f"WITH {TXN} SELECT transaction_id, {ROLLING_SQL} FROM txn {ROLLING_WINDOWS}", " ".join(ROLLING))
def rolling_days(spark, d):
    return vel.rolling_days(txn(spark, d)).select(ID, *names("txn_count", vel.ROLLING_DAYS), *ROLLING)


ORDERS_TXN = f"""ord AS (SELECT concat('ord_', {padded_sql('o_orderkey', 12)}) AS transaction_id,
  concat('acc_', {padded_sql('o_custkey', 4)}) AS account_id, o_orderdate AS timestamp,
  CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders)"""


@query("rolling_days_orders", f"WITH {ORDERS_TXN} SELECT transaction_id, {ROLLING_SQL} FROM ord {ROLLING_WINDOWS}", " ".join(ROLLING))
def rolling_days_orders(spark, d):
    """Same windows over several years of history with ties in time."""
    t = with_time_cell(src.order_history(spark, d))
    return vel.rolling_days(t).select(ID, *names("txn_count", vel.ROLLING_DAYS), *ROLLING)


RATIOS = ["velocity_7d_vs_30d", "velocity_1d_vs_7d", "txn_velocity_7d_vs_30d"]
RATIO_SQL = """debit_sum_7d / (debit_sum_30d + 1e-6) AS velocity_7d_vs_30d, debit_sum_1d / (debit_sum_7d + 1e-6) AS velocity_1d_vs_7d,
  txn_count_7d / (txn_count_30d + 1e-6) AS txn_velocity_7d_vs_30d"""


@query("velocity_ratios", f"WITH {TXN}, r AS (SELECT transaction_id, {ROLLING_SQL} FROM txn {ROLLING_WINDOWS}) SELECT transaction_id, {RATIO_SQL} FROM r", " ".join(RATIOS))
def velocity_ratios(spark, d):
    spans = {s: vel.ROLLING_DAYS[s] for s in ("1d", "7d", "30d")}
    return vel.velocity_ratios(vel.rolling_days(txn(spark, d), spans)).select(ID, *RATIOS)


ANOMALY_SQL = """CASE WHEN hour(timestamp) < 6 THEN 1 ELSE 0 END AS is_unusual_hour,
  (abs(amount) - amount_mean_7d) / (amount_std_7d + 1e-6) AS amount_zscore_7d,
  (abs(amount) - amount_mean_30d) / (amount_std_30d + 1e-6) AS amount_zscore_30d"""


@query("anomaly_features", f"""WITH {BALANCED}, r AS (SELECT transaction_id, timestamp, amount, balance, {ROLLING_SQL},
  row_number() OVER w AS rn, coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 3.6e9, 0) AS gap,
  avg(amount) OVER (PARTITION BY account_id) AS am,
  avg(amount) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS m10, max(amount) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS x10
  FROM bal {ROLLING_WINDOWS}, w AS ({BY_TIME}))
SELECT transaction_id, {ANOMALY_SQL}, CASE WHEN balance < 100 THEN 1 ELSE 0 END AS is_low_balance,
  CASE WHEN balance < 0 THEN 1 ELSE 0 END AS is_negative_balance, CASE WHEN gap < 0.5 THEN 1 ELSE 0 END AS rapid_succession,
  CASE WHEN coalesce(m10, am) + 1 <> 0 THEN amount / (coalesce(m10, am) + 1) END AS amount_vs_recent_avg,
  CASE WHEN coalesce(x10, am) + 1 <> 0 THEN amount / (coalesce(x10, am) + 1) END AS amount_vs_recent_max FROM r""",
  "amount_zscore_7d amount_zscore_30d amount_vs_recent_avg amount_vs_recent_max")
def anomaly_features(spark, d):
    t = balanced(spark, d)
    df = vel.rolling_zscores(vel.rolling_days(t, {s: vel.ROLLING_DAYS[s] for s in ("7d", "30d")}, source=t))
    df = vel.with_recent(vel.with_account_amounts(df, t))
    df = vel.amount_position(vel.row_window_features(df.withColumn("gap", vel.hours_since_previous(0.0))))
    df = acc.balance_flags(df).withColumns(
        {"is_unusual_hour": fn.flag(F.hour("timestamp") < 6), "rapid_succession": fn.flag(F.col("gap") < 0.5)}
    )
    return df.select(ID, "is_unusual_hour", "amount_zscore_7d", "amount_zscore_30d", "is_low_balance",
                     "is_negative_balance", "rapid_succession", "amount_vs_recent_avg", "amount_vs_recent_max")


WINDOW_COLUMNS = (
    [f"amt_{s}_{w}" for w in ("24H", "7D", "30D") for s in ("mean", "std")]
    + ["amt_zscore_24h", "amt_zscore_7d", "amt_pct_vs_24h", "amt_pct_vs_7d", "vel_1h_vs_24h", "vel_6h_vs_7d"]
)


@query("velocity_windows", f"""WITH {TXN}, r AS (SELECT transaction_id, amount,
  {', '.join(f'count(*) OVER w{s} AS txn_count_{s}' for s in ('1H', '6H', '24H', '7D'))},
  {', '.join(f'{mean_sql("amount", f"w{s}")} AS amt_mean_{s}, coalesce(stddev_samp(amount) OVER w{s}, 0) AS amt_std_{s}' for s in ('24H', '7D', '30D'))}
  FROM txn WINDOW {', '.join(f'w{s} AS ({trailing_sql(sec)})' for s, sec in vel.HOUR_SPANS.items())})
SELECT *, (amount - amt_mean_24H) / (amt_std_24H + 1e-8) AS amt_zscore_24h, (amount - amt_mean_7D) / (amt_std_7D + 1e-8) AS amt_zscore_7d,
  CASE WHEN amt_mean_24H + 1 <> 0 THEN amount / (amt_mean_24H + 1) END AS amt_pct_vs_24h,
  CASE WHEN amt_mean_7D + 1 <> 0 THEN amount / (amt_mean_7D + 1) END AS amt_pct_vs_7d,
  txn_count_1H / (txn_count_24H + 1e-6) AS vel_1h_vs_24h, txn_count_6H / (txn_count_7D + 1e-6) AS vel_6h_vs_7d FROM r""",
  "amount " + " ".join(WINDOW_COLUMNS))
def velocity_windows(spark, d):
    t = vel.velocity_windows(txn(spark, d))
    return t.select(ID, "amount", *[f"txn_count_{s}" for s in ("1H", "6H", "24H", "7D")], *WINDOW_COLUMNS)


@query("hourly_txn_count", f"WITH {TXN} SELECT transaction_id, count(*) OVER (PARTITION BY account_id, date_trunc('hour', timestamp)) AS hourly_txn_count FROM txn")
def hourly_txn_count(spark, d):
    return vel.hourly_txn_count(src.transactions(spark, d)).select(ID, "hourly_txn_count")


# --- diversity -----------------------------------------------------------------------------------------------


def _distinct_sql(spec):
    days = spec.days * DAY
    return f"count(DISTINCT {spec.column}) OVER ({trailing_sql(days)}) AS {spec.name}"


@query("rolling_distinct", f"WITH {TXN} SELECT transaction_id, {', '.join(_distinct_sql(s) for s in div.CATALOGUE_PROFILE)} FROM txn")
def rolling_distinct(spark, d):
    specs = [replace(s, entropy=None) for s in div.CATALOGUE_PROFILE]
    return div.rolling_diversity(txn(spark, d), specs).select(ID, *[s.name for s in specs])


ENTROPY_SQL = f"""
cats AS (SELECT DISTINCT merchant_category AS cat FROM txn),
shares AS (SELECT transaction_id, cat, count(*) FILTER (WHERE merchant_category = cat) OVER (PARTITION BY cat, account_id
    ORDER BY epoch_us(timestamp) RANGE BETWEEN CAST({7 * DAY * 1_000_000 - 1} AS BIGINT) PRECEDING AND CURRENT ROW) AS c,
  count(*) OVER (PARTITION BY cat, account_id
    ORDER BY epoch_us(timestamp) RANGE BETWEEN CAST({7 * DAY * 1_000_000 - 1} AS BIGINT) PRECEDING AND CURRENT ROW) AS n
  FROM txn CROSS JOIN cats),
entropy AS (SELECT transaction_id, -sum(CASE WHEN c > 0 THEN c / n * log2(c / n) ELSE 0 END) AS category_entropy_7d FROM shares GROUP BY 1)"""


@query("category_entropy", f"WITH {TXN}, {ENTROPY_SQL} SELECT * FROM entropy", "category_entropy_7d")
def category_entropy(spark, d):
    spec = [div.Diversity("n_categories", "merchant_category", 7, "category_entropy_7d")]
    return div.rolling_diversity(txn(spark, d), spec).select(ID, "category_entropy_7d")


# --- merchants -----------------------------------------------------------------------------------------------


@query("first_seen_merchant", f"""WITH {TXN} SELECT transaction_id, CASE WHEN row_number() OVER (PARTITION BY account_id, merchant_name
  ORDER BY timestamp, transaction_id) = 1 THEN 1 ELSE 0 END AS is_new_merchant FROM txn""")
def first_seen_merchant(spark, d):
    return mer.first_seen_merchant(src.transactions(spark, d)).select(ID, "is_new_merchant")


@query("merchant_frequency", f"""WITH {TXN}, p AS (SELECT transaction_id, count(*) OVER (PARTITION BY merchant_name) AS merchant_frequency FROM txn)
SELECT *, CASE WHEN merchant_frequency <= 5 THEN 1 ELSE 0 END AS is_rare_merchant FROM p""")
def merchant_frequency(spark, d):
    return mer.merchant_frequency(src.transactions(spark, d)).select(ID, "merchant_frequency", "is_rare_merchant")


@query("adv_merchant_freq", f"""WITH {TXN}, p AS (SELECT transaction_id, count(*) OVER (PARTITION BY account_id, merchant_name) AS merch_freq_account FROM txn)
SELECT *, CASE WHEN merch_freq_account = 1 THEN 1 ELSE 0 END AS is_new_merchant FROM p""")
def adv_merchant_freq(spark, d):
    return mer.account_merchant_frequency(src.transactions(spark, d)).select(ID, "merch_freq_account", "is_new_merchant")


@query("adv_merchant_stats", f"""WITH {TXN} SELECT merchant_name, avg(amount) AS merch_amt_mean, coalesce(stddev_samp(amount), 0) AS merch_amt_std,
  count(*) AS merch_txn_count, avg(is_fraud) AS merch_fraud_rate FROM txn GROUP BY 1""", "merch_amt_mean merch_amt_std merch_fraud_rate")
def adv_merchant_stats(spark, d):
    return mer.merchant_stats(src.transactions(spark, d))


@query("adv_merchant_risk", f"""WITH {TXN} SELECT transaction_id, avg(is_fraud) OVER (PARTITION BY merchant_name) AS merch_fraud_rate,
  count(*) OVER (PARTITION BY merchant_category) AS merch_cat_freq, avg(is_fraud) OVER (PARTITION BY merchant_category) AS merch_cat_risk,
  avg(is_fraud) OVER (PARTITION BY merchant_name ORDER BY timestamp, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS merch_fraud_rate_prior FROM txn""", "merch_fraud_rate merch_cat_risk merch_fraud_rate_prior")
def adv_merchant_risk(spark, d):
    t = txn(spark, d)
    df = mer.prior_merchant_risk(mer.category_risk(mer.with_merchant_stats(t, t), t), t)
    return df.select(ID, "merch_fraud_rate", "merch_cat_freq", "merch_cat_risk", "merch_fraud_rate_prior")


@query("merchant_defaults", f"""WITH {TXN} SELECT transaction_id, 1 AS merch_freq_account, (SELECT avg(amount) FROM txn) AS merch_amt_mean,
  (SELECT stddev_samp(amount) FROM txn) AS merch_amt_std, 1 AS merch_txn_count, 0.0 AS merch_fraud_rate, 1 AS merch_cat_freq,
  0.5 AS merch_cat_risk, 1 AS is_new_merchant FROM txn""", "merch_amt_mean merch_amt_std merch_fraud_rate merch_cat_risk")
def merchant_defaults(spark, d):
    return mer.merchant_defaults(src.transactions(spark, d).select(ID, "amount")).drop("amount")


# --- accounts ------------------------------------------------------------------------------------------------


@query("basic_account_stats", f"""WITH {TXN} SELECT account_id, avg(amount) AS avg_amount, stddev_samp(amount) AS std_amount, count(*) AS txn_count,
  count(DISTINCT merchant_name) AS unique_merchants, count(DISTINCT merchant_category) AS unique_categories FROM txn GROUP BY 1""", "avg_amount std_amount")
def basic_account_stats(spark, d):
    t = txn(spark, d)
    return profiles.basic_account_stats(t, t).groupBy("account_id").agg(
        *[F.max(c).alias(c) for c in ("avg_amount", "std_amount", "txn_count", "unique_merchants", "unique_categories")]
    )


@query("adv_amount_zscore", f"""WITH {TXN} SELECT transaction_id, coalesce((amount - avg(amount) OVER w) / (stddev_samp(amount) OVER w + 1e-8), 0) AS amount_zscore
  FROM txn WINDOW w AS (PARTITION BY account_id)""", "amount_zscore")
def adv_amount_zscore(spark, d):
    t = vel.with_account_amounts(txn(spark, d))
    z = fn.ratio(F.col("amount") - F.col("account_mean"), F.col("account_std") + 1e-8)
    return t.select(ID, F.coalesce(z, F.lit(0.0)).alias("amount_zscore"))


PERCENTILE_SQL = """(rank() OVER (PARTITION BY account_id ORDER BY amount) + (count(*) OVER (PARTITION BY account_id, amount) - 1) / 2.0)
  / count(*) OVER (PARTITION BY account_id)"""


@query("amount_percentile", f"WITH {TXN} SELECT transaction_id, {PERCENTILE_SQL} AS amount_percentile FROM txn", "amount_percentile")
def amount_percentile(spark, d):
    return percentile_rank(src.transactions(spark, d), "account_id", "amount", "amount_percentile").select(ID, "amount_percentile")


@query("account_age", f"""WITH {TXN} SELECT transaction_id, CAST(floor((epoch_us(timestamp) - min(epoch_us(timestamp)) OVER (PARTITION BY account_id))
  / 86400000000) AS BIGINT) AS account_age_days FROM txn""")
def account_age(spark, d):
    return acc.account_age(txn(spark, d)).select(ID, "account_age_days")


@query("avg_daily_spending", f"""WITH {TXN} SELECT account_id, avg(s) AS avg_daily_spending FROM (SELECT account_id, CAST(timestamp AS DATE) AS ds,
  sum(amount) AS s FROM txn GROUP BY 1, 2) x GROUP BY 1""", "avg_daily_spending")
def avg_daily_spending(spark, d):
    return acc.average_daily_spending(src.transactions(spark, d))


WEEKEND_SQL = """sum(CASE WHEN isodow(timestamp) >= 6 THEN amount ELSE 0 END) / (sum(CASE WHEN isodow(timestamp) < 6 THEN amount ELSE 0 END) + 1e-6)"""


@query("weekend_ratio", f"WITH {TXN} SELECT account_id, {WEEKEND_SQL} AS weekend_spending_ratio FROM txn GROUP BY 1", "weekend_spending_ratio")
def weekend_ratio(spark, d):
    return acc.weekend_ratio(src.transactions(spark, d), fn.is_weekend())


PAYDAY_SQL = f"""SELECT transaction_id, is_potential_payday, CAST(coalesce(floor((us - max(CASE WHEN is_potential_payday = 1 THEN us END)
    OVER (PARTITION BY account_id ORDER BY us)) / 86400000000), 999) AS BIGINT) AS days_since_payday
  FROM (SELECT *, epoch_us(timestamp) AS us, CASE WHEN amount < -500 AND merchant_category = 'signup' THEN 1 ELSE 0 END AS is_potential_payday FROM txn) x"""


@query("days_since_payday", f"WITH {TXN}, p AS ({PAYDAY_SQL}) SELECT *, CASE WHEN days_since_payday <= 3 THEN 1 ELSE 0 END AS is_post_payday FROM p")
def days_since_payday(spark, d):
    return acc.payday_features(txn(spark, d), categories=("signup",)).select(
        ID, "is_potential_payday", "days_since_payday", "is_post_payday"
    )


@query("account_profile", f"""WITH {TXN} SELECT account_id, first(merchant_name ORDER BY timestamp, transaction_id) AS merchant_name,
  first(city ORDER BY timestamp, transaction_id) AS city, first(channel ORDER BY timestamp, transaction_id) AS channel,
  strftime(min(timestamp), '%Y-%m-%d') AS created_date FROM txn GROUP BY 1""")
def account_profile(spark, d):
    t = acc.account_profile(src.transactions(spark, d), ["merchant_name", "city", "channel"])
    return t.withColumn("created_date", F.date_format("created_date", "yyyy-MM-dd"))


# --- balance -------------------------------------------------------------------------------------------------


@query("running_balance", f"WITH {BALANCED} SELECT transaction_id, balance FROM bal", "balance")
def running_balance(spark, d):
    t = txn(spark, d)
    return acc.running_balance(t, src.opening_balances(spark, d)).select(ID, "balance")


@query("balance_change", f"WITH {BALANCED} SELECT transaction_id, coalesce(balance - lag(balance) OVER ({BY_TIME}), 0) AS balance_change FROM bal", "balance_change")
def balance_change(spark, d):
    return acc.balance_change(balanced(spark, d)).select(ID, "balance_change")


TREND_SQL = f"""n AS (SELECT *, row_number() OVER ({BY_TIME}) AS rn FROM bal),
trend AS (SELECT transaction_id, CASE WHEN count(*) OVER w > 1 THEN regr_slope(balance, rn) OVER w ELSE 0 END AS balance_trend_7d
  FROM n WINDOW w AS ({trailing_sql(7 * DAY)}))"""


@query("balance_trend", f"WITH {BALANCED}, {TREND_SQL} SELECT * FROM trend", "balance_trend_7d")
def balance_trend(spark, d):
    return acc.balance_trend(balanced(spark, d)).select(ID, "balance_trend_7d")


@query("city_change", f"""WITH {TXN}, p AS (SELECT transaction_id, city, lag(city) OVER ({BY_TIME}) AS prev_city FROM txn)
SELECT transaction_id, prev_city, CASE WHEN prev_city IS NOT NULL AND city <> prev_city THEN 1 ELSE 0 END AS is_different_city FROM p""")
def city_change(spark, d):
    return acc.city_change(txn(spark, d)).select(ID, "prev_city", "is_different_city")


# --- profiles ------------------------------------------------------------------------------------------------

RISK_SQL = f"""base AS (SELECT *, coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 3.6e9, 24) AS time_since_last,
    coalesce(lag(amount) OVER w, 0) AS prev_amount, row_number() OVER w - 1 AS seen,
    coalesce(avg(amount) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), avg(amount) OVER a) AS amount_mean_last_10,
    coalesce((amount - avg(amount) OVER a) / (stddev_samp(amount) OVER a + 1e-8), 0) AS amount_zscore,
    count(*) OVER (PARTITION BY account_id, merchant_name) AS merch_freq_account,
    CASE WHEN hour(timestamp) >= 22 OR hour(timestamp) <= 6 THEN 1 ELSE 0 END AS is_night,
    CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM txn WINDOW w AS ({BY_TIME}), a AS (PARTITION BY account_id)),
flags AS (SELECT *, CASE WHEN amount_mean_last_10 + 1 <> 0 THEN amount / (amount_mean_last_10 + 1) END AS vel_recent_vs_avg,
    CASE WHEN time_since_last < 0.083 THEN 1 ELSE 0 END AS rapid_fire,
    CASE WHEN time_since_last < 0.5 THEN 1 ELSE 0 END AS rapid_succession,
    CASE WHEN merch_freq_account = 1 THEN 1 ELSE 0 END AS is_new_merchant,
    CASE WHEN is_night = 1 OR is_weekend = 1 THEN 1 ELSE 0 END AS risk_time,
    CASE WHEN abs(amount_zscore) > 2 THEN 1 ELSE 0 END AS risk_amount_anomaly FROM base),
risk AS (SELECT *, CASE WHEN rapid_fire = 1 OR time_since_last < 0.017 THEN 1 ELSE 0 END AS risk_velocity,
    CASE WHEN is_new_merchant = 1 AND amount > amount_mean_last_10 THEN 1 ELSE 0 END AS risk_new_merchant,
    (risk_amount_anomaly + rapid_fire + is_night + is_new_merchant + CASE WHEN vel_recent_vs_avg > 3 THEN 1 ELSE 0 END) / 5.0 AS risk_score
  FROM flags)"""


@query("rapid_flags", f"WITH {TXN}, {RISK_SQL} SELECT transaction_id, vel_recent_vs_avg, rapid_fire, rapid_succession FROM flags", "vel_recent_vs_avg")
def rapid_flags(spark, d):
    t = txn(spark, d)
    df = vel.row_window_features(vel.with_recent(vel.with_account_amounts(vel.number_rows(t, vel.ACCOUNT), t)))
    df = vel.rapid_flags(df.withColumn("time_since_last", vel.hours_since_previous(24.0)))
    return df.select(ID, "vel_recent_vs_avg", "rapid_fire", "rapid_succession")


RISK_COLUMNS = ["risk_time", "risk_amount_anomaly", "risk_velocity", "risk_new_merchant"]


@query("risk_score", f"WITH {TXN}, {RISK_SQL} SELECT transaction_id, {', '.join(RISK_COLUMNS)}, risk_score FROM risk", "risk_score")
def risk_score(spark, d):
    return profiles.with_risk(src.transactions(spark, d)).select(ID, *RISK_COLUMNS, "risk_score")


BASIC_DOUBLES = "amount amount_abs amount_log avg_amount std_amount amount_zscore"


BASIC_SQL = f"""WITH {TXN}, p AS (SELECT transaction_id, account_id, amount, is_fraud, CAST(hour(timestamp) AS INT) AS hour_of_day,
  CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(timestamp) >= 22 OR hour(timestamp) <= 6 THEN 1 ELSE 0 END AS is_night, abs(amount) AS amount_abs,
  ln(1 + abs(amount)) AS amount_log,
  CASE WHEN abs(amount) > (SELECT quantile_cont(abs(amount), 0.95) FROM txn) THEN 1 ELSE 0 END AS is_large_amount,
  count(*) OVER (PARTITION BY merchant_name) AS merchant_frequency,
  CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS INT) AS category_encoded FROM txn),
s AS (SELECT account_id, avg(amount) AS avg_amount, stddev_samp(amount) AS std_amount, count(*) AS txn_count,
  count(DISTINCT merchant_name) AS unique_merchants, count(DISTINCT merchant_category) AS unique_categories FROM txn GROUP BY 1)
SELECT p.*, avg_amount, coalesce(std_amount, 0) AS std_amount, txn_count, unique_merchants, unique_categories,
  coalesce((amount_abs - avg_amount) / (std_amount + 1e-6), 0) AS amount_zscore,
  CASE WHEN merchant_frequency <= 5 THEN 1 ELSE 0 END AS is_rare_merchant FROM p JOIN s USING (account_id)"""


@query("feature_store_basic", BASIC_SQL, BASIC_DOUBLES)
def feature_store_basic(spark, d):
    return profiles.basic(src.transactions(spark, d)).drop("timestamp")


ADV_DOUBLES = (
    ["amount", "time_since_last", "prev_amount", "amount_change", "amount_ratio", "vel_recent_vs_avg"]
    + ROW_STATS
    + ["amount_zscore", "amount_percentile", "amount_vs_recent_avg", "amount_vs_recent_max", "merch_amt_mean", "merch_amt_std",
       "merch_fraud_rate", "merch_cat_risk", "avg_daily_spending", "risk_score"]
)
ADV_INTS = (
    ["is_weekend", "is_night", "rapid_fire", "merch_freq_account", "is_new_merchant", "merch_txn_count", "merch_cat_freq",
     "account_age_days", "merchant_diversity", "category_diversity", "is_round_amount", "is_very_round", "hour", "day_of_week", "month",
     "is_business_hours"] + RISK_COLUMNS
)


@query("feature_store_advanced", f"""WITH {TXN}, {RISK_SQL},
rows_ AS (SELECT transaction_id, {', '.join(_row_sql(n) for n in (5, 10, 20))}, {PERCENTILE_SQL} AS amount_percentile,
  avg(amount) OVER m AS merch_amt_mean, coalesce(stddev_samp(amount) OVER m, 0) AS merch_amt_std, count(*) OVER m AS merch_txn_count,
  avg(is_fraud) OVER m AS merch_fraud_rate, count(*) OVER c AS merch_cat_freq, avg(is_fraud) OVER c AS merch_cat_risk,
  CAST(floor((epoch_us(timestamp) - min(epoch_us(timestamp)) OVER (PARTITION BY account_id)) / 86400000000) AS BIGINT) AS account_age_days,
  timestamp AS when_
  FROM txn WINDOW m AS (PARTITION BY merchant_name), c AS (PARTITION BY merchant_category)),
spend AS (SELECT account_id, avg(s) AS avg_daily_spending FROM (SELECT account_id, CAST(timestamp AS DATE) AS ds, sum(amount) AS s FROM txn GROUP BY 1, 2) x GROUP BY 1),
dv AS (SELECT account_id, count(DISTINCT merchant_name) AS merchant_diversity, count(DISTINCT merchant_category) AS category_diversity FROM txn GROUP BY 1),
joined AS (SELECT risk.*, rows_.* EXCLUDE (transaction_id), avg_daily_spending, merchant_diversity, category_diversity,
  amount - prev_amount AS amount_change, CASE WHEN prev_amount + 1 <> 0 THEN amount / (prev_amount + 1) END AS amount_ratio,
  CASE WHEN rows_.amount_mean_last_10 + 1 <> 0 THEN amount / (rows_.amount_mean_last_10 + 1) END AS amount_vs_recent_avg,
  CASE WHEN amount_max_last_10 + 1 <> 0 THEN amount / (amount_max_last_10 + 1) END AS amount_vs_recent_max,
  CASE WHEN amount % 10 = 0 THEN 1 ELSE 0 END AS is_round_amount, CASE WHEN amount % 100 = 0 THEN 1 ELSE 0 END AS is_very_round,
  CAST(hour(when_) AS INT) AS hour, CAST(isodow(when_) - 1 AS INT) AS day_of_week, CAST(month(when_) AS INT) AS month,
  CASE WHEN hour(when_) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours
  FROM (SELECT * EXCLUDE (amount_mean_last_10) FROM risk) risk JOIN rows_ USING (transaction_id) JOIN spend USING (account_id) JOIN dv USING (account_id))
SELECT transaction_id, {', '.join(ADV_DOUBLES + ADV_INTS)} FROM joined""", " ".join(ADV_DOUBLES))
def feature_store_advanced(spark, d):
    return profiles.advanced(src.transactions(spark, d)).select(ID, *ADV_DOUBLES, *ADV_INTS)


FULL_DOUBLES = (
    ROLLING + RATIOS + ["category_entropy_7d", "time_since_last_txn", "weekend_spending_ratio", "balance", "balance_change",
                        "balance_trend_7d", "amount_zscore_7d", "amount_zscore_30d", "amount_log", "amount_abs"]
)
FULL_INTS = names("txn_count", vel.ROLLING_DAYS) + [s.name for s in div.FULL_PROFILE] + [
    "is_new_merchant", "txn_count_1h", "days_since_payday", "is_post_payday", "is_low_balance", "is_negative_balance",
    "is_different_city", "rapid_succession", "is_unusual_hour", "is_weekend", "is_holiday", "hour_of_day", "day_of_week", "month",
    "day_of_month", "is_business_hours", "is_night", "is_month_end_week", "is_quarter_end", "is_debit", "is_credit"]
FULL_TEXTS = ["amount_category", "segment", "holiday_name", "prev_city"]
TIME_PARTS_SQL = """CAST(hour(timestamp) AS INT) AS {hour}, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CAST(month(timestamp) AS INT) AS month,
  CASE WHEN hour(timestamp) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours"""


def full_store(spark, d, diversity=div.FULL_PROFILE):
    t = src.transactions(spark, d)
    return profiles.full(
        t, src.opening_balances(spark, d), src.calendar_of(t), src.account_dim(spark, d), ("signup",), diversity
    )


@query("feature_store_full", f"""WITH {BALANCED}, {ENTROPY_SQL}, {TREND_SQL}, pay AS ({PAYDAY_SQL}),
wk AS (SELECT account_id, {WEEKEND_SQL} AS weekend_spending_ratio FROM txn GROUP BY 1),
r AS (SELECT transaction_id, account_id, timestamp, amount, balance, {ROLLING_SQL}, {', '.join(_distinct_sql(s) for s in div.FULL_PROFILE)},
  coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 3.6e9, 0) AS time_since_last_txn,
  coalesce(balance - lag(balance) OVER w, 0) AS balance_change, lag(city) OVER w AS prev_city, city,
  CASE WHEN row_number() OVER (PARTITION BY account_id, merchant_name ORDER BY timestamp, transaction_id) = 1 THEN 1 ELSE 0 END AS is_new_merchant,
  count(*) OVER (PARTITION BY account_id, date_trunc('hour', timestamp)) AS txn_count_1h
  FROM bal {ROLLING_WINDOWS}, w AS ({BY_TIME})),
f AS (SELECT *, {RATIO_SQL}, {ANOMALY_SQL}, ln(1 + abs(amount)) AS amount_log,
  CASE WHEN days_since_payday <= 3 THEN 1 ELSE 0 END AS is_post_payday, CASE WHEN balance < 100 THEN 1 ELSE 0 END AS is_low_balance,
  CASE WHEN balance < 0 THEN 1 ELSE 0 END AS is_negative_balance,
  CASE WHEN prev_city IS NOT NULL AND city <> prev_city THEN 1 ELSE 0 END AS is_different_city,
  CASE WHEN time_since_last_txn < 0.5 THEN 1 ELSE 0 END AS rapid_succession,
  CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN strftime(timestamp, '%Y-%m-%d') = '2024-01-01' THEN 1 ELSE 0 END AS is_holiday,
  {TIME_PARTS_SQL.format(hour="hour_of_day")}, CAST(day(timestamp) AS INT) AS day_of_month,
  CASE WHEN hour(timestamp) >= 22 OR hour(timestamp) <= 6 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN day(timestamp) >= 25 THEN 1 ELSE 0 END AS is_month_end_week,
  CASE WHEN month(timestamp) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS is_quarter_end,
  abs(amount) AS amount_abs, CASE WHEN amount > 0 THEN 1 ELSE 0 END AS is_debit, CASE WHEN amount < 0 THEN 1 ELSE 0 END AS is_credit,
  CASE WHEN amount = 0 THEN NULL WHEN abs(amount) <= 25 THEN 'micro' WHEN abs(amount) <= 100 THEN 'small' WHEN abs(amount) <= 500 THEN 'medium'
    WHEN abs(amount) <= 2000 THEN 'large' ELSE 'xlarge' END AS amount_category, c_mktsegment AS segment,
  CASE WHEN strftime(timestamp, '%Y-%m-%d') = '2024-01-01' THEN 'New Year' END AS holiday_name
  FROM r LEFT JOIN customer ON account_id = concat('acc_', {padded_sql('c_custkey', 4)}) JOIN entropy USING (transaction_id) JOIN trend USING (transaction_id) JOIN pay USING (transaction_id) JOIN wk USING (account_id))
SELECT transaction_id, {', '.join(FULL_DOUBLES + FULL_INTS + FULL_TEXTS)} FROM f""", " ".join(FULL_DOUBLES))
def feature_store_full(spark, d):
    return full_store(spark, d).select(ID, *FULL_DOUBLES, *FULL_INTS, *FULL_TEXTS)


@query("feature_catalogue")
def feature_catalogue(spark, d):
    """Every listed feature with the number of rows that have it."""
    t = src.transactions(spark, d)
    from ledgerlight.operators.quality import long_form

    def counted(df, listed, profile):
        have = profiles.available(df, listed)
        row = df.agg(*[F.count(c).alias(c) for c in have])
        return long_form(row, have, "feature", "rows_present").withColumn("profile", F.lit(profile))

    full = vel.rolling_zscores(full_store(spark, d, div.CATALOGUE_PROFILE), ("1d", "14d"))
    adv = profiles.advanced(t, declared_windows=True)
    return counted(adv, profiles.ADVANCED_CATALOGUE, "advanced").unionByName(
        counted(full, profiles.full_catalogue(v_columns=False), "full")
    )
