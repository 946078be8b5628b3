"""Forecast, mart and alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.operators import alerts as al
from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import forecast as fc
from ledgerlight.operators import marts
from ledgerlight.plans import features as ft
from ledgerlight.plans import profiles
from ledgerlight.plans.registry import DAILY, TXN, query
from ledgerlight.session import cut
from ledgerlight.sources import canonical as src

AS_OF = "2024-01-25"


def text_date(df, column):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


def days(spark, d):
    t = src.transactions(spark, d)
    return fc.daily_series(t, src.opening_balances(spark, d), src.calendar_of(t))


DS = "strftime(ds, '%Y-%m-%d') AS ds"


@query("daily_series", f"WITH {DAILY} SELECT * REPLACE ({DS}) FROM days", "balance net_flow")
def daily_series(spark, d):
    return text_date(days(spark, d), "ds")


@query("daily_series_filled", f"""WITH {DAILY}, spine AS (SELECT account_id, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM days GROUP BY 1)
SELECT account_id, {DS}, last_value(balance IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY ds) AS balance,
  coalesce(net_flow, 0) AS net_flow, coalesce(txn_count, 0) AS txn_count, coalesce(debit_count, 0) AS debit_count,
  coalesce(credit_count, 0) AS credit_count, coalesce(is_weekend, 0) AS is_weekend, coalesce(is_holiday, 0) AS is_holiday
FROM spine LEFT JOIN days USING (account_id, ds)""", "balance net_flow")
def daily_series_filled(spark, d):
    return text_date(fc.filled_series(days(spark, d)), "ds")


@query("moving_avg_balance", f"""WITH {DAILY} SELECT account_id, {DS}, avg(balance) OVER (PARTITION BY account_id ORDER BY ds ROWS 6 PRECEDING) AS ma_7,
  avg(balance) OVER (PARTITION BY account_id ORDER BY ds ROWS 29 PRECEDING) AS ma_30 FROM days""", "ma_7 ma_30")
def moving_avg_balance(spark, d):
    return text_date(fc.moving_averages(days(spark, d)), "ds").select("account_id", "ds", "ma_7", "ma_30")


def trend_sql(source: str, txns: int, min_days: int) -> str:
    return f"""back AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY ds DESC) AS back FROM {source}),
fit AS (SELECT account_id, max(ds) AS last, max_by(balance, ds) AS cur, sum(txn_count) AS txns, count(*) AS n,
  regr_slope(balance, -back) FILTER (WHERE back <= 30) AS slope FROM back GROUP BY 1),
ahead AS (SELECT *, last + CAST(i AS INT) AS date FROM fit CROSS JOIN (SELECT unnest(generate_series(1, 30)) AS i) g WHERE txns >= {txns} AND n >= {min_days}),
val AS (SELECT *, cur + coalesce(CASE WHEN isnan(slope) THEN 0 ELSE slope END, 0) * i + CASE WHEN isodow(date) >= 6 THEN 0 ELSE -20 END AS forecast FROM ahead),
fcast AS (SELECT account_id, date, forecast, forecast - abs(forecast) * 0.1 AS lower_bound, forecast + abs(forecast) * 0.1 AS upper_bound,
  'simple_trend' AS model_type, CASE WHEN forecast < 0 THEN 1 ELSE 0 END AS overdraft_risk, CASE WHEN forecast < 100 THEN 1 ELSE 0 END AS low_balance_risk FROM val)"""


TREND_SQL = trend_sql("days", 30, 15)
BANDS = "forecast lower_bound upper_bound"
DATE = "strftime(date, '%Y-%m-%d') AS date"


@query("forecast_trend", f"WITH {DAILY}, {TREND_SQL} SELECT * REPLACE ({DATE}) FROM fcast", BANDS)
def forecast_trend(spark, d):
    return text_date(fc.trend_forecast(days(spark, d)), "date")


@query("forecast_additive")
def forecast_additive(spark, d):
    return text_date(fc.additive_forecast(fc.filled_series(days(spark, d)), min_days=25), "date")


@query("forecast_seasonal_ar")
def forecast_seasonal_ar(spark, d):
    """On the order history, which is long enough for the model."""
    o = src.order_history(spark, d)
    nothing = o.select("account_id").distinct().withColumn("opening_balance", F.lit(0.0))
    return text_date(fc.seasonal_ar_forecast(fc.filled_series(fc.daily_series(o, nothing), packed=True)), "date")


RISK_SQL = f"""first AS (SELECT account_id, min(date) FILTER (WHERE forecast < 0) AS first FROM fcast GROUP BY 1)"""


@query("overdraft_risk", f"""WITH {DAILY}, {TREND_SQL}, {RISK_SQL} SELECT account_id, {DATE}, overdraft_risk, CASE WHEN upper_bound < 0 THEN 1 ELSE 0 END AS high_overdraft_risk,
  CASE WHEN first IS NOT NULL THEN greatest(0, CAST(first - DATE '{AS_OF}' AS INT)) END AS days_to_overdraft FROM fcast JOIN first USING (account_id)""")
def overdraft_risk(spark, d):
    out = fc.overdraft_risk(fc.trend_forecast(days(spark, d)), AS_OF)
    return text_date(out, "date").select("account_id", "date", "overdraft_risk", "high_overdraft_risk", "days_to_overdraft")


@query("overdraft_alerts", f"""WITH {DAILY}, {TREND_SQL}, breach AS (SELECT account_id, date, forecast, row_number() OVER (PARTITION BY account_id ORDER BY date) AS r FROM fcast WHERE forecast < 0)
SELECT account_id, {DATE}, CAST(greatest(0, CAST(date - DATE '{AS_OF}' AS INT)) AS INT) AS days_to_overdraft, forecast FROM breach WHERE r = 1 AND greatest(0, CAST(breach.date - DATE '{AS_OF}' AS INT)) <= 7""", "forecast")
def overdraft_alerts(spark, d):
    return text_date(fc.overdraft_alerts(fc.trend_forecast(days(spark, d)), AS_OF), "date")


@query("forecast_all")
def forecast_all(spark, d):
    """Forecasts of all three models; the series is 30 days long, so the additive one is asked for 25."""
    kinds = {"simple_trend": {}, "additive": {"min_days": 25}, "seasonal_ar": {}}
    return text_date(fc.all_forecasts(days(spark, d), kinds), "date")


@query("forecast_summary", f"""WITH {DAILY}, {TREND_SQL} SELECT count(*) AS total_forecasts, count(DISTINCT account_id) AS unique_accounts, avg(forecast) AS avg_forecast_value,
  count(DISTINCT CASE WHEN overdraft_risk = 1 THEN account_id END) AS overdraft_risk_accounts, count(DISTINCT date) AS forecast_horizon_days,
  avg(upper_bound - lower_bound) AS avg_forecast_spread FROM fcast""", "avg_forecast_value avg_forecast_spread")
def forecast_summary(spark, d):
    return ev.forecast_summary(fc.trend_forecast(days(spark, d)))


@query("forecast_accuracy", f"""WITH {DAILY}, past AS (SELECT * FROM days WHERE ds <= DATE '2024-01-20'), {trend_sql('past', 1, 2)},
pairs AS (SELECT balance AS a, forecast AS p FROM fcast JOIN days ON days.account_id = fcast.account_id AND days.ds = fcast.date WHERE ds > DATE '2024-01-20')
SELECT avg(abs(a - p)) AS mae, avg(abs((a - p) / (a + 1e-6))) * 100 AS mape, sqrt(avg((a - p) * (a - p))) AS rmse, avg(a) AS mean_actual, avg(p) AS mean_predicted FROM pairs""",
"mae mape rmse mean_actual mean_predicted")
def forecast_accuracy(spark, d):
    return ev.forecast_accuracy(fc.backtest_pairs(days(spark, d), "2024-01-20"))


# --- marts ---------------------------------------------------------------------------------------------------


@query("mart_overview", f"WITH {TXN} SELECT count(*) AS total_transactions, avg(is_fraud) AS fraud_rate, count(DISTINCT account_id) AS active_accounts, avg(amount) AS avg_amount FROM txn", "fraud_rate avg_amount")
def mart_overview(spark, d):
    return marts.overview(src.transactions(spark, d))


@query("mart_daily", f"WITH {TXN} SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS transaction_count, sum(amount) AS total_amount, CAST(sum(is_fraud) AS BIGINT) AS fraud_count FROM txn GROUP BY 1", "total_amount")
def mart_daily(spark, d):
    return text_date(marts.daily(src.transactions(spark, d)), "date")


@query("mart_category", f"""WITH {TXN} SELECT merchant_category, count(*) AS txn_count, round(sum(amount), 2) AS total_amount, round(avg(amount), 2) AS avg_amount FROM txn GROUP BY 1""", "total_amount avg_amount")
def mart_category(spark, d):
    return marts.category(src.transactions(spark, d))


@query("ingest_summary", f"""WITH {TXN} SELECT count(*) AS row_count, avg(is_fraud) AS fraud_rate, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS last_seen, count(DISTINCT account_id) AS accounts FROM txn""", "fraud_rate")
def ingest_summary(spark, d):
    out = marts.ingest_summary(src.transactions(spark, d))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_seen", "last_seen")})


@query("top_accounts", f"WITH {TXN} SELECT account_id, count(*) AS txn_count FROM txn GROUP BY 1 HAVING count(*) >= 30 ORDER BY 2 DESC, 1 LIMIT 10")
def top_accounts(spark, d):
    return marts.top_accounts(src.transactions(spark, d))


@query("account_card", f"""WITH {DAILY}, {TREND_SQL}, {RISK_SQL}, ahead2 AS (SELECT account_id, min(forecast) AS min_forecast, max(overdraft_risk) AS overdraft_risk FROM fcast GROUP BY 1),
now AS (SELECT account_id, max_by(balance, ds) AS current_balance FROM days GROUP BY 1)
SELECT account_id, current_balance, min_forecast, overdraft_risk, CASE WHEN first IS NOT NULL THEN greatest(0, CAST(first - DATE '{AS_OF}' AS INT)) END AS days_to_overdraft
FROM ahead2 JOIN now USING (account_id) JOIN first USING (account_id)""", "current_balance min_forecast")
def account_card(spark, d):
    ds = days(spark, d)
    return marts.account_card(ds, fc.trend_forecast(ds), AS_OF)


@query("balance_timeline", f"""WITH {DAILY}, {TREND_SQL} SELECT account_id, strftime(ds, '%Y-%m-%d') AS date, 'actual' AS kind, balance AS value, NULL AS lower_bound, NULL AS upper_bound
  FROM days WHERE account_id = 'acc_0003' UNION ALL SELECT account_id, strftime(date, '%Y-%m-%d'), 'forecast', forecast, lower_bound, upper_bound FROM fcast WHERE account_id = 'acc_0003'""",
"value lower_bound upper_bound")
def balance_timeline(spark, d):
    ds = days(spark, d).filter(F.col("account_id") == "acc_0003")
    return text_date(marts.balance_timeline(ds, fc.trend_forecast(ds)), "date")


# --- alerts --------------------------------------------------------------------------------------------------

TIERS_SQL = f"""{ft.RISK_SQL}, tier AS (SELECT *, risk_score AS score, CASE WHEN risk_score >= 0.8 THEN 'high' WHEN risk_score >= 0.6 THEN 'medium' ELSE 'low' END AS priority,
  CASE WHEN risk_score < 0.3 THEN 'closed' ELSE 'open' END AS status FROM risk)"""


def risky(spark, d):
    """Transactions with the composite risk score, which the alert policy is stated in."""
    return profiles.with_risk(src.transactions(spark, d)).withColumn("score", F.col("risk_score"))


@query("alert_priority", f"WITH {TXN}, {TIERS_SQL} SELECT transaction_id, score, priority, status FROM tier", "score")
def alert_priority(spark, d):
    return al.with_tiers(risky(spark, d), "score").select("transaction_id", "score", "priority", "status")


QUEUE_SQL = f"""queue AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY timestamp, transaction_id) AS alert_id FROM tier WHERE is_fraud = 1) n
  WHERE status IN ('open', 'investigating') AND priority IN ('high', 'medium'))"""


@query("alert_queue", f"WITH {TXN}, {TIERS_SQL}, {QUEUE_SQL} SELECT alert_id, transaction_id, account_id, amount, merchant_name, priority, status FROM queue", "amount")
def alert_queue(spark, d):
    queue = al.alert_queue(risky(spark, d), "score", priorities=("high", "medium"))
    return queue.select("alert_id", "transaction_id", "account_id", "amount", "merchant_name", "priority", "status")


@query("alert_summary", f"""WITH {TXN}, {TIERS_SQL}, {QUEUE_SQL} SELECT count(*) FILTER (WHERE status = 'open') AS open_alerts, count(*) FILTER (WHERE status = 'investigating') AS investigating,
  count(*) FILTER (WHERE priority = 'high') AS high_priority, avg(amount) AS avg_amount FROM queue""", "avg_amount")
def alert_summary(spark, d):
    return al.queue_summary(al.alert_queue(risky(spark, d), "score", priorities=("high", "medium")))


@query("alert_daily_cap", f"""WITH {TXN}, {TIERS_SQL} SELECT transaction_id, score, CAST(day_rank AS INT) AS day_rank FROM (SELECT *, row_number() OVER (PARTITION BY CAST(timestamp AS DATE)
  ORDER BY score DESC, transaction_id) AS day_rank FROM tier) r WHERE day_rank <= 100""", "score")
def alert_daily_cap(spark, d):
    return al.daily_cap(risky(spark, d), "score").select("transaction_id", "score", "day_rank")


@query("alert_cooldown", f"""WITH RECURSIVE {TXN}, fraud AS (SELECT transaction_id, account_id, epoch_us(timestamp) AS us FROM txn WHERE is_fraud = 1),
chain AS (SELECT account_id, min(us) AS us FROM fraud GROUP BY 1
  UNION ALL SELECT c.account_id, (SELECT min(f.us) FROM fraud f WHERE f.account_id = c.account_id AND f.us >= c.us + 86400000000) FROM chain c
  WHERE EXISTS (SELECT 1 FROM fraud f WHERE f.account_id = c.account_id AND f.us >= c.us + 86400000000))
SELECT transaction_id, account_id FROM fraud JOIN chain USING (account_id, us)""")
def alert_cooldown(spark, d):
    fraud = src.transactions(spark, d).filter(F.col("is_fraud") == 1)
    return al.cooldown(cut(fraud)).select("transaction_id", "account_id")
