"""Data quality, evaluation and aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import quality as dq
from ledgerlight.operators.cells import quantile
from ledgerlight.plans import profiles
from ledgerlight.plans.features import BASIC_SQL
from ledgerlight.plans.registry import BALANCED, BY_TIME, TXN, query
from ledgerlight.session import cut
from ledgerlight.sources import canonical as src

AS_OF = "2024-01-20 00:00:00"
SCORE = "abs(amount) / (abs(amount) + 200)"


def amount_score():
    """A simple score in [0, 1) that grows with the size of the amount."""
    return F.abs("amount") / (F.abs("amount") + 200)


def scored(spark, d):
    t = src.transactions(spark, d).withColumn("score", amount_score())
    return t.withColumn("predicted", (F.col("score") > 0.5).cast("int"))


def balanced(spark, d):
    return profiles.with_balance(src.transactions(spark, d), src.opening_balances(spark, d)).drop(
        "_us", "_cell", "account_row", "opening_balance"
    )


@query("dq_schema", f"""WITH {TXN}, n AS (SELECT count(*) AS rows_checked FROM txn)
SELECT check_name, true AS passed, rows_checked FROM n, (VALUES ('has_required_columns'), ('timestamp_is_datetime'), ('amount_is_numeric')) v(check_name)""")
def dq_schema(spark, d):
    return dq.schema_report(src.transactions(spark, d))


TXN_COLUMNS = [
    "transaction_id", "account_id", "timestamp", "amount", "merchant_name", "merchant_category", "channel", "is_fraud", "city",
]
MISSING_COLUMNS = [*TXN_COLUMNS, "debit_only"]


@query("dq_missing", f"""WITH {TXN}, m AS (SELECT *, CASE WHEN amount > 0 THEN amount END AS debit_only FROM txn)
SELECT column_name, missing_rate, CASE WHEN missing_rate > 0.1 THEN 1 ELSE 0 END AS too_high FROM (
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM m" for c in MISSING_COLUMNS)}) x""",
"missing_rate")
def dq_missing(spark, d):
    t = src.transactions(spark, d).withColumn("debit_only", F.when(F.col("amount") > 0, F.col("amount")))
    return dq.missing_rates(t.select(*MISSING_COLUMNS))


@query("duplicate_rate", f"""WITH {TXN}, p AS (SELECT {', '.join(TXN_COLUMNS)} FROM txn)
SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p) u) AS duplicate_rows,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p) u)) / count(*) AS duplicate_rate FROM p""", "duplicate_rate")
def duplicate_rate(spark, d):
    return dq.duplicate_rate(src.transactions(spark, d).select(*TXN_COLUMNS))


@query("repeated_descriptions", f"""WITH {TXN}, p AS (SELECT merchant_name, merchant_category, channel, city, is_fraud FROM txn)
SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p) u) AS duplicate_rows,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p) u)) / count(*) AS duplicate_rate FROM p""", "duplicate_rate")
def repeated_descriptions(spark, d):
    """Repeats over the descriptive columns (whole rows of the table never repeat)."""
    t = src.transactions(spark, d)
    return dq.duplicate_rate(t.select("merchant_name", "merchant_category", "channel", "city", "is_fraud"))


@query("dq_amount", f"""WITH {TXN} SELECT avg(CASE WHEN amount < -10000 OR amount > 10000 THEN 1.0 ELSE 0 END) AS amount_out_of_bounds_rate,
  avg(CASE WHEN amount = 0 THEN 1.0 ELSE 0 END) AS amount_zero_rate, avg(CASE WHEN amount < 0 THEN 1.0 ELSE 0 END) AS negative_amount_rate,
  avg(amount) AS amount_mean, stddev_samp(amount) AS amount_std FROM txn""",
"amount_out_of_bounds_rate amount_zero_rate negative_amount_rate amount_mean amount_std")
def dq_amount(spark, d):
    return dq.amount_quality(src.transactions(spark, d))


@query("dq_time", f"""WITH {TXN} SELECT avg(CASE WHEN timestamp > TIMESTAMP '{AS_OF}' THEN 1.0 ELSE 0 END) AS future_transactions_rate,
  avg(CASE WHEN timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 1095 DAY THEN 1.0 ELSE 0 END) AS very_old_transactions_rate FROM txn""",
"future_transactions_rate very_old_transactions_rate")
def dq_time(spark, d):
    return dq.time_quality(src.transactions(spark, d), AS_OF)


@query("dq_business", f"""WITH {BALANCED}, s AS (SELECT *, abs(balance - lag(balance) OVER ({BY_TIME}) + amount) AS gap FROM bal),
m AS (SELECT avg(is_fraud) AS fr, avg(CASE WHEN coalesce(gap, 0) < 1000 THEN 1.0 ELSE 0 END) AS cs,
  (SELECT avg(CASE WHEN n = 1 THEN 1.0 ELSE 0 END) FROM (SELECT count(*) AS n FROM txn GROUP BY account_id) a) AS ss FROM s)
SELECT 'fraud_rate_reasonable' AS check_name, fr AS measured, CASE WHEN fr BETWEEN 0.001 AND 0.1 THEN 1 ELSE 0 END AS passed FROM m
UNION ALL SELECT 'reasonable_account_activity', ss, CASE WHEN ss < 0.5 THEN 1 ELSE 0 END FROM m
UNION ALL SELECT 'balance_consistency', cs, CASE WHEN cs > 0.8 THEN 1 ELSE 0 END FROM m""", "measured")
def dq_business(spark, d):
    return dq.business_report(balanced(spark, d))


@query("dq_keys", f"""WITH {TXN} SELECT 'transaction_id_repeated' AS check_name, count(*) AS violations FROM (SELECT transaction_id FROM txn GROUP BY 1 HAVING count(*) > 1) x
{' '.join(f"UNION ALL SELECT '{c}_null', count(*) FROM txn WHERE {c} IS NULL" for c in ('transaction_id', 'account_id', 'timestamp', 'amount'))}""")
def dq_keys(spark, d):
    return dq.key_quality(src.transactions(spark, d))


@query("dq_report", f"""WITH {BALANCED}, s AS (SELECT *, abs(balance - lag(balance) OVER ({BY_TIME}) + amount) AS gap FROM bal),
m AS (SELECT avg(is_fraud) AS fr, avg(CASE WHEN coalesce(gap, 0) < 1000 THEN 1.0 ELSE 0 END) AS cs,
  (SELECT avg(CASE WHEN n = 1 THEN 1.0 ELSE 0 END) FROM (SELECT count(*) AS n FROM txn GROUP BY account_id) a) AS ss,
  1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM bal) u) / count(*) AS dup, avg(CASE WHEN transaction_id IS NULL THEN 1.0 ELSE 0 END) AS ids FROM s),
c AS (SELECT unnest([
  {{'check_name': 'has_required_columns', 'passed': 1}}, {{'check_name': 'timestamp_is_datetime', 'passed': 1}}, {{'check_name': 'amount_is_numeric', 'passed': 1}},
  {{'check_name': 'fraud_rate_reasonable', 'passed': CASE WHEN fr BETWEEN 0.001 AND 0.1 THEN 1 ELSE 0 END}},
  {{'check_name': 'reasonable_account_activity', 'passed': CASE WHEN ss < 0.5 THEN 1 ELSE 0 END}},
  {{'check_name': 'balance_consistency', 'passed': CASE WHEN cs > 0.8 THEN 1 ELSE 0 END}},
  {{'check_name': 'duplicate_rate', 'passed': CASE WHEN dup < 0.05 THEN 1 ELSE 0 END}},
  {{'check_name': 'transaction_id_missing_rate', 'passed': CASE WHEN ids < 0.01 THEN 1 ELSE 0 END}}], recursive := true) FROM m)
SELECT check_name, passed FROM c UNION ALL SELECT 'ready', min(passed) FROM c""")
def dq_report(spark, d):
    return dq.quality_report(balanced(spark, d))


GAPS_SQL = """SELECT (max(epoch_us(timestamp)) - min(epoch_us(timestamp))) / ((count(*) - 1) * 3.6e9) AS avg_time_gap_hours,
  max(gap) / 3.6e9 AS max_time_gap_hours FROM (SELECT timestamp, epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (ORDER BY timestamp) AS gap FROM txn) g"""


@query("time_gaps", f"WITH {TXN} {GAPS_SQL}", "avg_time_gap_hours max_time_gap_hours")
def time_gaps(spark, d):
    return dq.time_gaps(src.transactions(spark, d))


INGEST_COLUMNS = TXN_COLUMNS


@query("dq_ingest_metrics", f"""WITH {TXN}, g AS ({GAPS_SQL})
{' UNION ALL '.join(f"SELECT '{c}_missing_rate' AS metric, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS value FROM txn" for c in INGEST_COLUMNS)}
UNION ALL SELECT 'duplicate_rate', 1 - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(INGEST_COLUMNS)} FROM txn) u) / count(*) FROM txn
UNION ALL SELECT 'avg_time_gap_hours', avg_time_gap_hours FROM g UNION ALL SELECT 'max_time_gap_hours', max_time_gap_hours FROM g
UNION ALL SELECT 'amount_mean', avg(amount) FROM txn UNION ALL SELECT 'amount_std', stddev_samp(amount) FROM txn
UNION ALL SELECT 'negative_amount_rate', avg(CASE WHEN amount < 0 THEN 1.0 ELSE 0 END) FROM txn""", "value")
def dq_ingest_metrics(spark, d):
    return dq.ingest_metrics(src.transactions(spark, d).select(*INGEST_COLUMNS))


# --- aggregates ----------------------------------------------------------------------------------------------


@query("amount_p95", f"WITH {TXN} SELECT quantile_cont(abs(amount), 0.95) AS p95, quantile_cont(amount, 0.5) AS median FROM txn", "p95 median")
def amount_p95(spark, d):
    t = src.transactions(spark, d)
    median = quantile(t, "amount", 0.5)
    return quantile(t.select(F.abs("amount").alias("size")), "size", 0.95, "p95").withColumn("median", median.scalar())


@query("score_histogram", f"""WITH {TXN}, s AS (SELECT {SCORE} AS score FROM txn), e AS (SELECT min(score) AS lo, max(score) AS hi FROM s)
SELECT CAST(least(floor((score - lo) / (hi - lo) * 50) + 1, 50) AS INT) AS bin, count(*) AS n FROM s CROSS JOIN e GROUP BY 1""")
def score_histogram(spark, d):
    return ev.histogram(scored(spark, d), "score")


# The numeric columns of the basic feature store.
STORE_NUMBERS = [c for c in profiles.BASIC_COLUMNS if c not in ("transaction_id", "account_id", "timestamp")]
STORE_SQL = BASIC_SQL.replace("WITH ", "WITH store AS MATERIALIZED (WITH ", 1) + ")"


def store(spark, d):
    """The basic feature store, written once."""
    return cut(profiles.basic(src.transactions(spark, d)), "store")


@query("feature_summary", f"""{STORE_SQL}
{' UNION ALL '.join(f"SELECT '{c}' AS feature, count({c}) AS n_rows, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min_value, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c}) AS max_value FROM store" for c in STORE_NUMBERS)}""",
"mean std min_value q25 q50 q75 max_value")
def feature_summary(spark, d):
    t = store(spark, d)
    return dq.summary(t, profiles.numeric_columns(t, []))


@query("class_weights", f"WITH {TXN}, c AS (SELECT is_fraud, count(*) AS class_rows FROM txn GROUP BY 1) SELECT is_fraud, class_rows, (SELECT sum(class_rows) / count(*) FROM c) / class_rows AS weight FROM c", "weight")
def class_weights(spark, d):
    return ev.class_weights(src.transactions(spark, d), "is_fraud")


# --- evaluation ----------------------------------------------------------------------------------------------

CONFUSION_SQL = f"""s AS (SELECT is_fraud AS y, {SCORE} AS score, CASE WHEN {SCORE} > 0.5 THEN 1 ELSE 0 END AS p FROM txn),
c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM s),
m AS (SELECT coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (tp + fp) / (tp + fp + tn + fn) AS alert_rate, (tp + fn) / (tp + fp + tn + fn) AS fraud_rate FROM c)"""


@query("confusion", f"WITH {TXN}, {CONFUSION_SQL} SELECT * FROM c")
def confusion(spark, d):
    return ev.confusion(scored(spark, d), "is_fraud", "predicted")


@query("prf", f"WITH {TXN}, {CONFUSION_SQL} SELECT * FROM m", "precision recall f1 alert_rate fraud_rate")
def prf(spark, d):
    return ev.precision_recall(scored(spark, d), "is_fraud", "predicted")


@query("roc_auc", f"""WITH {TXN}, {CONFUSION_SQL}, r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s)
SELECT (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
  / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)) AS auc FROM r""", "auc")
def roc_auc(spark, d):
    return ev.roc_auc(scored(spark, d), "is_fraud", "score")


@query("status_band", f"""WITH {TXN}, {CONFUSION_SQL} SELECT CASE WHEN precision >= 0.85 AND recall >= 0.70 THEN 'excellent' WHEN f1 >= 0.60 THEN 'good'
  ELSE 'needs improvement' END AS status, CASE WHEN precision < 0.85 THEN 1 ELSE 0 END AS improve_precision,
  CASE WHEN recall < 0.70 THEN 1 ELSE 0 END AS improve_recall FROM m""")
def status_band(spark, d):
    return ev.status_band(ev.precision_recall(scored(spark, d), "is_fraud", "predicted"))
