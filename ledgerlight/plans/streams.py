"""Streaming queries; each runs the available rows to the end and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.functions import scalar as fn
from ledgerlight.ml import supervised as sup
from ledgerlight.plans.features import RISK_SQL
from ledgerlight.plans.registry import TXN, query
from ledgerlight.sources import canonical as src
from ledgerlight.streaming import streams as st

TEXT = "yyyy-MM-dd HH:mm:ss"
WINDOW_KEYS = ["account_id", "window_start"]


def _text_window(df):
    return df.withColumn("window_start", F.date_format("window_start", TEXT))


@query("stream_hourly_counts", f"""WITH {TXN} SELECT account_id, strftime(date_trunc('hour', timestamp), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS txn_count
  FROM txn GROUP BY 1, 2""")
def stream_hourly_counts(spark, d):
    return _text_window(st.run_update(st.hourly_counts(st.transaction_stream(spark, d)), "hourly", WINDOW_KEYS, whole=True))


@query("stream_velocity", f"""WITH {TXN} SELECT account_id, strftime(date_trunc('hour', timestamp) - CAST(i AS INT) * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_start,
  count(*) AS txn_count FROM txn CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS i) g GROUP BY 1, 2""")
def stream_velocity(spark, d):
    hours = st.run_update(st.hourly_counts(st.transaction_stream(spark, d)), "velocity", WINDOW_KEYS, whole=True)
    return _text_window(st.sliding_velocity(hours))


@query("stream_rapid_fire", f"WITH {TXN}, {RISK_SQL} SELECT transaction_id, rapid_fire FROM flags")
def stream_rapid_fire(spark, d):
    flagged = st.rapid_fire(st.transaction_stream(spark, d, to_the_end=True))
    return st.run_append(flagged, "rapid", whole=True)


@query("stream_cooldown", f"""WITH RECURSIVE {TXN}, fraud AS (SELECT transaction_id, account_id, epoch_us(timestamp) AS us FROM txn WHERE is_fraud = 1),
chain AS (SELECT account_id, min(us) AS us FROM fraud GROUP BY 1
  UNION ALL SELECT c.account_id, (SELECT min(f.us) FROM fraud f WHERE f.account_id = c.account_id AND f.us >= c.us + 86400000000) FROM chain c
  WHERE EXISTS (SELECT 1 FROM fraud f WHERE f.account_id = c.account_id AND f.us >= c.us + 86400000000))
SELECT transaction_id, account_id FROM fraud JOIN chain USING (account_id, us)""")
def stream_cooldown(spark, d):
    fraud = st.transaction_stream(spark, d).filter(F.col("is_fraud") == 1)
    return st.cooldown(fraud, whole=True)


@query("stream_dedup", f"WITH {TXN} SELECT transaction_id, account_id, amount FROM txn", "amount")
def stream_dedup(spark, d):
    """Every event delivered twice, kept once."""
    once = st.transaction_stream(spark, d)
    twice = once.union(once)
    return st.run_append(st.deduplicated(twice), "dedup", whole=True).select("transaction_id", "account_id", "amount")


STATELESS = ["amount_abs", "amount_log", "is_debit", "hour_of_day", "day_of_week", "is_weekend", "is_night"]


def stateless_features(df):
    return fn.time_features(fn.amount_features(df))


@query("stream_score")
def stream_score(spark, d):
    """Model fitted on the stored rows, applied to the stream."""
    known = stateless_features(src.transactions(spark, d))
    model = sup.fit_random_forest(known, STATELESS)
    live = stateless_features(st.transaction_stream(spark, d)).select("transaction_id", "is_fraud", *STATELESS)
    return st.run_append(st.score(live, model), "scores").select("transaction_id", "is_fraud", "score")
