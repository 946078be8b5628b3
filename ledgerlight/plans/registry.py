"""Registered queries: the Spark job and, where SQL can state it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerlight.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6
# Means of whole cents often end in an exact half at the last digit, which two engines round differently.
OFF_HALVES = 1e-9


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a job; `doubles` names the result columns the SQL has to round as the job's result is rounded."""

    def register(job):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(job(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = round_sql(sql, doubles.split())
        return job

    return register


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            (F.round(F.col(f.name) + OFF_HALVES, DIGITS) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def round_sql(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    parts = ", ".join(f"round(CAST({c} AS DOUBLE) + {OFF_HALVES}, {DIGITS}) + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({parts}) FROM ({sql}) AS result"


def padded_sql(column: str, width: int) -> str:
    """Leading zeros to a least width, longer keys whole."""
    text = f"CAST({column} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INT), '0')"


# The canonical transactions in SQL.
TXN = f"""
txn AS (
  SELECT concat('txn_', {padded_sql('event_id', 8)}) AS transaction_id,
         concat('acc_', {padded_sql('user_id', 4)}) AS account_id,
         CAST(ts AS TIMESTAMP) AS timestamp,
         CASE WHEN event_type = 'signup' THEN round(-10 * value, 2) ELSE value END AS amount,
         concat('m_', CAST(k AS VARCHAR)) AS merchant_name,
         event_type AS merchant_category,
         CASE k % 4 WHEN 0 THEN 'pos' WHEN 1 THEN 'online' WHEN 2 THEN 'atm' ELSE 'mobile' END AS channel,
         n_name AS city,
         CASE WHEN value > 120 AND k % 3 = 0 THEN 1 ELSE 0 END AS is_fraud,
         c_acctbal AS opening_balance
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
  LEFT JOIN nation ON n_nationkey = k % 25
  LEFT JOIN customer ON c_custkey = user_id
)"""

BALANCED = (
    TXN
    + """,
bal AS (
  SELECT *, opening_balance - sum(amount) OVER (PARTITION BY account_id ORDER BY timestamp, transaction_id
                                                ROWS UNBOUNDED PRECEDING) AS balance
  FROM txn
)"""
)

DAILY = (
    TXN
    + """,
day_sums AS (
  SELECT account_id, CAST(timestamp AS DATE) AS ds, any_value(opening_balance) AS opening_balance,
         sum(amount) AS net_flow, count(*) AS txn_count,
         count(*) FILTER (WHERE amount > 0) AS debit_count, count(*) FILTER (WHERE amount < 0) AS credit_count
  FROM txn GROUP BY 1, 2
),
days AS (
  SELECT account_id, ds, opening_balance - sum(net_flow) OVER (PARTITION BY account_id ORDER BY ds) AS balance,
         net_flow, txn_count, debit_count, credit_count,
         CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN strftime(ds, '%Y-%m-%d') IN ('2023-01-01','2023-07-04','2023-12-25','2024-01-01','2024-07-04',
                                                '2024-12-25') THEN 1 ELSE 0 END AS is_holiday
  FROM day_sums
)"""
)

BY_TIME = "PARTITION BY account_id ORDER BY timestamp, transaction_id"


def trailing_sql(seconds: int) -> str:
    return (
        f"PARTITION BY account_id ORDER BY epoch_us(timestamp) "
        f"RANGE BETWEEN CAST({seconds * 1_000_000 - 1} AS BIGINT) PRECEDING AND CURRENT ROW"
    )


def mean_sql(value: str, window: str, dec: str = "DECIMAL(18, 4)") -> str:
    """Window mean from an exact sum, as the jobs take it."""
    return f"CAST(sum(CAST({value} AS {dec})) OVER {window} AS DOUBLE) / count(*) OVER {window}"
