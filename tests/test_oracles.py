"""Every query with SQL gives the SQL's result; every other one gives rows."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from ledgerlight.plans.catalog import ORACLES, QUERIES

# Model queries are covered on fixtures in test_models; here a few run end to end.
SLOW_ROWS_ONLY = {"best_method", "eval_log", "scored_results", "explain_contributions", "explain_global", "surrogate_fit",
                  "feature_catalogue", "forecast_seasonal_ar", "recent_anomalies", "anomaly_mart"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        if isinstance(v, (bool, int, float)):
            return repr(round(float(v), 6) + 0.0)
        return str(v)

    return [columns[i] for i in order], sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    res = duck.execute(ORACLES[name])
    columns = [c[0] for c in res.description]
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(res.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW_ROWS_ONLY))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "risk_score" in df.columns
