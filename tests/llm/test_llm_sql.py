"""Queries of the llm folder that SQL can state give the SQL's result; the others give a row per document."""

import glob
import os

import duckdb
import pytest

from conftest import SMALL
from ledgerlight.llm.queries import ORACLES


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        return repr(round(float(v), 6) + 0.0) if isinstance(v, (bool, int, float)) else str(v)

    return [columns[i] for i in order], sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    import __spark_entry__ as entry

    duck = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, SMALL)
    found = duck.execute(entry.oracle_sql()[name])
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(found.fetchall(), [c[0] for c in found.description])
