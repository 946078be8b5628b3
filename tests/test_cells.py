"""Two-level windows against hand-made values and against plain SQL windows on skewed data."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from ledgerlight.functions.scalar import money, units
from ledgerlight.operators import account as acc
from ledgerlight.operators import alerts
from ledgerlight.operators import velocity as vel
from ledgerlight.operators.cells import (
    DAY,
    Measure,
    percentile_rank,
    number_rows,
    over_neighbours,
    quantile,
    rank_average,
    ranged,
    running,
    trailing,
    with_time_cell,
)
from ledgerlight.operators.diversity import FULL_PROFILE, Diversity, rolling_diversity, visits

WEEK = "RANGE BETWEEN CAST(604799999999 AS BIGINT) PRECEDING AND CURRENT ROW"


def close(a, b):
    assert len(a) == len(b)
    for key, values in a.items():
        assert values == pytest.approx(b[key], abs=1e-6, nan_ok=True), key


def by_id(df):
    return {r[0]: tuple(float("nan") if v is None else v for v in r[1:]) for r in df.collect()}


def by_sql(frame, sql):
    txn = frame  # noqa: F841  found by DuckDB
    return {r[0]: tuple(float("nan") if v is None else v for v in r[1:]) for r in duckdb.sql(sql).fetchall()}


def test_ties_and_open_left_end(txns):
    t = with_time_cell(
        txns(
            [
                ("a", "x", "2024-01-01 10:00:00", 1.0),
                ("b", "x", "2024-01-01 10:00:00", 2.0),
                ("c", "x", "2024-01-08 10:00:00", 4.0),
                ("d", "x", "2024-01-09 22:00:00", 8.0),
            ]
        )
    )
    out = trailing(t, ["account_id"], {"7d": 7 * DAY}, [Measure("n", F.lit(1))])
    assert {r["transaction_id"]: r["n_7d"] for r in out.collect()} == {"a": 2, "b": 2, "c": 1, "d": 2}


def test_rows_before(txns):
    rows = [(str(i), "x", f"2024-01-01 0{i}:00:00", float(i)) for i in (1, 2, 3, 4)]
    t = with_time_cell(txns(rows))
    t = vel.with_recent(vel.with_account_amounts(number_rows(t, ["account_id"]), t))
    out = by_id(vel.row_window_features(t).select("transaction_id", "amount_mean_last_5", "amount_std_last_5", "amount_max_last_5"))
    close(out, {"1": (2.5, 0, 2.5), "2": (1, 0, 1), "3": (1.5, 0.707107, 2), "4": (2, 1, 3)})


def test_percentile_rank_averages_ties(txns):
    t = txns([("a", "x", "2024-01-01", 1.0), ("b", "x", "2024-01-02", 1.0), ("c", "x", "2024-01-03", 2.0)])
    out = by_id(percentile_rank(t, "account_id", "amount", "p").select("transaction_id", "p"))
    close(out, {"a": (0.5,), "b": (0.5,), "c": (1.0,)})


def test_entropy(txns):
    rows = [
        ("a", "x", "2024-01-01", 1.0, "p"),
        ("b", "x", "2024-01-02", 1.0, "q"),
        ("c", "x", "2024-02-01", 1.0, "p"),
        ("d", "x", "2024-02-02", 1.0, None),
    ]
    t = with_time_cell(txns(rows, ("transaction_id", "account_id", "timestamp", "amount", "cat")))
    out = by_id(rolling_diversity(t, [Diversity("n", "cat", 7, "h")]).select("transaction_id", "n", "h"))
    close(out, {"a": (1, 0), "b": (2, 1), "c": (1, 0), "d": (1, 0)})


def test_distinct_where_uses_are_just_a_span_apart(txns):
    week, second = 7 * DAY, 1
    starts = [0, week, 2 * week - second, 3 * week - second, 3 * week, 3 * week, 4 * week + second]
    rows = [(f"a{i}", "x", str(pd.Timestamp("2024-01-01 00:59:59") + pd.Timedelta(seconds=s)), 1.0, "p", "q" if i % 2 else None) for i, s in enumerate(starts)]
    rows += [(f"b{i}", "x", str(pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)), 1.0, "r", None) for i, s in enumerate([0, 3600, 2 * week + 3599, 2 * week + 3600])]
    t = with_time_cell(txns(rows, ("transaction_id", "account_id", "timestamp", "amount", "cat", "other")))
    specs = [Diversity(f"{c}{d}", c, d) for c in ("cat", "other") for d in (1, 7, 14)]
    got = by_id(rolling_diversity(t, specs).select("transaction_id", *[s.name for s in specs]))
    times = {r[0]: (pd.Timestamp(r[2]), r[4], r[5]) for r in rows}
    for i, (at, *_) in times.items():
        want = tuple(len({v[1 + k] for v in times.values() if v[1 + k] and at - pd.Timedelta(days=d) < v[0] <= at}) for k in (0, 1) for d in (1, 7, 14))
        assert got[i] == want, i


def test_few_uses_make_a_visit(skewed):
    t, frame = skewed
    changes = visits(with_time_cell(t), "account_id", [Diversity("c", "merchant_category", 30)])
    groups = frame.groupby(["account_id", "merchant_category"]).ngroups
    assert changes.count() < 0.3 * len(frame) and changes.where("_step = 1").count() >= groups
    assert changes.agg(F.sum("_step")).first()[0] == 0


def test_ranges_never_fall(spark):
    xs = [-1e12, -5.0, -0.1, 0.0, 1e-9, 0.1, 0.100001, 3.0, 1e12]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    cells = [r[0] for r in ranged(df, ["x"]).orderBy("i").select("_cell").collect()]
    assert cells == sorted(cells)


def test_ranges_share_out_values_that_lie_close_together(spark):
    n, parts = 200_000, 40
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # All in [0.5, 0.500001), a third of them under one key.
        df = spark.range(n).select((0.5 + F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1e12).alias("x"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
        sizes = [r["count"] for r in ranged(df.distinct(), ["k", "x"]).groupBy("_cell").count().collect()]
        assert len(sizes) == parts and max(sizes) < 3 * n / parts
        ranks = {(r["k"], r["x"]): (r["_below"], r["_equal"], r["_rows"]) for r in rank_average(df, ["k"], "x").collect()}
        half = quantile(df, "x", 0.37).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    frame = df.toPandas()
    assert half == pytest.approx(frame["x"].quantile(0.37), abs=1e-15)
    grouped = frame.groupby("k")["x"]
    frame["below"], frame["equal"] = grouped.rank(method="min") - 1, frame.groupby(["k", "x"])["x"].transform("size")
    frame["rows"] = grouped.transform("size")
    want = {(k, x): (b, e, m) for k, x, b, e, m in frame[["k", "x", "below", "equal", "rows"]].itertuples(index=False)}
    assert ranks == want


def test_ranks_and_quantiles_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0), ("a", 1.0), ("b", None)], "k string, x double")
    ranks = {r["x"]: (r["_below"], r["_rows"]) for r in rank_average(df, ["k"], "x").collect()}
    assert ranks == {1.0: (0, 2), 2.0: (1, 2)}
    assert [tuple(r) for r in quantile(df.where("k = 'b'"), "x", 0.5).collect()] == [(None,)]


@pytest.mark.parametrize("seconds", [3600, DAY])
def test_trailing_on_a_hot_account(skewed, seconds):
    t, frame = skewed
    t = with_time_cell(t, seconds=seconds)
    m = [Measure("n", F.lit(1)), Measure("s", units("amount")), Measure("top", F.col("amount"), "max")]
    out = trailing(t, ["account_id"], {"1d": DAY, "7d": 7 * DAY}, m, seconds=seconds)
    got = by_id(out.select("transaction_id", "n_7d", money(F.col("s_7d")), "top_7d", "n_1d"))
    close(got, by_sql(frame, f"""SELECT transaction_id, count(*) OVER w, sum(amount) OVER w, max(amount) OVER w, count(*) OVER d FROM txn
      WINDOW w AS (PARTITION BY account_id ORDER BY epoch_us(timestamp) {WEEK}),
      d AS (PARTITION BY account_id ORDER BY epoch_us(timestamp) RANGE BETWEEN CAST(86399999999 AS BIGINT) PRECEDING AND CURRENT ROW)"""))


@pytest.mark.parametrize("rows", [10, 100_000])
def test_running_and_neighbours_on_a_hot_account(skewed, rows):
    t, frame = skewed
    t = with_time_cell(t)
    out = running(t, ["account_id"], [Measure("s", units("amount")), Measure("top", F.col("amount"), "max")])
    out = number_rows(out, ["account_id"], source=t)
    columns = {
        "before": lambda w: F.lag("amount").over(w),
        "mean": lambda w: F.avg("amount").over(w.rowsBetween(-3, -1)),
        "std": lambda w: F.stddev_samp("amount").over(w.rowsBetween(-3, -1)),
    }
    out = over_neighbours(out, ["account_id"], 3, columns, rows=rows)
    got = by_id(out.select("transaction_id", money(F.col("s")), "top", "before", "mean", "std", "account_row"))
    close(got, by_sql(frame, """SELECT transaction_id, sum(amount) OVER w, max(amount) OVER w, lag(amount) OVER w,
      avg(amount) OVER (w3 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), stddev_samp(amount) OVER (w3 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), row_number() OVER w
      FROM txn WINDOW w AS (PARTITION BY account_id ORDER BY timestamp, transaction_id ROWS UNBOUNDED PRECEDING),
      w3 AS (PARTITION BY account_id ORDER BY timestamp, transaction_id)"""))


def test_diversity_on_a_hot_account(skewed):
    t, frame = skewed
    specs = [Diversity("m", "merchant_name", 7), Diversity("c", "merchant_category", 1, "h")]
    got = by_id(rolling_diversity(with_time_cell(t), specs).select("transaction_id", "m", "c"))
    close(got, by_sql(frame, f"""SELECT transaction_id, count(DISTINCT merchant_name) OVER (PARTITION BY account_id ORDER BY epoch_us(timestamp) {WEEK}),
      count(DISTINCT merchant_category) OVER (PARTITION BY account_id ORDER BY epoch_us(timestamp) RANGE BETWEEN CAST(86399999999 AS BIGINT) PRECEDING AND CURRENT ROW)
      FROM txn"""))


def test_balance_trend_on_a_hot_account(spark, skewed):
    t, frame = skewed
    opening = t.select("account_id").distinct().withColumn("opening_balance", F.lit(1000.0))
    b = acc.running_balance(with_time_cell(t), opening)
    got = by_id(acc.balance_trend(b).select("transaction_id", "balance", "balance_trend_7d"))
    # Row numbers of rows at one instant follow the id; the slope covers all rows of the instant.
    close(got, by_sql(frame, f"""WITH b AS (SELECT *, 1000 - sum(amount) OVER w AS balance, row_number() OVER w AS rn FROM txn
        WINDOW w AS (PARTITION BY account_id ORDER BY timestamp, transaction_id ROWS UNBOUNDED PRECEDING))
      SELECT transaction_id, balance, CASE WHEN count(*) OVER v > 1 THEN regr_slope(balance, rn) OVER v ELSE 0 END FROM b
      WINDOW v AS (PARTITION BY account_id ORDER BY epoch_us(timestamp) {WEEK})"""))


def test_quantile(skewed):
    t, frame = skewed
    for p in (0.0, 0.25, 0.5, 0.95, 1.0):
        assert quantile(t, "amount", p).first()[0] == pytest.approx(frame["amount"].quantile(p))


def test_payday(txns):
    rows = [
        ("a", "x", "2024-01-01 00:00:00", -500.0, "other"),
        ("b", "x", "2024-01-02 00:00:00", 5.0, "food"),
        ("c", "x", "2024-01-03 00:00:00", -500.01, "other"),
        ("d", "x", "2024-01-07 12:00:00", 5.0, "food"),
        ("e", "x", "2024-01-08 00:00:00", -900.0, "food"),
        ("f", "y", "2024-01-08 00:00:00", -900.0, None),
    ]
    t = with_time_cell(txns(rows, ("transaction_id", "account_id", "timestamp", "amount", "merchant_category")))
    out = by_id(acc.payday_features(t).select("transaction_id", "days_since_payday", "is_post_payday"))
    assert out == {"a": (999, 0), "b": (999, 0), "c": (0, 1), "d": (4, 0), "e": (5, 0), "f": (0, 1)}


def test_previous_amount_of_minus_one(txns):
    t = with_time_cell(txns([("a", "x", "2024-01-01", -1.0), ("b", "x", "2024-01-02", 3.0)]))
    out = by_id(vel.previous_amount_features(vel.with_previous(t, ["amount"])).select("transaction_id", "amount_ratio"))
    close(out, {"a": (-1.0,), "b": (float("nan"),)})


def test_cooldown_follows_the_chain(skewed):
    t, frame = skewed
    passed = {r[0] for r in alerts.cooldown(t.filter("is_fraud = 1")).select("transaction_id").collect()}
    last, expected = {}, set()
    fraud = frame[frame["is_fraud"] == 1].sort_values(["timestamp", "transaction_id"])
    for r in fraud.itertuples():
        if r.account_id not in last or (r.timestamp - last[r.account_id]).total_seconds() >= 86400:
            last[r.account_id] = r.timestamp
            expected.add(r.transaction_id)
    assert passed == expected


def test_same_result_on_any_partitioning(skewed):
    t, _ = skewed
    results = []
    for n in (1, 8):
        r = vel.rolling_days(with_time_cell(t.repartition(n)), {"7d": 7 * DAY})
        results.append(sorted(r.select("transaction_id", "amount_mean_7d", "amount_std_7d").collect()))
    assert results[0] == results[1]


def test_no_raw_window_by_account_alone(skewed):
    """Windows over accounts alone may only see one row per cell, that is, sit above an aggregate."""
    t, _ = skewed
    rows = with_time_cell(t)
    for made in (vel.rolling_days(rows), rolling_diversity(rows, FULL_PROFILE)):
        assert windows_over_raw_rows(made) == []


def windows_over_raw_rows(df):
    """Windows by account without a cell that reach a relation, a join or a union before an aggregate."""
    found = []

    def raw(node):
        name = node.nodeName()
        if name == "Aggregate":
            return False
        below = node.children()
        if name in ("Join", "Union") or below.isEmpty():
            return True
        return any(raw(below.apply(i)) for i in range(below.size()))

    def walk(node):
        below = node.children()
        if node.nodeName() == "Window":
            keys = node.partitionSpec().toString()
            if "account_id" in keys and "_cell" not in keys and "slice" not in keys and raw(below.apply(0)):
                found.append(node.nodeName() + " " + keys)
        for i in range(below.size()):
            walk(below.apply(i))

    walk(df._jdf.queryExecution().optimizedPlan())
    return found


def test_raw_windows_are_found(skewed):
    t, _ = skewed
    raw = t.withColumn("n", F.row_number().over(Window.partitionBy("account_id").orderBy("timestamp")))
    assert len(windows_over_raw_rows(raw)) == 1
