import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import forecast as fc

SEASON, REACH, HORIZON = 7, 8, 30


def plain(y, known):
    """Forecasts and half bands of one series, day by day."""

    def difference(a):
        a = a[1:] - a[:-1]
        return a[SEASON:] - a[:-SEASON]

    w, xw = difference(y), difference(np.vstack([known, np.tile(known[-SEASON:].mean(axis=0), (HORIZON, 1))]))
    rows = np.arange(REACH, len(w))
    x = np.column_stack([np.ones(len(rows))] + [w[rows - k] for k in (1, SEASON, REACH)] + [xw[rows]])
    keep = x.std(axis=0) > 0
    keep[0] = True
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    beta = np.zeros(x.shape[1])
    beta[keep] = fc._ridge((x / scale)[:, keep], w[rows], 1e-6) / scale[keep]
    w_all, y_all, pw, py = list(w), list(y), [0.0] * REACH + [1.0], [0.0] * REACH + [1.0]
    for h in range(HORIZON):
        w_all.append(beta[0] + sum(b * w_all[-k] for b, k in zip(beta[1:4], (1, SEASON, REACH))) + xw[len(w) + h] @ beta[4:])
        y_all.append(w_all[-1] + y_all[-1] + y_all[-SEASON] - y_all[-REACH])
        if h:
            pw.append(sum(b * pw[-k] for b, k in zip(beta[1:4], (1, SEASON, REACH))))
            py.append(pw[-1] + py[-1] + py[-SEASON] - py[-REACH])
    half = 1.959963984540054 * np.std(w[rows] - x @ beta) * np.sqrt(np.cumsum(np.square(py[REACH:])))
    return np.array(y_all[-HORIZON:]), half


@pytest.fixture(scope="module")
def days(spark):
    """Accounts with gaps, of different lengths; one too short, one that begins without a balance, one without a name."""
    rng = np.random.default_rng(2)
    rows = []
    for account, n, share in (("a", 200, 0.6), ("b", 75, 0.9), ("c", 400, 0.05), ("short", 40, 1.0), ("late", 120, 0.8), (None, 90, 0.7)):
        seen = [i for i in range(n) if i in (0, n - 1) or rng.random() < share]
        for i in seen:
            balance = None if account == "late" and i < 12 else float(np.round(1000 + 3 * i + rng.normal(0, 40), 2))
            rows.append((account, i, balance, float(np.round(rng.normal(0, 50), 2)), int(rng.integers(1, 5)), int(i % 7 > 4), int(i % 31 == 3)))
    df = spark.createDataFrame(rows, "account_id string, i int, balance double, net_flow double, txn_count int, is_weekend int, is_holiday int")
    return df.withColumn("ds", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i"))).drop("i").repartition(3).cache()


def rows_of(df):
    found = df.orderBy("account_id", "date").collect()
    values = np.array([[r["forecast"], r["lower_bound"], r["upper_bound"]] for r in found], dtype=float)
    return [(r["account_id"], r["date"]) for r in found], values


def test_packed_series_give_what_every_day_gives(days):
    keys, values = rows_of(fc.seasonal_ar_forecast(fc.filled_series(days)))
    packed_keys, packed_values = rows_of(fc.seasonal_ar_forecast(fc.filled_series(days, packed=True)))
    assert keys == packed_keys and {a for a, _ in keys} == {"a", "b", "c", "late", None}
    assert np.allclose(values, packed_values, equal_nan=True, rtol=1e-9)
    # No balance is known of the account without a name.
    assert np.isnan(values[[a is None for a, _ in keys]]).all()


@pytest.mark.parametrize("account", ["a", "b", "c"])
def test_batches_give_what_single_series_give(days, account):
    series = fc.filled_series(days).where(F.col("account_id") == account).toPandas().sort_values("ds")
    mid, half = plain(series["balance"].to_numpy(float), series[fc.REGRESSORS].to_numpy(float))
    keys, values = rows_of(fc.seasonal_ar_forecast(fc.filled_series(days, packed=True)))
    own = values[[a == account for a, _ in keys]]
    assert own == pytest.approx(np.column_stack([mid, mid - half, mid + half]), rel=1e-6)


def test_unknown_forecasts_are_null_and_second_rows_of_a_day_count(days):
    out = fc.seasonal_ar_forecast(fc.filled_series(days, packed=True))
    assert out.where("account_id IS NULL AND forecast IS NULL").count() == HORIZON and out.where("isnan(forecast)").count() == 0
    twice = days.where("account_id = 'short'").union(days.where("account_id = 'short'"))
    for filled in (fc.filled_series(twice), fc.filled_series(twice, packed=True)):
        assert fc.seasonal_ar_forecast(filled).count() == HORIZON
