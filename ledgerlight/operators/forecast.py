"""Daily account series and balance forecasts.

An account has at most one row per calendar day here, so windows and grouped fits by account are bounded by the
days of history, not by its transactions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.functions.scalar import flag, money, units

HORIZON = 30
RECENT_DAYS = 30
MIN_TRANSACTIONS = 30
MIN_DAYS = 15
# Mean of the weekday adjustment; weekends have none.
WEEKDAY_SHIFT = -20.0
BAND = 0.1
REGRESSORS = ["is_weekend", "is_holiday", "net_flow", "txn_count"]

ALL_BEFORE = (Window.unboundedPreceding, 0)


def daily_series(df: DataFrame, opening: DataFrame | None = None, calendar: DataFrame | None = None) -> DataFrame:
    """Per account and day: closing balance, net flow, counts, weekend and holiday flags.

    With `opening`, the balance is the opening balance less the flows so far; otherwise the day's last `balance`.
    """
    u = units("amount")
    closing = [] if opening is not None else [F.max_by("balance", F.struct("timestamp", "transaction_id")).alias("balance")]
    days = df.groupBy("account_id", F.to_date("timestamp").alias("ds")).agg(
        *closing,
        F.sum(u).alias("_flow"),
        F.count(F.lit(1)).alias("txn_count"),
        F.sum(flag(F.col("amount") > 0)).alias("debit_count"),
        F.sum(flag(F.col("amount") < 0)).alias("credit_count"),
    )
    if opening is not None:
        so_far = Window.partitionBy("account_id").orderBy("ds").rowsBetween(*ALL_BEFORE)
        days = days.join(opening, "account_id", "left").withColumn(
            "balance", money(units("opening_balance") - F.sum("_flow").over(so_far))
        )
    days = days.withColumns({"net_flow": money(F.col("_flow")), "is_weekend": (F.weekday("ds") >= 5).cast("int")})
    if calendar is None:
        days = days.withColumn("is_holiday", F.lit(0))
    else:
        cal = calendar.select(F.col("date").alias("ds"), "is_holiday")
        days = days.join(cal, "ds", "left").withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
    return days.select(
        "account_id", "ds", "balance", "net_flow", "txn_count", "debit_count", "credit_count", "is_weekend", "is_holiday"
    )


def filled_series(days: DataFrame, packed: bool = False) -> DataFrame:
    """Every day between an account's first and last: balance carried on, everything else 0.

    `packed` gives the same series as a row per account, with its observed days only, for `unpacked` in a Python worker:
    an account with few transactions in years has many more days than rows.
    """
    rest = [c for c in days.columns if c not in ("account_id", "ds", "balance")]
    if packed:
        # As in the join below, nothing is known of the days of a null account but the first and the last one.
        known = F.col("account_id").isNotNull()
        days = days.where("ds IS NOT NULL").withColumns({"balance": F.when(known, F.col("balance"))} | {c: F.when(known, F.col(c)) for c in rest})
        return packed_series(days.na.fill(0, rest))
    spine = (
        days.groupBy("account_id")
        .agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
        .select("account_id", F.explode(F.sequence("a", "b")).alias("ds"))
    )
    rows = spine.join(days, ["account_id", "ds"], "left")
    carried = Window.partitionBy("account_id").orderBy("ds").rowsBetween(*ALL_BEFORE)
    return rows.withColumn("balance", F.last("balance", ignorenulls=True).over(carried)).na.fill(0, rest)


def packed_series(days: DataFrame) -> DataFrame:
    """(account_id, series): an account's days as an array of (ds, balance, regressors), in any order."""
    day = F.struct("ds", F.col("balance").cast("double").alias("balance"), *[F.col(c).cast("double").alias(c) for c in REGRESSORS])
    return days.groupBy("account_id").agg(F.collect_list(day).alias("series"))


def _by_day(day: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The order of the days within each account; rows of one day come as pandas sorts them."""
    account = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((day, account))
    tied = (np.diff(account) == 0) & (np.diff(day[order]) == 0)
    for a in np.unique(account[1:][tied]):
        some = slice(bounds[a], bounds[a + 1])
        order[some] = bounds[a] + day[some].astype(object).argsort(kind="quicksort")
    return order


def unpacked(ends: np.ndarray, day: np.ndarray, balance: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, balances, regressors) of the filled series of some accounts, which end at the last place of a row.

    `ends` has the end of each account's observed days in the other arrays, `day` counts days from any one on; regressors
    are (kind, day). Places before an
    account's first day have its first balance.
    """
    starts = np.concatenate([[0], ends[:-1]])
    length = day[ends - 1] - day[starts] + 1
    width = int(length.max())
    row = np.repeat(np.arange(len(ends)), ends - starts)
    place = day - np.repeat(day[ends - 1], ends - starts) + width - 1
    filled = np.zeros((len(known), len(ends), width))
    filled[:, row, place] = known
    # The place of the last known balance up to each place.
    last = np.zeros((len(ends), width), dtype=np.int64)
    seen = ~np.isnan(balance)
    last[row[seen], place[seen]] = np.flatnonzero(seen) + 1
    first = width - length
    last = np.maximum.accumulate(last, axis=1)
    last[np.arange(width) < first[:, None]] = 0
    out = np.where(last > 0, balance[last - 1], np.nan)
    before = np.arange(width) < first[:, None]
    out = np.where(before, out[np.arange(len(ends)), first][:, None], out)
    return length, out, filled


def moving_averages(days: DataFrame) -> DataFrame:
    """Balance averaged over the last 7 and 30 observed days, current one included."""
    by_day = Window.partitionBy("account_id").orderBy("ds")
    return days.withColumns(
        {f"ma_{n}": F.avg("balance").over(by_day.rowsBetween(-(n - 1), 0)) for n in (7, 30)}
    )


def risk_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"overdraft_risk": flag(F.col("forecast") < 0), "low_balance_risk": flag(F.col("forecast") < 100)}
    )


def trend_forecast(
    days: DataFrame, horizon: int = HORIZON, min_transactions: int = MIN_TRANSACTIONS, min_days: int = MIN_DAYS
) -> DataFrame:
    """Current balance plus the least-squares slope of the last 30 observed days, for every eligible account."""
    backwards = Window.partitionBy("account_id").orderBy(F.col("ds").desc())
    back = days.withColumn("_back", F.row_number().over(backwards))
    recent = F.col("_back") <= RECENT_DAYS
    fitted = back.groupBy("account_id").agg(
        F.max("ds").alias("_last"),
        F.max_by("balance", "ds").alias("_current"),
        F.sum("txn_count").alias("_txns"),
        F.count(F.lit(1)).alias("_days"),
        F.regr_slope(F.when(recent, F.col("balance")), F.when(recent, -F.col("_back"))).alias("_slope"),
    )
    ahead = (
        fitted.filter((F.col("_txns") >= min_transactions) & (F.col("_days") >= min_days))
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("date", F.date_add("_last", F.col("_i")))
    )
    shift = F.when(F.weekday("date") >= 5, 0.0).otherwise(WEEKDAY_SHIFT)
    value = F.col("_current") + F.coalesce("_slope", F.lit(0.0)) * F.col("_i") + shift
    out = ahead.withColumn("forecast", value).select(
        "account_id",
        "date",
        "forecast",
        (F.col("forecast") - F.abs("forecast") * BAND).alias("lower_bound"),
        (F.col("forecast") + F.abs("forecast") * BAND).alias("upper_bound"),
        F.lit("simple_trend").alias("model_type"),
    )
    return risk_flags(out)


FORECAST_SCHEMA = (
    "account_id string, date date, forecast double, lower_bound double, upper_bound double, model_type string"
)


def _future(series: pd.DataFrame, horizon: int) -> pd.DatetimeIndex:
    return pd.date_range(pd.Timestamp(series["ds"].iloc[-1]) + pd.Timedelta(days=1), periods=horizon, freq="D")


def _rows(account, dates, mid, half, model) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "account_id": account,
            "date": dates.date,
            "forecast": mid,
            "lower_bound": mid - half,
            "upper_bound": mid + half,
            "model_type": model,
        }
    )


def _empty() -> pd.DataFrame:
    return pd.DataFrame(
        {c: pd.Series(dtype="object") for c in ("account_id", "date", "model_type")}
        | {c: pd.Series(dtype="float64") for c in ("forecast", "lower_bound", "upper_bound")}
    )[["account_id", "date", "forecast", "lower_bound", "upper_bound", "model_type"]]


def _waves(day: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2 * np.pi * np.outer(day, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(angle), np.cos(angle)])


def _ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    shrink = penalty * np.eye(x.shape[1])
    shrink[0, 0] = 0.0
    return np.linalg.solve(x.T @ x + shrink, x.T @ y)


def additive_forecast(filled: DataFrame, horizon: int = HORIZON, min_days: int = 30, z: float = 1.2815515655446004):
    """Trend, weekly (yearly from two years on) waves and regressors by ridge regression per account, 80 % band."""

    def fit(series: pd.DataFrame) -> pd.DataFrame:
        if len(series) < min_days:
            return _empty()
        series = series.sort_values("ds")
        when = pd.to_datetime(series["ds"])
        future = _future(series, horizon)
        n = len(series)
        known = series[REGRESSORS].to_numpy(float)
        mean, spread = known.mean(axis=0), known.std(axis=0)
        spread[spread == 0] = 1.0
        recent = series.tail(30)
        assumed = np.column_stack(
            [
                (future.dayofweek >= 5).astype(float),
                np.zeros(horizon),
                np.full(horizon, recent["net_flow"].mean()),
                np.full(horizon, recent["txn_count"].mean()),
            ]
        )

        def design(dates, place, regressors):
            day = dates.to_numpy().astype("datetime64[D]").astype(float)
            parts = [np.ones((len(day), 1)), (place / n)[:, None], _waves(day, 7.0, 3)]
            if n >= 730:
                parts.append(_waves(day, 365.25, 10))
            parts.append((regressors - mean) / spread)
            return np.hstack(parts)

        x = design(when, np.arange(n, dtype=float), known)
        y = series["balance"].to_numpy(float)
        level, scale = y.mean(), y.std() or 1.0
        beta = _ridge(x, (y - level) / scale, 0.1)
        mid = design(future, np.arange(n, n + horizon, dtype=float), assumed) @ beta * scale + level
        half = z * np.std(y - (x @ beta * scale + level))
        return _rows(series["account_id"].iloc[0], future, mid, half, "additive")

    needed = filled.select("account_id", "ds", "balance", *REGRESSORS)
    return risk_flags(needed.groupBy("account_id").applyInPandas(fit, FORECAST_SCHEMA))


def seasonal_ar_forecast(filled: DataFrame, horizon: int = HORIZON, min_days: int = 50, season: int = 7, z: float = 1.959963984540054):
    """Seasonal autoregression on the balance differenced at 1 and 7 days, with regressors; 95 % band.

    Least squares on lags 1, 7 and 8 of the differenced balance. Future regressors are their last 7-day means. The accounts
    of a batch are fitted together; `filled` may be packed.
    """
    reach = season + 1

    lags = (1, season, reach)
    chunk = 250_000  # days that are worked on at once

    def difference(a):
        a = a[..., 1:] - a[..., :-1]
        return a[..., season:] - a[..., :-season]

    def fit(length: np.ndarray, y: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(accounts, horizon): forecasts and half bands of series that end at the last place of a row."""
        n, width = y.shape
        assumed = np.repeat(known[:, :, -season:].mean(axis=2)[:, :, None], horizon, axis=2)
        w = difference(y)
        xw = difference(np.concatenate([known, assumed], axis=2))
        rows = np.arange(reach, w.shape[1])
        inside = rows >= (width - length + reach)[:, None]
        alone = inside[:, None]
        m = (length - 2 * reach)[:, None].astype(float)
        x = np.where(alone, np.stack([np.ones((n, len(rows)))] + [w[:, rows - k] for k in lags] + list(xw[:, :, rows]), axis=1), 0.0)
        mean = x.sum(axis=2) / m
        spread = np.sqrt(np.where(alone, np.square(x - mean[:, :, None]), 0.0).sum(axis=2) / m)
        keep = spread > 0
        keep[:, 0] = True
        scale = np.where(spread > 0, spread, 1.0)
        target = np.where(inside, w[:, rows], 0.0)
        x_scaled = np.where(keep[:, :, None], x / scale[:, :, None], 0.0)
        # A column that is left out has a row of its own.
        shrink = np.where(keep, 1e-6, 1.0)
        shrink[:, 0] = 0.0
        gram = x_scaled @ x_scaled.transpose(0, 2, 1) + shrink[:, :, None] * np.eye(x.shape[1])
        beta = np.linalg.solve(gram, (x_scaled @ target[:, :, None]))[:, :, 0] * keep / scale
        left = target - (beta[:, None] @ x)[:, 0]
        off = left.sum(axis=1, keepdims=True) / m
        sigma = np.sqrt(np.where(inside, np.square(left - off), 0.0).sum(axis=1) / m[:, 0])

        def step(w_all, h):
            return sum(beta[:, i + 1] * w_all[:, reach + h - k] for i, k in enumerate(lags))

        def level(w_all, y_all, h):
            return w_all[:, reach + h] + y_all[:, reach + h - 1] + y_all[:, reach + h - season] - y_all[:, h]

        w_all, y_all = (np.concatenate([a[:, -reach:], np.zeros((n, horizon))], axis=1) for a in (w, y))
        # Response of the balance to one unit of noise at the first step gives the width of the band.
        pulse_w, pulse_y = np.zeros((n, reach + horizon)), np.zeros((n, reach + horizon))
        pulse_w[:, reach] = pulse_y[:, reach] = 1.0
        with np.errstate(over="ignore", invalid="ignore"):
            for h in range(horizon):
                w_all[:, reach + h] = beta[:, 0] + step(w_all, h) + (xw[:, :, w.shape[1] + h].T * beta[:, 4:]).sum(axis=1)
                y_all[:, reach + h] = level(w_all, y_all, h)
                if h:
                    pulse_w[:, reach + h] = step(pulse_w, h)
                    pulse_y[:, reach + h] = level(pulse_w, pulse_y, h)
            half = z * sigma[:, None] * np.sqrt(np.cumsum(np.square(pulse_y[:, reach:]), axis=1))
        return y_all[:, reach:], half

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            series = batch.column("series")
            bounds = series.offsets.to_numpy()
            days = series.values.flatten() if isinstance(series.values, pa.StructArray) else series.values
            values = [c.to_numpy(zero_copy_only=False) if i else c.cast(pa.int32()).to_numpy(zero_copy_only=False).astype(np.int64) for i, c in enumerate(days)]
            day, balance, known = values[0], values[1], np.array(values[2:])
            by_day = _by_day(day, bounds)
            day, balance, known = day[by_day], balance[by_day], known[:, by_day]
            last = day[bounds[1:] - 1]
            # Days between two rows are filled; a second row of one day is a step of its own.
            start = np.zeros(len(day), dtype=bool)
            start[bounds[:-1]] = True
            step = np.where(start, 0, np.maximum(1, np.diff(day, prepend=day[:1])))
            place = np.cumsum(step)
            length = place[bounds[1:] - 1] - place[bounds[:-1]] + 1
            # Alike lengths together, as the places of a chunk are as many as its longest series has.
            order = np.argsort(length, kind="stable")
            order = order[length[order] >= max(min_days, 3 * reach)]
            while len(order):
                size = max(1, int(np.searchsorted(np.arange(1, len(order) + 1) * length[order], chunk)))
                some, order = order[:size], order[size:]
                counts = bounds[some + 1] - bounds[some]
                ends = np.cumsum(counts)
                at = np.repeat(bounds[some] - (ends - counts), counts) + np.arange(ends[-1])
                mid, half = fit(*unpacked(ends, place[at], balance[at], known[:, at]))
                date = last[some][:, None] + np.arange(1, horizon + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("account_id").take(pa.array(np.repeat(some, horizon))),
                        pa.array(date.ravel().astype(np.int32)).cast(pa.date32()),
                        *[pa.array(v.ravel(), from_pandas=True) for v in (mid, mid - half, mid + half)],
                        pa.array(["seasonal_ar"] * mid.size),
                    ],
                    names=["account_id", "date", "forecast", "lower_bound", "upper_bound", "model_type"],
                )

    rows = filled if "series" in filled.columns else packed_series(filled)
    return risk_flags(rows.mapInArrow(fitted, FORECAST_SCHEMA))


def forecast(kind: str, days: DataFrame, filled: DataFrame, **options) -> DataFrame:
    """Forecast by model name."""
    if kind == "simple_trend":
        return trend_forecast(days, **options)
    if kind == "additive":
        return additive_forecast(filled, **options)
    if kind == "seasonal_ar":
        return seasonal_ar_forecast(filled, **options)
    raise ValueError(f"unknown model type {kind!r}")


def overdraft_risk(forecasts: DataFrame, as_of: str, threshold: float = 0.0) -> DataFrame:
    """Risk flags against the threshold and days from `as_of` to the account's first breach (0 if past)."""
    by_account = Window.partitionBy("account_id")
    breach = F.col("forecast") < threshold
    first = F.min(F.when(breach, F.col("date"))).over(by_account)
    return forecasts.withColumns(
        {
            "overdraft_risk": flag(breach),
            "high_overdraft_risk": flag(F.col("upper_bound") < threshold),
            "days_to_overdraft": F.when(
                first.isNotNull(), F.greatest(F.lit(0), F.datediff(first, F.lit(as_of).cast("date")))
            ),
        }
    )


# Days ahead that an expected overdraft raises an alert.
OVERDRAFT_ALERT_DAYS = 7


def overdraft_alerts(forecasts: DataFrame, as_of: str, days: int = OVERDRAFT_ALERT_DAYS, threshold: float = 0.0) -> DataFrame:
    """(account_id, date, days_to_overdraft, forecast) of each account's first breach, if it is within `days`."""
    breach = forecasts.filter(F.col("forecast") < threshold)
    first = breach.groupBy("account_id").agg(F.min(F.struct("date", "forecast")).alias("f"))
    ahead = F.greatest(F.lit(0), F.datediff(F.col("f.date"), F.lit(as_of).cast("date")))
    out = first.select("account_id", F.col("f.date").alias("date"), ahead.alias("days_to_overdraft"), F.col("f.forecast").alias("forecast"))
    return out.filter(F.col("days_to_overdraft") <= days)


def all_forecasts(days: DataFrame, kinds: dict[str, dict]) -> DataFrame:
    """The forecasts of several models in one table, told apart by model_type; `kinds` has the options of each."""
    filled = filled_series(days)
    parts = [forecast(kind, days, filled, **options) for kind, options in kinds.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def backtest_pairs(days: DataFrame, cutoff: str, horizon: int = HORIZON) -> DataFrame:
    """Trend forecast from the history up to a date against the balances observed afterwards."""
    day = F.lit(cutoff).cast("date")
    past = trend_forecast(days.filter(F.col("ds") <= day), horizon, min_transactions=1, min_days=2)
    seen = days.filter(F.col("ds") > day).select("account_id", F.col("ds").alias("date"), F.col("balance").alias("actual"))
    return past.select("account_id", "date", F.col("forecast").alias("predicted")).join(seen, ["account_id", "date"])

