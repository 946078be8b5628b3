"""Features from an account's preceding transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.functions.scalar import flag, money, ratio, squared, unit_std, units
from ledgerlight.operators.cells import (
    DAY,
    HOUR,
    Measure,
    key_totals,
    number_rows,
    over_neighbours,
    same_key,
    trailing,
)

ACCOUNT = ["account_id"]
COUNT_STEPS = (5, 10, 20)
LOOKBACK = max(COUNT_STEPS)


def _lagged(c: str) -> str:
    return "_prev_" + c.lstrip("_")


def previous(c: str) -> Column:
    """A column of the account's previous transaction, null for the first; needs `with_previous` or `with_recent`."""
    return F.col(_lagged(c))


def _lags(columns) -> dict:
    return {_lagged(c): (lambda w, c=c: F.lag(c).over(w)) for c in columns}


def _numbered(df: DataFrame, source: DataFrame | None) -> DataFrame:
    return df if "account_row" in df.columns else number_rows(df, ACCOUNT, source=source)


def with_previous(df: DataFrame, columns: list[str], source: DataFrame | None = None) -> DataFrame:
    """Adds the previous transaction's columns."""
    return over_neighbours(_numbered(df, source), ACCOUNT, 1, _lags(columns))


def _recent(f, n: int):
    return lambda w: f("amount").over(w.rowsBetween(-n, -1))


def with_recent(df: DataFrame, columns=("_us", "amount"), source: DataFrame | None = None) -> DataFrame:
    """Adds the previous transaction's columns and mean, deviation and maximum over 5, 10 and 20 earlier amounts."""
    stats = {
        f"_{name}_{n}": _recent(f, n)
        for n in COUNT_STEPS
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max))
    }
    return over_neighbours(_numbered(df, source), ACCOUNT, LOOKBACK, _lags(columns) | stats)


def count_before(n: int) -> Column:
    """Earlier transactions of the account, n at most."""
    return F.least(F.col("account_row") - 1, F.lit(n)).cast("int")


def hours_since_previous(default: float) -> Column:
    return F.coalesce((F.col("_us") - previous("_us")) / 3.6e9, F.lit(default))


def previous_amount_features(df: DataFrame) -> DataFrame:
    prev = F.coalesce(previous("amount"), F.lit(0.0))
    return df.withColumns(
        {
            "prev_amount": prev,
            "amount_change": F.col("amount") - prev,
            "amount_ratio": ratio(F.col("amount"), prev + 1),
        }
    )


def account_amounts(source: DataFrame) -> DataFrame:
    """Count, mean and deviation of an account's amounts, one row per (account, cell)."""
    u = units("amount")
    totals = key_totals(
        source, ACCOUNT, {"_n": ("sum", F.lit(1)), "_s": ("sum", u), "_q": ("sum", squared(u))}
    )
    return totals.select(
        "account_id",
        "_cell",
        F.col("_n").alias("account_rows"),
        ratio(money(F.col("_s")), F.col("_n")).alias("account_mean"),
        unit_std(F.col("_n"), F.col("_s"), F.col("_q")).alias("account_std"),
    )


def with_account_amounts(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    return same_key(df, account_amounts(df if source is None else source), ["account_id", "_cell"])


def row_window_features(df: DataFrame) -> DataFrame:
    """Counts, means, deviations and maxima over the last 5, 10 and 20 earlier transactions.

    Needs `with_recent` and `account_mean`, which fills in where there is no earlier row.
    """
    out = {}
    for n in COUNT_STEPS:
        out[f"txn_count_last_{n}"] = count_before(n)
        out[f"amount_mean_last_{n}"] = F.coalesce(f"_mean_{n}", "account_mean")
        out[f"amount_std_last_{n}"] = F.coalesce(f"_std_{n}", F.lit(0.0))
        out[f"amount_max_last_{n}"] = F.coalesce(f"_max_{n}", "account_mean")
    out |= {f"avg_amount_last_{n}": out[f"amount_mean_last_{n}"] for n in (5, 10)}
    return df.withColumns(out).drop(*[f"_{k}_{n}" for n in COUNT_STEPS for k in ("mean", "std", "max")])


def rapid_flags(df: DataFrame) -> DataFrame:
    """Needs `time_since_last` and `avg_amount_last_10`."""
    return df.withColumns(
        {
            "vel_recent_vs_avg": ratio(F.col("amount"), F.col("avg_amount_last_10") + 1),
            "rapid_fire": flag(F.col("time_since_last") < 0.083),
            "rapid_succession": flag(F.col("time_since_last") < 0.5),
        }
    )


def amount_position(df: DataFrame) -> DataFrame:
    """Amount against the account's own mean and against recent mean and maximum."""
    return df.withColumns(
        {
            "amount_zscore": F.coalesce(
                ratio(F.col("amount") - F.col("account_mean"), F.col("account_std") + 1e-8), F.lit(0.0)
            ),
            "amount_vs_recent_avg": ratio(F.col("amount"), F.col("amount_mean_last_10") + 1),
            "amount_vs_recent_max": ratio(F.col("amount"), F.col("amount_max_last_10") + 1),
        }
    )


ROLLING_DAYS = {"1d": DAY, "7d": 7 * DAY, "14d": 14 * DAY, "30d": 30 * DAY}


def rolling_measures(spans: tuple[str, ...] | None = None) -> list[Measure]:
    u = units("amount")
    size = F.abs(u)
    return [
        Measure("_n", F.lit(1), spans=spans),
        Measure("_debit", F.greatest(u, F.lit(0)), spans=spans),
        Measure("_credit", F.least(u, F.lit(0)), spans=spans),
        Measure("_sq", squared(u), spans=spans),
        Measure("_max", size, "max", spans=spans),
    ]


def rolling_columns(spans) -> dict[str, Column]:
    out = {}
    for s in spans:
        n, q = F.col(f"_n_{s}"), F.col(f"_sq_{s}")
        size = F.col(f"_debit_{s}") - F.col(f"_credit_{s}")
        out[f"txn_count_{s}"] = n
        out[f"debit_sum_{s}"] = money(F.col(f"_debit_{s}"))
        out[f"credit_sum_{s}"] = money(F.col(f"_credit_{s}"))
        out[f"amount_mean_{s}"] = ratio(money(size), n)
        out[f"amount_std_{s}"] = F.coalesce(unit_std(n, size, q), F.lit(0.0))
        out[f"amount_max_{s}"] = money(F.col(f"_max_{s}"))
    return out


def rolling_days(
    df: DataFrame, spans: dict[str, int] = ROLLING_DAYS, source=None, also: list[Measure] = (), derived: dict[str, Column] | None = None
) -> DataFrame:
    """Count, debit and credit sums, mean, deviation and maximum of the size over trailing days.

    `also` and `derived` let other features over the same spans share the pass.
    """
    measures = rolling_measures() + list(also)
    measured = trailing(df, ACCOUNT, spans, measures, source=source)
    out = measured.withColumns(rolling_columns(spans) | (derived or {}))
    return out.drop(*[f"{m.name}_{s}" for m in measures for s in (m.spans or spans)])


def velocity_ratios(df: DataFrame) -> DataFrame:
    def against(a, b):
        return ratio(F.col(a), F.col(b) + 1e-6)

    return df.withColumns(
        {
            "velocity_7d_vs_30d": against("debit_sum_7d", "debit_sum_30d"),
            "velocity_1d_vs_7d": against("debit_sum_1d", "debit_sum_7d"),
            "txn_velocity_7d_vs_30d": against("txn_count_7d", "txn_count_30d"),
        }
    )


def rolling_zscores(df: DataFrame, spans=("7d", "30d")) -> DataFrame:
    return df.withColumns(
        {
            f"amount_zscore_{s}": ratio(
                F.abs("amount") - F.col(f"amount_mean_{s}"), F.col(f"amount_std_{s}") + 1e-6
            )
            for s in spans
        }
    )


HOUR_SPANS = {"1H": HOUR, "6H": 6 * HOUR, "24H": DAY, "7D": 7 * DAY, "30D": 30 * DAY}


def velocity_windows(df: DataFrame, source=None) -> DataFrame:
    """The hour and day windows the feature list declares: counts, signed mean and deviation, scores, ratios."""
    u = units("amount")
    amounts = ("24H", "7D", "30D")
    measures = [
        Measure("_n", F.lit(1)),
        Measure("_s", u, spans=amounts),
        Measure("_sq", squared(u), spans=amounts),
    ]
    df = trailing(df, ACCOUNT, HOUR_SPANS, measures, source=source)
    out = {f"txn_count_{s}": F.col(f"_n_{s}") for s in ("1H", "6H", "24H", "7D")}
    for s in amounts:
        n = F.col(f"_n_{s}")
        out[f"amt_mean_{s}"] = ratio(money(F.col(f"_s_{s}")), n)
        out[f"amt_std_{s}"] = F.coalesce(unit_std(n, F.col(f"_s_{s}"), F.col(f"_sq_{s}")), F.lit(0.0))
    df = df.withColumns(out)
    later = {}
    for s in ("24H", "7D"):
        later[f"amt_zscore_{s.lower()}"] = ratio(
            F.col("amount") - F.col(f"amt_mean_{s}"), F.col(f"amt_std_{s}") + 1e-8
        )
        later[f"amt_pct_vs_{s.lower()}"] = ratio(F.col("amount"), F.col(f"amt_mean_{s}") + 1)
    later["vel_1h_vs_24h"] = ratio(F.col("txn_count_1H"), F.col("txn_count_24H") + 1e-6)
    later["vel_6h_vs_7d"] = ratio(F.col("txn_count_6H"), F.col("txn_count_7D") + 1e-6)
    return df.withColumns(later).drop(
        *[f"_n_{s}" for s in HOUR_SPANS], *[f"{m}_{s}" for m in ("_s", "_sq") for s in amounts]
    )


def hourly_txn_count(df: DataFrame, source=None) -> DataFrame:
    """Transactions of the account in the same clock hour."""
    hour = F.date_trunc("hour", "timestamp")
    source = df if source is None else source
    counts = source.groupBy("account_id", hour.alias("_hour")).agg(F.count(F.lit(1)).alias("hourly_txn_count"))
    return same_key(df.withColumn("_hour", hour), counts, ["account_id", "_hour"]).drop("_hour")
