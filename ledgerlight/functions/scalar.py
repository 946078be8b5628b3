"""Column-level helpers: time parts, money in exact units, guarded ratios, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Money is added up as whole ten-thousandths: exact, order-free, the same on any partitioning.
UNITS_PER_MONEY = 10_000


# Beyond it a double no longer holds every ten-thousandth.
LARGEST_MONEY = 9e11


def units(amount, per_money: int = UNITS_PER_MONEY) -> Column:
    """Money in whole units, `per_money` to one; null where it is missing, NaN, infinite or beyond LARGEST_MONEY."""
    x = finite(F.col(amount) if isinstance(amount, str) else amount)
    return F.when(F.abs(x) <= LARGEST_MONEY, F.round(x * per_money).cast("long"))


def money(total: Column) -> Column:
    return total.cast("double") / F.lit(float(UNITS_PER_MONEY))


def squared(u: Column) -> Column:
    """Square of a unit amount with room for sums over very many rows."""
    return (u.cast("decimal(19,0)") * u.cast("decimal(19,0)")).cast("decimal(38,0)")


def unit_std(n: Column, s: Column, q: Column) -> Column:
    """Sample standard deviation in money from count, sum and sum of squares in units; null below two rows.

    Squares are moved to a whole number next to the mean first, exactly: with r = s - m * n, the squares around m add up
    to q - m * (s + r). So the products stay in a decimal's range at 10^12 rows, and equal amounts give exactly 0.
    """
    rows, total = n.cast("decimal(18,0)"), s.cast("decimal(38,0)")
    m = F.round(total.cast("double") / F.greatest(n, F.lit(1))).cast("decimal(18,0)")
    r = (total - m * rows).cast("decimal(28,0)")
    around = (q - m * (total + r).cast("decimal(38,0)")).cast("double")
    size = n.cast("double")
    spread = F.greatest(around - r.cast("double") * r.cast("double") / size, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (size - 1)) / UNITS_PER_MONEY)


def padded(c: Column, width: int) -> Column:
    """Text filled with leading zeros to a least width; longer text stays whole, so keys stay distinct."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def ratio(num: Column, den: Column) -> Column:
    """Division that gives null instead of failing on a zero divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    x = c.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def weekday(ts: str = "timestamp") -> Column:
    return F.weekday(ts)


def is_weekend(ts: str = "timestamp") -> Column:
    return flag(F.weekday(ts) >= 5)


def is_night(ts: str = "timestamp") -> Column:
    return flag((F.hour(ts) >= 22) | (F.hour(ts) <= 6))


def is_business_hours(ts: str = "timestamp") -> Column:
    return flag(F.hour(ts).between(9, 17))


def time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour, weekday (Monday 0), month, day and the flags derived from them."""
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "month": F.month(ts),
            "day_of_month": F.dayofmonth(ts),
            "is_weekend": is_weekend(ts),
            "is_night": is_night(ts),
            "is_business_hours": is_business_hours(ts),
            "is_month_end_week": flag(F.dayofmonth(ts) >= 25),
            # Marks every day of a quarter's last month.
            "is_quarter_end": flag(F.month(ts).isin(3, 6, 9, 12)),
        }
    )


# Upper edges (inclusive) of the amount categories, in order.
AMOUNT_BINS = [(25, "micro"), (100, "small"), (500, "medium"), (2000, "large")]


def amount_category(size: Column) -> Column:
    """Right-closed bins above zero; zero has no category."""
    label = F.when(size <= 0, None)
    for edge, name in AMOUNT_BINS:
        label = label.when(size <= edge, name)
    return label.when(size > AMOUNT_BINS[-1][0], "xlarge")


def amount_category_rank(size: Column) -> Column:
    rank = F.when(size <= 0, None)
    for i, (edge, _) in enumerate(AMOUNT_BINS):
        rank = rank.when(size <= edge, i)
    return rank.when(size > AMOUNT_BINS[-1][0], len(AMOUNT_BINS))


def amount_features(df: DataFrame, amount: str = "amount") -> DataFrame:
    size = F.abs(amount)
    return df.withColumns(
        {
            "amount_abs": size,
            "is_debit": flag(F.col(amount) > 0),
            "is_credit": flag(F.col(amount) < 0),
            "amount_log": F.log1p(size),
            "amount_category": amount_category(size),
            "amount_category_rank": amount_category_rank(size),
            "is_round_amount": flag(F.col(amount) % 10 == 0),
            "is_very_round": flag(F.col(amount) % 100 == 0),
        }
    )


def cyclic_features(df: DataFrame, hour: str = "hour_of_day", dow: str = "day_of_week") -> DataFrame:
    turn = 2 * F.pi()
    return df.withColumns(
        {
            "hour_sin": F.sin(turn * F.col(hour) / 24),
            "hour_cos": F.cos(turn * F.col(hour) / 24),
            "dow_sin": F.sin(turn * F.col(dow) / 7),
            "dow_cos": F.cos(turn * F.col(dow) / 7),
        }
    )


# Category of the card data -> channel; anything else is point of sale.
CHANNEL_OF_CATEGORY = {
    "grocery_pos": "pos",
    "gas_transport": "pos",
    "misc_pos": "pos",
    "grocery_net": "online",
    "misc_net": "online",
    "shopping_net": "online",
    "shopping_pos": "pos",
}

# Category code -> display label.
CATEGORY_LABELS = {
    0: "Entertainment",
    1: "Food & Dining",
    2: "Gas & Transport",
    3: "Grocery (POS)",
    4: "Grocery (Online)",
    5: "Health & Fitness",
    6: "Home",
    7: "Kids & Pets",
    8: "Miscellaneous (Online)",
    9: "Miscellaneous (POS)",
    10: "Personal Care",
    11: "Shopping (Online)",
    12: "Shopping (POS)",
    13: "Travel",
}

# Feature name -> wording in alerts.
FEATURE_LABELS = {
    "amount_abs": "Transaction Amount",
    "hour_of_day": "Hour of Day",
    "is_night": "Night Transaction",
    "is_weekend": "Weekend Transaction",
    "txn_count_1d": "24h Transaction Count",
    "txn_count_7d": "7-day Transaction Count",
    "velocity_7d_vs_30d": "7d vs 30d Spending Velocity",
    "is_new_merchant": "New Merchant",
    "time_since_last_txn": "Time Since Last Transaction",
    "amount_zscore_7d": "Amount Z-score (7d)",
    "unique_merchants_7d": "Merchant Diversity (7d)",
    "rapid_succession": "Rapid Successive Transactions",
    "is_different_city": "Different City",
    "category_entropy_7d": "Category Diversity (7d)",
}


def lookup(values: dict, key: Column, default=None) -> Column:
    """Small fixed mapping as a map literal."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def channel_of(category: Column) -> Column:
    return lookup(CHANNEL_OF_CATEGORY, category, "pos")


def category_label(code: Column) -> Column:
    return lookup(CATEGORY_LABELS, code.cast("int"), "Unknown")


def feature_label(name: Column) -> Column:
    return lookup(FEATURE_LABELS, name, F.initcap(F.replace(name, F.lit("_"), F.lit(" "))))
