"""Ordered per-key work in two levels.

A window over a whole account puts that account into one task, however many rows it has. Here a key's
ordered rows are cut into cells (hours for time, ranges drawn from the data for amounts and scores). Rows are only
ever grouped by (key, cell). One aggregated row per cell then carries totals and running totals
from cell to cell; that second level is bounded by the number of cells a key can have, not by its rows. Once rows
are numbered that way, windows over neighbouring rows work on slices of a fixed number of rows.

`source` arguments name a cheap frame to aggregate from (a scan, or a written table), so that a long chain
of features is not evaluated again for its side tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ledgerlight.functions.scalar import finite
from ledgerlight.session import cut

HOUR = 3600
DAY = 86_400
CELL_SECONDS = HOUR

UNBOUNDED = Window.unboundedPreceding


def cell_of(us: Column, seconds: int = CELL_SECONDS) -> Column:
    width = F.lit(seconds * 1_000_000)
    return F.floor((us - F.pmod(us, width)) / width).cast("long")


def with_time_cell(df: DataFrame, ts: str = "timestamp", seconds: int = CELL_SECONDS) -> DataFrame:
    us = F.unix_micros(ts)
    return df.withColumns({"_us": us, "_cell": cell_of(us, seconds)})


def ranged(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds `_cell`: the number of the row's range in the order of *columns*, as a written table.

    Spark draws the ranges' bounds from the rows themselves, so a range holds about an even share of them however the
    values are spread, and there are as many ranges as shuffle partitions. Equal values share a range, so rows should be
    counted by value before. Bounds differ between evaluations, hence the table: all that follows sees the same ones.
    """
    return cut(df.repartitionByRange(*columns).withColumn("_cell", F.spark_partition_id().cast("long")), "ranges")


def _combine(how: str, parts: list[Column]) -> Column:
    if how == "max":
        return F.greatest(*parts) if len(parts) > 1 else parts[0]
    zero = F.lit(0)
    total = F.coalesce(parts[0], zero)
    for p in parts[1:]:
        total = total + F.coalesce(p, zero)
    return total


def _agg(how: str, c) -> Column:
    return F.max(c) if how == "max" else F.sum(c)


def same_key(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi join of a table with a smaller table that has one row per key.

    No hint: run-time statistics choose a broadcast where the small side proves small, and otherwise a
    sort-merge join whose oversized partitions are split.
    """
    return df.join(other, keys, how)


@dataclass(frozen=True)
class Measure:
    """A value column, how it adds up ('sum' or 'max'), and the trailing spans it is wanted for.

    Summed values are whole numbers or decimals, so that sums are exact in any order.
    """

    name: str
    value: Column
    how: str = "sum"
    spans: tuple[str, ...] | None = None


def trailing(
    df: DataFrame,
    keys: list[str],
    spans: dict[str, int],
    measures: list[Measure],
    *,
    source: DataFrame | None = None,
    seconds: int = CELL_SECONDS,
) -> DataFrame:
    """Aggregates over (t - span, t] per key, rows at the same instant included.

    A span ending at t consists of the start of t's own cell, the whole cells before it, and the end of the
    cell that t - span falls in. The last part is found in t's own cell as well, from copies moved forward by
    the span. So three running aggregates replace a sliding frame: work stays linear in the rows however many
    of them a span holds. Needs `_us` and `_cell`; spans are whole cells.
    Result columns are `<measure>_<span>`.
    """
    source = df if source is None else source
    width = seconds * 1_000_000
    steps = {s: sec // seconds for s, sec in spans.items()}
    if any(sec % seconds for sec in spans.values()):
        raise ValueError("spans must be whole multiples of the cell width")
    wanted = [(m, s) for m in measures for s in (m.spans or tuple(spans))]

    narrow = source.select(*keys, "_us", "_cell", *[m.value.alias(f"_m_{m.name}") for m in measures])
    cells = narrow.groupBy(*keys, "_cell").agg(*[_agg(m.how, f"_m_{m.name}").alias(f"_m_{m.name}") for m in measures])
    order = Window.partitionBy(*keys).orderBy("_cell")
    cells = cells.withColumns(
        {f"_p_{m.name}": F.sum(f"_m_{m.name}").over(order.rowsBetween(UNBOUNDED, 0)) for m in measures if m.how == "sum"}
    )

    def upto(m: Measure, back: int) -> Column:
        return F.coalesce(F.last(f"_p_{m.name}").over(order.rangeBetween(UNBOUNDED, -back)), F.lit(0))

    def whole_cells(m: Measure, n: int) -> Column:
        # Sums are exact, so two running totals give the sum of the cells between them.
        if m.how == "sum":
            return upto(m, 1) - upto(m, n)
        return F.max(f"_m_{m.name}").over(order.rangeBetween(-(n - 1), -1))

    whole = cells.select(
        *keys, "_cell", *[whole_cells(m, steps[s]).alias(f"_w_{m.name}_{s}") for m, s in wanted if steps[s] > 1]
    )

    moves = F.array(
        *[F.struct(F.lit(i + 1).alias("role"), F.lit(n).alias("cells")) for i, n in enumerate(steps.values())]
    )
    moved = narrow.withColumn("_move", F.explode(moves)).select(
        *keys,
        (F.col("_us") + F.col("_move.cells") * width).alias("_us"),
        (F.col("_cell") + F.col("_move.cells")).alias("_cell"),
        F.col("_move.role").alias("_role"),
        *[f"_m_{m.name}" for m in measures],
    )
    own = df.withColumns({f"_m_{m.name}": m.value for m in measures}).withColumn("_role", F.lit(0))
    rows = own.unionByName(moved, allowMissingColumns=True)

    cell = Window.partitionBy(*keys, "_cell")
    ahead = cell.orderBy(F.col("_us").asc()).rangeBetween(UNBOUNDED, 0)
    behind = cell.orderBy(F.col("_us").desc()).rangeBetween(UNBOUNDED, -1)
    role = {s: i + 1 for i, s in enumerate(steps)}
    parts = {}
    for m in measures:
        parts[f"_a_{m.name}"] = _agg(m.how, F.when(F.col("_role") == 0, F.col(f"_m_{m.name}"))).over(ahead)
    for m, s in wanted:
        parts[f"_b_{m.name}_{s}"] = _agg(m.how, F.when(F.col("_role") == role[s], F.col(f"_m_{m.name}"))).over(behind)
    rows = rows.withColumns(parts).filter("_role = 0")
    rows = same_key(rows, whole, [*keys, "_cell"])
    results = {
        f"{m.name}_{s}": _combine(
            m.how,
            [F.col(f"_a_{m.name}"), F.col(f"_b_{m.name}_{s}")]
            + ([F.col(f"_w_{m.name}_{s}")] if steps[s] > 1 else []),
        )
        for m, s in wanted
    }
    return rows.select(*[F.col(c) for c in df.columns], *[v.alias(k) for k, v in results.items()])


def running(
    df: DataFrame,
    keys: list[str],
    measures: list[Measure],
    *,
    order: list[str] | None = None,
    source: DataFrame | None = None,
    peers: bool = False,
) -> DataFrame:
    """Running sum or maximum per key up to and including each row, in (`_cell`, *order*) order.

    With `peers`, rows equal in the first order column share one value. Also adds `<name>_all`, the key's total.
    """
    source = df if source is None else source
    order = order or ["_us", "transaction_id"]
    cells = source.groupBy(*keys, "_cell").agg(*[_agg(m.how, m.value).alias(m.name) for m in measures])
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    carried = cells.select(
        *keys,
        "_cell",
        *[
            _agg(m.how, m.name).over(by_key.orderBy("_cell").rowsBetween(UNBOUNDED, -1)).alias(f"_c_{m.name}")
            for m in measures
        ],
        *[_agg(m.how, m.name).over(by_key).alias(f"{m.name}_all") for m in measures],
    )
    within = Window.partitionBy(*keys, "_cell")
    within = (
        within.orderBy(order[0]).rangeBetween(UNBOUNDED, 0)
        if peers
        else within.orderBy(*order).rowsBetween(UNBOUNDED, 0)
    )
    rows = df.withColumns({f"_l_{m.name}": _agg(m.how, m.value).over(within) for m in measures})
    rows = same_key(rows, carried, [*keys, "_cell"])
    return rows.select(
        *[F.col(c) for c in df.columns],
        *[_combine(m.how, [F.col(f"_l_{m.name}"), F.col(f"_c_{m.name}")]).alias(m.name) for m in measures],
        *[f"{m.name}_all" for m in measures],
    )


SLICE_ROWS = 100_000


def number_rows(
    df: DataFrame, keys: list[str], *, order: list[str] | None = None, source: DataFrame | None = None, name: str = "account_row"
) -> DataFrame:
    """Position of each row in its key, from 1, in (`_cell`, *order*) order."""
    return running(df, keys, [Measure(name, F.lit(1))], order=order, source=source).drop(f"{name}_all")


def over_neighbours(
    df: DataFrame,
    keys: list[str],
    n: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    *,
    place: str = "account_row",
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Window columns that look back up to n rows of the key; each is built from the window it is given.

    Rows are numbered already, so a key is cut into slices of `rows` rows, and the last n rows of a slice also go to
    the next one, where they serve as neighbours only. No task ever sorts more than rows + n rows of a key.
    """
    if n > rows:
        raise ValueError("a slice must hold at least the rows looked back on")
    before = F.col(place) - 1
    home = F.floor(before / rows)
    serves_next = before % rows >= rows - n
    slices = F.explode(F.when(serves_next, F.array(home, home + 1)).otherwise(F.array(home)))
    spread = df.withColumn("_slice", slices).withColumn("_own", F.col("_slice") == home)
    w = Window.partitionBy(*keys, "_slice").orderBy(place)
    return spread.withColumns({k: f(w) for k, f in columns.items()}).filter("_own").drop("_slice", "_own")


def key_totals(source: DataFrame, keys: list[str], aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Totals of a key attached to each of its cells: joins to rows by (key, cell), never by a hot key alone."""
    cells = source.groupBy(*keys, "_cell").agg(*[_agg(how, v).alias(k) for k, (how, v) in aggs.items()])
    whole = Window.partitionBy(*keys)
    return cells.select(*keys, "_cell", *[_agg(how, k).over(whole).alias(k) for k, (how, _) in aggs.items()])


def distinct_per_key(source: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Exact number of distinct non-null values of each column per key; values are reduced before keys meet."""
    out = None
    for name, c in columns.items():
        one = (
            source.select(key, c)
            .distinct()
            .groupBy(key)
            .agg(F.count(c).alias(name))
        )
        out = one if out is None else out.join(one, key)
    return out


def rank_average(df: DataFrame, keys: list[str], value: str, *, source: DataFrame | None = None) -> DataFrame:
    """Per (key, value): rows below, rows equal and rows in all; enough for ranks with ties averaged. Nulls have none."""
    source = df if source is None else source
    counts = source.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_equal"))
    ranked = running(ranged(counts, [*keys, value]), keys, [Measure("_upto", F.col("_equal"))], order=[value])
    return ranked.select(
        *keys, value, "_equal", (F.col("_upto") - F.col("_equal")).alias("_below"), F.col("_upto_all").alias("_rows")
    )


def percentile_rank(df: DataFrame, key: str, value: str, name: str, *, source: DataFrame | None = None) -> DataFrame:
    """Rank within the key divided by the key's rows, ties averaged."""
    ranks = rank_average(df, [key], value, source=source).select(
        key, value, ((F.col("_below") + (F.col("_equal") + 1) / 2) / F.col("_rows")).alias(name)
    )
    return same_key(df, ranks, [key, value])


def at_shares(counts: DataFrame, keys: list[str], value: str, shares: list[float], n: str = "n") -> DataFrame:
    """Per key the neighbours of the positions share * (rows - 1): `lo_<i>`, `hi_<i>`, how far between as `part_<i>`, `rows`.

    `counts` has a row per (key, value) with its number of rows. Ranges of values are added up, and only those that hold
    a wanted position are looked into; the others are never sorted.
    """
    dealt = ranged(counts, [*keys, value])
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    cells = dealt.groupBy(*keys, "_cell").agg(F.sum(n).alias("_s"))
    cells = cells.withColumns(
        {
            "_base": F.coalesce(F.sum("_s").over(by_key.orderBy("_cell").rowsBetween(UNBOUNDED, -1)), F.lit(0)),
            "_all": F.sum("_s").over(by_key),
        }
    )
    at = [(F.col("_all") - 1) * F.lit(float(p)) for p in shares]
    ends = F.array(*[e for x in at for e in (F.floor(x), F.ceil(x))])
    wanted = F.exists(ends, lambda e: (e >= F.col("_base")) & (e < F.col("_base") + F.col("_s")))
    inside = same_key(dealt, cells.where(wanted).drop("_s"), [*keys, "_cell"], "inner")
    w = Window.partitionBy(*keys, "_cell").orderBy(value).rowsBetween(UNBOUNDED, 0)
    inside = inside.withColumn("_upto", F.col("_base") + F.sum(n).over(w))
    found = [F.max("_all").alias("rows")]
    for i, x in enumerate(at):
        found.append(F.min(F.when(F.col("_upto") > F.floor(x), F.col(value))).alias(f"lo_{i}"))
        found.append(F.min(F.when(F.col("_upto") > F.ceil(x), F.col(value))).alias(f"hi_{i}"))
        found.append(F.max(x - F.floor(x)).alias(f"part_{i}"))
    return inside.groupBy(*keys).agg(*found)


def quantile(df: DataFrame, value: str, p: float, name: str = "q") -> DataFrame:
    """Exact quantile with linear interpolation of the finite values, as one row."""
    present = df.select(finite(F.col(value)).alias("_v")).filter("_v is not null")
    found = at_shares(present.groupBy("_v").agg(F.count(F.lit(1)).alias("n")), [], "_v", [p])
    return found.select((F.col("lo_0") + (F.col("hi_0") - F.col("lo_0")) * F.col("part_0")).alias(name))
