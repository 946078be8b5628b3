"""Mixing sources to target weights: whole epochs first, then Efraimidis-Spirakis sampling, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerlight.llm.native import word_count
from ledgerlight.session import cut

BAND_ROWS = 2_000  # rows that a band holds at least, about; there are no more bands than shuffle partitions
MOST_REPEATS = 3
WEIGHTS = (5, 2, 1)


def shape_weight(text: Column, size: Column) -> Column:
    """A document quality weight in (0, 1]: 1 for words of six characters on average, less the further away."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.coalesce(1 / (1 + F.abs(F.log(F.greatest(mean, F.lit(1.0)) / 6))), F.lit(0.25))


def exponential_key(id_col: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight for a u in (0, 1) drawn by hashing the id: the smallest keys are a weighted sample."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 12), 16, 10)
    return -F.log((drawn.cast("double") + 0.5) / float(2**48)) / F.greatest(weight, F.lit(1e-6))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, weight: Column | None, seed: str) -> DataFrame:
    """(row, id, source, size, key): each document as a struct, with its size in words and its sampling key."""
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.col(text_col).alias("text"),
        (F.lit(None) if weight is None else weight).cast("double").alias("weight"),
    )
    rows = rows.withColumn("size", word_count(F.col("text")))
    quality = F.coalesce("weight", shape_weight(F.col("text"), F.col("size")))
    return rows.select("row", "id", "source", "size", exponential_key(F.col("id"), quality, seed).alias("key"))


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, n) with each source's target; the only step that sees all sources together, a row each.

    Sources by code point, null last, have the weights in turn. Targets share the sum of all sizes by weight; none gets
    over `most` times its size. What is over goes to the others by weight, until none is above: the level at which the
    sources below their limit meet is found from running sums over the sources sorted by limit per weight.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(int(w)) for w in weights])
    rows = totals.withColumn("w", F.get(table, F.pmod(rank, F.lit(len(weights))))).withColumn("limit", F.col("source_size") * most)
    rows = rows.withColumn("turn", F.row_number().over(Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())))
    upto, whole = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"all": F.sum("source_size").over(whole), "weights": F.sum("w").over(whole)})
    rows = rows.withColumns({"full": F.coalesce(F.sum("limit").over(upto), F.lit(0)), "gone": F.coalesce(F.sum("w").over(upto), F.lit(0))})
    rows = rows.withColumn("level", (F.col("all") - F.col("full")) / (F.col("weights") - F.col("gone")))
    open_level = F.when(F.col("limit") / F.col("w") >= F.col("level"), F.struct("turn", "level"))
    rows = rows.withColumn("level", F.min(open_level).over(whole)["level"])
    return rows.select("source", "source_size", "n", F.least(F.col("limit").cast("double"), F.col("level") * F.col("w")).alias("target"))


def plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """How much of each source to take, a row per source, from narrow rows (id, source, size, key).

    epochs: whole passes; then the rows up to and including (key, id) = (cut_key, cut_id) once more. A source's rows are
    never sorted together: Spark draws the bounds of bands from the rows themselves, in the order of source, key and id,
    so bands are even however the keys are spread; their sums are added up, and a source sorts only the band in which
    its budget ends. Rows that share source, key and id are added up before.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = targets(totals, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("epochs", epochs.cast("long")).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goal = cut(goal, "targets")
    banded = bands(join_source(rows, goal.select("source", "rest")).where("rest > 0"), goal.agg(F.sum("n")).first()[0] or 0)
    sums = banded.groupBy("source", "band", "rest").agg(F.sum("s").alias("s"), F.max(F.struct("key", "id")).alias("last"))
    before = Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"base": F.coalesce(F.sum("s").over(before), F.lit(0)), "earlier": F.max("last").over(before)})
    ending = sums.where("base <= rest AND base + s > rest").select("source", F.col("band").alias("cut_band"), "base", "earlier")
    ending = cut(ending, "ending")
    inside = join_source(banded, ending.drop("earlier")).where("band = cut_band")
    upto = F.sum("s").over(Window.partitionBy("source").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("upto", F.col("base") + upto)
    taken = inside.where("upto <= rest OR (upto - s < rest AND upto - rest < rest - (upto - s))")
    ends = taken.groupBy("source").agg(F.max(F.struct("key", "id")).alias("end"))
    made = join_source(join_source(goal, ending.select("source", "earlier"), "left"), ends, "left").withColumn("end", F.coalesce("end", "earlier"))
    return cut(made.drop("earlier").withColumns({"cut_key": F.col("end.key"), "cut_id": F.col("end.id")}).drop("end"), "plan")


def bands(rows: DataFrame, n: int) -> DataFrame:
    """(source, key, id, rest, s, band): n rows by source, key and id, in bands of their order whose bounds come from the data."""
    tied = rows.groupBy("source", "key", "id", "rest").agg(F.sum("size").alias("s"))
    count = max(1, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / BAND_ROWS)))
    # Written, as bounds are drawn anew at each evaluation.
    return cut(tied.repartitionByRange(count, "source", "key", "id").withColumn("band", F.spark_partition_id()), "bands")


def join_source(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, where null equals null."""
    other = other.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def repeats(id_col: Column, key: Column) -> Column:
    """Times that a row, joined with its source's plan, is taken."""
    first = F.lit(-(2**63))
    upto = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (F.coalesce(id_col, first) <= F.coalesce("cut_id", first)))
    return F.col("epochs") + F.when((F.col("rest") > 0) & upto, 1).otherwise(0)


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: id, size (words), source_size, target (its source's words), taken (its own, repeats counted).

    A source's documents are first taken as often as they fit whole into its target, then in the order of their
    exponential keys, up to the one whose end is nearest to what is left. `weight` is a document quality weight (a
    column of docs); by default it comes from the text's shape. Everything follows from ids, texts and sources, so
    reruns agree. Null texts have size 0, a null source is a source, rows that share id and key are taken or left
    together, empty tables give no rows, and sources without words have a target of 0. Ids are longs.
    """
    rows = cut(sized(docs, id_col, text_col, source_col, weight, seed).drop("row"), "sizes")
    made = plan(rows, weights, most)
    out = join_source(rows, made)
    taken = (F.col("size") * repeats(F.col("id"), F.col("key"))).alias("taken")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", taken)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, seed: str = "mix", **options) -> DataFrame:
    """The mix itself: rows of docs, each as often as `mixed` takes it. Texts are not shuffled: the plan, a row per
    source, comes to them."""
    rows = sized(docs, id_col, text_col, source_col, weight, seed)
    made = plan(cut(rows.drop("row"), "sizes"), **options)
    out = join_source(rows, made.drop("source_size", "n", "target"))
    times = repeats(F.col("id"), F.col("key")).cast("int")
    return out.select("row", F.explode(F.array_repeat(F.lit(True), times)).alias("taken")).select("row.*")
