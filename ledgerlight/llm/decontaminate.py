"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerlight.llm.native import lower_ascii
from ledgerlight.session import cut

WINDOW = 13
SHINGLE = 5
BLOCK_SHINGLES = 500_000  # shingles or prefixes of the benchmark that are broadcast at once, some 40 bytes each
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and everything beyond ASCII."""
    parts = F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")
    return F.transform(parts, lower_ascii)


def _shingles(column: str, k: int) -> Column:
    """Hash of the k words from each position on; the last k - 1 positions have none."""
    following = "".join(f", get({column}, i + {j})" for j in range(1, k))
    return F.expr(f"slice(transform({column}, (x, i) -> xxhash64(x{following})), 1, greatest(size({column}) - {k - 1}, 0))")


def _windows(items: DataFrame, item_id: str, item_text: str, window: int, shingle: int) -> DataFrame:
    """(item, len, k, hs): each window of an item with the hashes of its k-word shingles."""
    split = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(item_text)).alias("w")).where("size(w) > 0")
    spread = split.select("item", F.least(F.size("w"), F.lit(window)).alias("len"), "w")
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1))
    cutout = spread.select("item", "len", F.least("len", F.lit(shingle)).alias("k"), "w", starts.alias("s"))
    cutout = cutout.select("item", "len", "k", F.slice("w", F.col("s"), F.col("len")).alias("w"))
    hashes = F.when(F.col("k") == shingle, _shingles("w", shingle))
    for k in range(1, shingle):
        hashes = hashes.when(F.col("k") == k, _shingles("w", k))
    return cutout.select("item", "len", "k", hashes.alias("hs")).distinct()


def _shingled(docs: DataFrame, id_col: str, text_col: str, sizes: list[int]) -> DataFrame:
    """(id, digest, n, hs<k> for each k) of every row, written: its number of words and the hashes of its k-word shingles."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), words(F.col(text_col)).alias("w"))
    return cut(texts.select("id", "digest", F.size("w").alias("n"), *[_shingles("w", k).alias(f"hs{k}") for k in sizes]), "shingled")


def _in_blocks(table: DataFrame, n: int, by: str) -> list[DataFrame]:
    """A table of n rows as broadcasts of about BLOCK_SHINGLES rows at most, dealt by a hash."""
    blocks = max(1, math.ceil(n / BLOCK_SHINGLES))
    return [F.broadcast(table.where(F.pmod(F.col(by), F.lit(blocks)) == block)) for block in range(blocks)]


def _rows_by_k(table: DataFrame) -> dict[int, int]:
    return {r["k"]: r["n"] for r in table.groupBy("k").agg(F.count("*").alias("n")).collect()}  # at most `shingle` rows


def _union(parts: list[DataFrame]) -> DataFrame:
    for part in parts[1:]:
        parts[0] = parts[0].union(part)
    return parts[0]


def _occurrences(texts: DataFrame, wins: DataFrame) -> DataFrame:
    """(id, digest, start, len, item) of every window in the shingled texts; there is at least one window."""
    tokens = cut(wins.select("k", F.explode("hs").alias("h")).distinct(), "shingles")
    # Rarity: how often the documents have each shingle of the benchmark; counted where they are, so only counts move.
    counts = []
    for k, n in sorted(_rows_by_k(tokens).items()):
        for block in _in_blocks(tokens.where(F.col("k") == k), n, "h"):
            counts.append(texts.select(F.explode(f"hs{k}").alias("h")).join(block, "h").groupBy("k", "h").agg(F.count("*").alias("df")))
    rarity = cut(_union(counts), "rarity")

    # The necessary prefix of a window is its rarest shingle; a window with one that no document has cannot occur.
    each = wins.select("win", "len", "k", "hs").distinct()
    spread = each.select("win", F.size("hs").alias("m"), "len", "k", F.posexplode("hs").alias("off", "h")).join(rarity, ["k", "h"], "left")
    order = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "off")
    prefix = spread.groupBy("win", "len", "m", "k").agg(F.min(order).alias("p")).where("p.df > 0")
    prefix = cut(prefix.select("win", "len", "m", "k", F.col("p.h").alias("h"), F.col("p.off").alias("off")), "prefix")

    # Only prefixes meet the documents. Where one is found, the window has to fit between the text's ends around it, and
    # the text's shingles there have to be the window's.
    found = []
    for k, n in sorted(_rows_by_k(prefix).items()):
        hits = texts.select("id", "digest", "n", F.col(f"hs{k}").alias("hs"), F.posexplode(f"hs{k}").alias("pos", "h"))
        for block in _in_blocks(prefix.where(F.col("k") == k), n, "win"):
            met = hits.join(block, "h").withColumn("start", F.col("pos") - F.col("off")).where("start >= 0 AND start + len <= n")
            whole = F.slice("hs", F.greatest(F.col("start") + 1, F.lit(1)), F.col("m"))
            found.append(met.where(F.xxhash64(whole, "len") == F.col("win")).select("id", "digest", "start", "len", "win"))
    none = prefix.select(F.lit(None).cast(texts.schema["id"].dataType).alias("id"), F.lit(0).cast("long").alias("digest"), F.lit(0).alias("start"), "len", "win").where("false")
    found = _union([none, *found]).distinct()
    return found.join(wins.select("win", "item").distinct(), "win").select("id", "digest", "start", "len", "item")


def _found(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The shingled texts and the occurrences in them."""
    wins = cut(_windows(items, item_id, item_text, window, shingle).withColumn("win", F.xxhash64("hs", "len")), "windows")
    texts = _shingled(docs, id_col, text_col, sorted(_rows_by_k(wins)))
    if len(texts.columns) > 3:
        return texts, _occurrences(texts, wins)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("len", "int"), ("item", "string"))]
    return texts, texts.select("id", "digest", *nothing).where("false")


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(id, digest, start, len, item): every occurrence of a window of an item among a document's words, from word `start`.

    An item's windows are its runs of `window` words, a shorter item is one window. A window is the set of its k-word
    shingles with their offsets, and must be contained whole, so one shingle of it, the rarest over all documents, is
    the necessary prefix. Texts are split and hashed once, into a table of shingle hashes; one aggregation over it counts
    the benchmark's shingles, then the prefixes alone are joined, and each hit is bounded by the text's ends and checked
    against the whole window in place. Both joins broadcast blocks of a fixed size; a larger benchmark reads the table of
    hashes once more for each block. Words compare by chained 64-bit hashes of their shingles.

    `digest` hashes the text: rows that share an id are told apart by it, equal rows are one. Null texts and null ids
    are an empty text and an id of its own; items with a null id match with a null item.
    """
    found = _found(docs, items, id_col, text_col, item_id, item_text, window, shingle)[1]
    return found.select(F.col("id").alias(id_col), "digest", "start", "len", "item")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 20, **options) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside any occurrence of a window), n_items, items_sha256, contaminated,
    and digest, the text's hash.

    A document is contaminated when n_hit > 0 and share * n_hit >= n_words. items_sha256 is the hash of the found items'
    ids, sorted as strings and joined by commas. Options go to `matches`, as do its rules for nulls and repeated rows;
    empty tables give no rows or no hits.
    """
    texts, found = _found(docs, items, id_col, text_col, **options)
    found = cut(found, "matches")
    earlier = Window.partitionBy("id", "digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("id", "digest", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    spans = spans.withColumn("covered", F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0))))
    hit = spans.groupBy("id", "digest").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("covered"))).alias("n_hit"))
    which = found.groupBy("id", "digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = hit.join(which, hit["id"].eqNullSafe(which["id"]) & (hit["digest"] == which["digest"])).select(
        hit["id"].alias("id"), hit["digest"].alias("digest"), "n_hit", "items"
    )
    rows = texts.select(F.col("id").alias("row_id"), F.col("digest").alias("row_digest"), F.col("n").cast("long").alias("n_words"))
    rows = rows.join(found, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_digest") == F.col("digest")), "left")
    hits = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        F.col("row_id").alias(id_col),
        "n_words",
        hits.alias("n_hit"),
        F.greatest(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((hits > 0) & (hits * share >= F.col("n_words"))).alias("contaminated"),
        F.col("row_digest").alias("digest"),
    )
