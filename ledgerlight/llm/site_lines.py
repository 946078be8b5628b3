"""Line dedup by site-relative frequency: lines that too many pages of a host share are dropped. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.session import cut

RATIO = 0.2  # share of a host's pages from which a line is boilerplate
LEAST_PAGES = 3  # pages of the host that have to share it at least
SLICE_PAGES = 1_000  # pages of a host that are joined together, about
HOT_HOSTS = 65_536  # a host is cut into slices only where it has more than this part of all pages, so they are no more
_BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"


def host(url: Column) -> Column:
    """Lower-cased host of a URL, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def html_lines(html: Column) -> Column:
    """Text lines of a page: without scripts, styles, comments and tags, a new line at each block, none empty."""
    text = F.coalesce(html, F.lit(""))
    for hidden in (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->"):
        text = F.regexp_replace(text, hidden, "")
    text = F.regexp_replace(text, rf"(?i)</?(?:{_BLOCKS})\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    return text_lines(text)


def text_lines(text: Column) -> Column:
    """Non-empty lines without outer white space."""
    lines = F.split(F.coalesce(text, F.lit("")), r"[\n\r]+")
    return F.filter(F.transform(lines, lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r"))), lambda x: x != "")


def slices(totals: DataFrame) -> DataFrame:
    """(host_hash, slices) of the hosts in (host, pages) that are cut: HOT_HOSTS rows at most, whatever the table's size."""
    pages = totals.agg(F.sum("pages")).first()[0] or 0
    most = max(SLICE_PAGES, math.ceil(pages / HOT_HOSTS))
    hot = totals.where(F.col("pages") > most).select(F.xxhash64("host").alias("host_hash"), F.ceil(F.col("pages") / most).cast("int").alias("slices"))
    return hot.groupBy("host_hash").agg(F.max("slices").alias("slices"))


def _sliced(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Adds `slices` to rows with a host: 1 unless it is hot."""
    joined = rows.withColumn("host_hash", F.xxhash64("host")).join(F.broadcast(hot), "host_hash", "left").drop("host_hash")
    return joined.withColumn("slices", F.coalesce("slices", F.lit(1)))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, boilerplate): hashes of the lines that more than `ratio` of the host's pages have, at least `least_pages`.

    `pages` has host and lines. A page counts a line once; counts are added up before they move, so a hot host or line
    is a partial sum. A host's array is bounded by its mean number of lines a page over `ratio`.
    """
    each = pages.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    common = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("line").alias("boilerplate"))


def without_boilerplate(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """One row per page: id, host, n_lines, n_dropped, text (the lines that stay, joined by newlines).

    A null or unreadable URL belongs to the host of no name, null pages have no lines, repeated rows count as pages of
    their own, an empty table gives no rows. Lines compare by a 64-bit hash. Pages meet their host's array in one join by
    host and slice: a hot host's pages are dealt to slices by id and content, and its array goes once to each.
    """
    rows = pages.select(
        F.col(id_col), host(F.col(url_col)).alias("host"), html_lines(F.col(html_col)).alias("lines"), F.xxhash64(id_col, html_col).alias("row_hash")
    )
    # Written, as the counts and the join both need the lines, and taking them out of the pages is most of the work.
    rows = cut(rows, "lines")
    totals = cut(rows.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    hot = cut(slices(totals), "hot")
    # Written, so that both sides of the join are plain exchanges: what is left of a skew is then split at run time.
    common = _sliced(cut(boilerplate(rows, ratio, least_pages), "boilerplate"), hot)
    common = common.select("host", "boilerplate", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    rows = _sliced(rows, hot).withColumn("slice", F.pmod("row_hash", "slices").cast("int")).drop("row_hash", "slices")
    joined = rows.join(common.hint("merge"), ["host", "slice"], "left")
    dropped = F.coalesce("boilerplate", F.array().cast("array<bigint>"))
    kept = F.filter("lines", lambda x: ~F.array_contains(dropped, F.xxhash64(x)))
    joined = joined.select(id_col, "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return joined.select(id_col, "host", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
