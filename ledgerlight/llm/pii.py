"""Personal data: base patterns, and further identifiers found by bootstrapped contexts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.session import cut

KINDS = ("email", "ip", "card", "phone")
# Possessive and anchored at the start of a run of its characters, so that no text makes them slow; the matches are those
# of the plain patterns, leftmost and without overlap. Runs of fewer than 16 digits are no cards, so they need no match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
# What may be an identifier without being a base one: digits with separators, and names at a host without a domain.
LOOSE = r"(?<![0-9A-Za-z.(+-])\(?[0-9][\x20().0-9-]{3,}[0-9]|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
LOOSE_GUARD = r"[0-9][\x20().0-9-]{3}|@"
WIDTHS = (48, 1_024, 32_768)  # code points looked at first for a context's words; more only where a word reaches further
LEAST_SEEDS = 3  # distinct known identifiers of a kind that a context needs
LEAST_PATTERN = 0.75  # share of a context's identifiers that are of its kind
LEAST_INSTANCE = 0.9


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """What a match has to fulfil besides its pattern; failing matches are dropped and not tried again."""
    if kind == "ip":
        # Leading zeros say nothing; more than three digits without them are over 255.
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False)))
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def spans(text: Column, pattern: str, guard: str) -> Column:
    """Array of (start, end, value) of a pattern's matches, in code points from 0, end exclusive."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(values, F.length)

    def place(value: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(gaps, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x) + F.aggregate(
            F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, x: a + x
        )
        return F.struct(before.alias("start"), (before + F.length(value)).alias("end"), value.alias("value"))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(guard), F.transform(values, place)).otherwise(empty)


def _valid_spans(text: Column, kind: str) -> Column:
    return F.filter(spans(text, PATTERNS[kind], GUARDS[kind]), lambda s: valid(kind, s["value"]))


def _before(text: Column, start: Column, words: str) -> Column:
    """The last words that end before `start`, whole however long they are; null without them."""

    def within(begin: Column) -> Column:
        piece = F.substring(text, begin + 1, start - begin)
        piece = F.when(begin == 0, F.concat(F.lit(" "), piece)).otherwise(piece)
        return F.nullif(F.regexp_extract(piece, rf"[\x20\x09-\x0D]({words})[\x20\x09-\x0D]*+$", 1), F.lit(""))

    return F.coalesce(*[within(F.greatest(start - w, F.lit(0))) for w in WIDTHS], within(F.lit(0)))


def _after(text: Column, end: Column) -> Column:
    """The first word from `end` on, whole however long it is; null without one."""

    def within(width: Column) -> Column:
        piece = F.substring(text, end + 1, width)
        piece = F.when(F.length(piece) < width, F.concat(piece, F.lit(" "))).otherwise(piece)
        return F.nullif(F.regexp_extract(piece, r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)[\x20\x09-\x0D]", 1), F.lit(""))

    return F.coalesce(*[within(F.lit(w)) for w in WIDTHS], within(F.lit(2**31 - 1)))


def _context(text: Column, start: Column, end: Column) -> list[Column]:
    """Two lexical patterns: the two words before, and the word on either side; digits count alike."""
    word = r"[^\x20\x09-\x0D]++"
    two = F.concat(_before(text, start, word + r"[\x20\x09-\x0D]++" + word), F.lit(" _"))
    around = F.concat(_before(text, start, word), F.lit(" _ "), _after(text, end))
    return [F.lower(F.regexp_replace(c, "[0-9]", "0")) for c in (two, around)]


def _fits(kind: Column, value: Column) -> Column:
    """Whether an unseen value has the shape of a kind."""
    n = F.length(_digits(value))
    at = value.contains("@")
    return (
        F.when(kind == "email", at)
        .when(kind == "ip", value.rlike(r"^[0-9]+(\.[0-9]+){3}$"))
        .when(kind == "card", ~at & n.between(12, 19))
        .when(kind == "phone", ~at & n.between(7, 15))
    )


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, base, loose) of every row: base spans with kind, and other possible identifiers, both with contexts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), text.alias("t"))
    rows = rows.withColumns({k: _valid_spans(F.col("t"), k) for k in KINDS})
    rows = rows.withColumn("other", spans(F.col("t"), LOOSE, LOOSE_GUARD))

    def told(kind: Column):
        return lambda s: F.struct(
            kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.array_compact(F.array(*_context(F.col("t"), s["start"], s["end"]))).alias("patterns")
        )

    base = F.concat(*[F.transform(F.col(k), told(F.lit(k))) for k in KINDS])
    rows = rows.withColumn("base", base)
    free = F.filter("other", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.select("id", "digest", "base", F.transform(free, told(F.lit(None).cast("string"))).alias("loose"))


def _value(kind: Column, value: Column) -> Column:
    """How instances are compared: without separators, names lower-cased."""
    return F.when(value.contains("@"), F.lower(value)).when((kind == "ip") | value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), value).otherwise(_digits(value))


def discover(found: DataFrame) -> DataFrame:
    """(instance, kind) of identifiers beyond the base ones, by scoring the graph of patterns and instances.

    Base identifiers are seeds with score 1. In each round a pattern's confidence in a kind is the sum of its instances'
    scores over the number of its distinct instances plus one; patterns with enough distinct instances of the kind
    and enough confidence vote, an unseen instance's score is the chance that not all of its patterns are wrong, and
    those with a high score join the known ones with it. Rounds go on until one accepts nothing new: what is accepted
    stays, so they end, after as many rounds as the longest chain of contexts has links. Edges are distinct
    (pattern, instance) pairs, counted before they move.
    """
    spark = found.sparkSession
    seen = found.select(F.explode(F.concat("base", "loose")).alias("s"))
    seen = seen.select(F.col("s.kind").alias("kind"), _value(F.col("s.kind"), F.col("s.value")).alias("instance"), F.col("s.value").alias("value"), F.explode("s.patterns").alias("pattern"))
    edges = cut(seen.groupBy("pattern", "instance").agg(F.min("kind").alias("kind"), F.min("value").alias("value")), "edges")
    known = edges.where("kind IS NOT NULL").select("instance", "kind").distinct()
    total = edges.groupBy("pattern").agg(F.count("*").alias("all"))
    scored = known.withColumn("score", F.lit(1.0))
    unseen = edges.where("kind IS NULL").select("pattern", "instance", "value").join(known.select("instance").distinct(), "instance", "left_anti")
    accepted = spark.createDataFrame([], "instance string, kind string, score double")
    while True:
        votes = edges.select("pattern", "instance").join(scored.union(accepted), "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count("*").alias("n"))
        votes = votes.where(F.col("n") >= LEAST_SEEDS).join(total, "pattern").withColumn("c", F.col("sum") / (F.col("all") + 1))
        votes = votes.where(F.col("c") >= LEAST_PATTERN).select("pattern", "kind", "c")
        scores = unseen.join(accepted.select("instance"), "instance", "left_anti").join(votes, "pattern").where(_fits(F.col("kind"), F.col("value")))
        scores = scores.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("c", F.lit(0.99)))))).alias("score"))
        best = scores.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b"))
        new = cut(best.select("instance", F.col("b.kind").alias("kind"), F.col("b.score").alias("score")).where(F.col("score") >= LEAST_INSTANCE), "accepted")
        if new.isEmpty():
            return accepted.select("instance", "kind")
        accepted = cut(accepted.union(new), "accepted")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, spans (array of kind, start, end, value, base) by kind, then start.

    All base spans of the whole text are there; spans that the bootstrapped contexts add never overlap one. Null texts
    are empty; rows that share an id are told apart by their text, equal rows get equal spans, a null id is an id;
    empty tables give no rows.
    """
    found = cut(occurrences(docs, id_col, text_col), "found")
    loose = found.select("id", "digest", F.explode("loose").alias("s")).distinct()
    loose = loose.withColumn("instance", _value(F.col("s.kind"), F.col("s.value")))
    loose = loose.join(discover(found), "instance").where(_fits(F.col("kind"), F.col("s.value")))
    span = F.struct(F.col("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.value").alias("value"), F.lit(False).alias("base"))
    # A document's added spans are bounded by its own text.
    more = loose.groupBy(F.col("id").alias("id2"), F.col("digest").alias("digest2")).agg(F.collect_set(span).alias("more"))
    own = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(True).alias("base")))
    rows = found.select("id", "digest", own.alias("own")).join(more, F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2")), "left")
    both = F.when(F.col("more").isNull(), F.col("own")).otherwise(F.concat("own", "more"))
    place = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])

    def order(a: Column, b: Column) -> Column:
        x, y = place[a["kind"]] * (1 << 40) + a["start"], place[b["kind"]] * (1 << 40) + b["start"]
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    return rows.select(F.col("id").alias(id_col), F.array_sort(both, order).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the hash of the base spans and all spans as text, from `personal_data`."""

    def joined(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{k}": count(k) for k in KINDS}
    return found.withColumns({**counts, "base_sha256": F.sha2(joined(base), 256), "spans": joined(F.col("spans"))})
