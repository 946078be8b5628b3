"""Collocations: phrases counted exactly in counting quotient filters of packed word ids, merged shard by shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.llm import text
from ledgerlight.llm.quotient import Filter, Packing, permute
from ledgerlight.session import cut

LEAST = 100
LONGEST = 5
TOP = 2000
DICTIONARY = 2_000_000  # frequent words that a pass over the texts looks up
FILTER_KEYS = 500_000  # distinct keys that a task gathers before it hands them on, about
SHARD_KEYS = 500_000  # occurrences for each shard of the filters
TABLE_BITS = 26  # a table of frequent shorter phrases has 2 ** 26 bits at most

_U = np.uint64
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[ord(c) for c in ".,;:!?"] + [*range(10, 14)]] = True
BETWEEN = BREAKS.copy()
BETWEEN[[32, 9]] = True


def _words(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of rows: their range, the bytes, first and last byte of each word, each row's range, keys of (lang, word)."""
    raw, at = text.buffers(batch.column("t"))
    langs = np.asarray(batch.column("lang_hash")).view(np.uint64)
    for a, b in text.chunks(at):
        data, first, last, ranges = text.word_spans(raw, at[a : b + 1], BETWEEN)
        keys = text.mix(text.span_hashes(data, first, last) ^ np.repeat(text.mix(langs[a:b]), np.diff(ranges)))
        yield a, b, data, first, last, ranges, keys


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ _U(1))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[at], (np.add.reduceat(counts[order], at) if len(at) else counts[:0])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, f) of a task's words; all words of a language as (lang, f) without a key."""
    totals: dict[str, int] = {}
    held = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def out(lang: list, keys: np.ndarray | None, counts: np.ndarray) -> pa.RecordBatch:
        key = pa.nulls(len(counts), pa.int64()) if keys is None else pa.array(keys.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), key, pa.array(counts, pa.int64())], names=["lang", "key", "f"])

    for batch in batches:
        langs = batch.column("lang")
        for a, b, _, _, _, ranges, keys in _words(batch):
            for lang, n in zip(langs.slice(a, b - a).to_pylist(), np.diff(ranges).tolist(), strict=True):
                totals[lang] = totals.get(lang, 0) + n
            own = np.unique(keys, return_counts=True)
            held = _summed(np.concatenate((held[0], own[0])), np.concatenate((held[1], own[1])))
            if len(held[0]) > FILTER_KEYS:
                yield out([None] * len(held[0]), *held)
                held = held[0][:0], held[1][:0]
        if len(totals) > FILTER_KEYS:
            yield out(list(totals), None, np.array(list(totals.values()), dtype=np.int64))
            totals = {}
    yield out([None] * len(held[0]), *held)
    yield out(list(totals), None, np.array(list(totals.values()), dtype=np.int64))


ENCODED = "lang_hash long, lang string, t string, ids array<{0}>, id {0}, key long, word string"


def _encoder(known: np.ndarray, offset: int, more: bool, last_pass: bool, kind: pa.DataType) -> Callable:
    """Ids of the words in `known`; each task also names those it meets, once, as rows with an id.

    Before the last pass `ids` has a place for each word, -1 for words not met yet. The last pass makes each text a run of
    ids in which -1 stands for other words, ends of pieces and the end of the text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = np.zeros(len(known), dtype=bool)
        for whole in batches:
            batch = whole
            if more:
                carried = np.asarray(whole.column("id").is_valid())
                if carried.any():
                    yield whole.filter(pa.array(carried))
                    batch = whole.filter(pa.array(~carried))
            for a, b, data, first, last, ranges, keys in _words(batch):
                at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                hit = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
                ids = np.where(hit, at + offset, -1)
                if more:
                    ids = np.maximum(ids, np.asarray(batch.column("ids").slice(a, b - a).flatten()))
                new, where = np.unique(at[hit], return_index=True)
                where = np.flatnonzero(hit)[where[~named[new]]]
                if len(where):
                    named[at[where]] = True
                    row = np.searchsorted(ranges, where, side="right") - 1
                    low = text.LOWER[data].tobytes()
                    words = [low[p : q + 1].decode("utf-8", "replace") for p, q in zip(first[where].tolist(), last[where].tolist(), strict=True)]
                    n = len(where)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.nulls(n, pa.int64()), batch.column("lang").slice(a, b - a).take(pa.array(row)), pa.nulls(n, pa.string()),
                            pa.nulls(n, pa.list_(kind)), pa.array(at[where] + offset, kind), pa.array(known[at[where]].view(np.int64)),
                            pa.array(words, pa.string()),
                        ],
                        names=["lang_hash", "lang", "t", "ids", "id", "key", "word"],
                    )
                if last_pass and len(ids):
                    breaks = np.cumsum(BREAKS[data])
                    ends = np.ones(len(ids), dtype=bool)
                    ends[:-1] = breaks[first[1:]] > breaks[last[:-1]]
                    ends[ranges[1:][np.diff(ranges) > 0] - 1] = True
                    places = np.arange(len(ids)) + np.cumsum(ends) - ends
                    spread = np.full(len(ids) + int(ends.sum()), -1, dtype=np.int64)
                    spread[places] = ids
                    edges = np.concatenate((places, [len(spread)]))[ranges]
                    keep = spread >= 0
                    keep[1:] |= spread[:-1] >= 0
                    upto = np.concatenate(([0], np.cumsum(keep)))
                    ids, ranges = spread[keep], upto[edges]
                n = b - a
                lists = pa.ListArray.from_arrays(pa.array(ranges.astype(np.int32)), pa.array(ids, kind))
                texts = pa.nulls(n, pa.string()) if last_pass else batch.column("t").slice(a, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang_hash").slice(a, n), batch.column("lang").slice(a, n), texts, lists, pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())],
                    names=["lang_hash", "lang", "t", "ids", "id", "key", "word"],
                )

    return encode


def _gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(ids[0]), dtype=np.uint64)
    for x in ids:
        out = permute(out + x.astype(np.uint64) + _U(1), 64)
    return out


def _frequent(table: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """Whether the table may hold these phrases: never false for one that it holds."""
    at = _gram_hash(ids) >> _U(65 - len(table).bit_length() - 6)
    return (table[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) == 1


def _gram_counter(packing: Packing, shard_bits: int, table: np.ndarray | None) -> Callable:
    n = packing.n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filter.empty(packing)

        def out(found: Filter) -> pa.RecordBatch:
            rows = [(k, len(f), f.payload(k, shard_bits)) for k, f in found.shards(shard_bits)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            kinds = [pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "keys", "payload"])

        for batch in batches:
            whole = np.asarray(batch.column("ids").flatten())
            for begin in range(0, len(whole), FILTER_KEYS):
                flat = whole[begin : begin + FILTER_KEYS + n - 1]
                size = len(flat) - n + 1
                if size < 1:
                    continue
                at = np.flatnonzero(np.logical_and.reduce([flat[j : j + size] >= 0 for j in range(n)]))
                if table is not None and len(at):
                    at = at[_frequent(table, [flat[at + j] for j in range(n - 1)])]
                    at = at[_frequent(table, [flat[at + j] for j in range(1, n)])]
                if not len(at):
                    continue
                own = Filter.of(packing, packing.pack([flat[at + j] for j in range(n)]), np.ones(len(at), dtype=np.int64))
                held = Filter.merged(packing, [held, own])
                if len(held) > FILTER_KEYS:
                    yield out(held)
                    held = Filter.empty(packing)
        yield out(held)

    return count


def _merger(packing: Packing, shard_bits: int, least: int, kind: pa.DataType) -> Callable:
    def merge(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        held, waiting, size = Filter.empty(packing), [], 0
        for payload in rows.column("payload"):
            waiting.append(Filter.read(packing, shard, shard_bits, payload.as_py()))
            size += len(waiting[-1])
            if size > SHARD_KEYS:
                held, waiting, size = Filter.merged(packing, [held, *waiting]), [], 0
        held = Filter.merged(packing, [held, *waiting])
        often = held.counts >= least
        ids = packing.unpack([x[often] for x in held.limbs])
        flat = np.stack(ids, axis=1).ravel() if len(ids) else np.zeros(0, dtype=np.int64)
        at = np.arange(int(often.sum()) + 1, dtype=np.int32) * packing.n
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat, kind))
        return pa.Table.from_arrays([lists, pa.array(held.counts[often])], names=["g", "f"])

    return merge


def _bit_table(level: DataFrame, n: int, count: int) -> np.ndarray:
    """A table of bits that holds every phrase of the level; its size is bounded, others may seem to be in it."""
    bits = min(max((32 * count).bit_length(), 10), TABLE_BITS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("g").flatten()).reshape(-1, n)
            at = _gram_hash([ids[:, j] for j in range(n)]) >> _U(64 - bits)
            slots = (at >> _U(6)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array((_U(1) << (at & _U(63))).view(np.int64))], names=["slot", "bits"])

    rows: pd.DataFrame = level.select("g").mapInArrow(mark, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[rows["slot"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return table


def _encoded(rows: DataFrame, words: DataFrame, count: int, dictionary: int) -> tuple[DataFrame, str]:
    """The texts as ids of frequent words and the rows that name the ids, in as many passes as the dictionary needs."""
    kind = "int" if count < 1 << 31 else "long"
    arrow = pa.int32() if kind == "int" else pa.int64()
    passes = max(1, -(-count // dictionary))
    offset = 0
    for k in range(passes):
        part = words.where(F.pmod("key", F.lit(passes)) == k).select("key").toPandas()["key"].to_numpy(dtype=np.int64)
        known = np.sort(part.view(np.uint64))
        encoder = _encoder(known, offset, k > 0, k == passes - 1, arrow)
        rows = cut(rows.mapInArrow(encoder, ENCODED.format(kind)), "encoded")
        offset += len(known)
    return rows, kind


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int, dictionary: int = DICTIONARY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words; (id, lang, word, f) of frequent words; (g, f) of frequent phrases as arrays of ids."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(F.xxhash64(lang).alias("lang_hash"), lang.alias("lang"), F.col(text_col).cast("string").alias("t"))
    counted = cut(rows.mapInArrow(_count_words, "lang string, key long, f long"), "words")
    totals = counted.where("key IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    words = cut(counted.where("key IS NOT NULL").groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "frequent")
    count, occurrences = words.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    encoded, kind = _encoded(rows, words, count, dictionary)
    arrow = pa.int32() if kind == "int" else pa.int64()
    # A word of two languages is two keys, so the names of an id are all the same.
    names = encoded.where("id IS NOT NULL").groupBy("id").agg(F.any_value("key").alias("key"), F.any_value("lang").alias("lang"), F.any_value("word").alias("word"))
    named = cut(names.join(words, "key").drop("key"), "names")

    texts = encoded.where("ids IS NOT NULL").select("ids")
    shard_bits = max(0, (occurrences // SHARD_KEYS).bit_length())
    bits = max(1, count.bit_length())
    schema = f"g array<{kind}>, f long"
    levels, table = spark.createDataFrame([], schema), None
    for n in range(2, longest + 1):
        packing = Packing(n, bits)
        shards = texts.mapInArrow(_gram_counter(packing, shard_bits, table), "shard int, keys long, payload binary")
        level = cut(shards.groupBy("shard").applyInArrow(_merger(packing, shard_bits, least, arrow), schema), f"phrases{n}")
        found = level.count()
        if not found:
            break
        levels = levels.unionByName(level)
        if n < longest:
            table = _bit_table(level, n, found)
    return totals, named, levels


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    dictionary: int = DICTIONARY,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `longest` words with a >= `least`.

    Texts, A-Z lower-cased, are split at . , ; : ! ? and line breaks into pieces, these at spaces and tabs into words. A
    phrase's a is the number of its places inside pieces; cut in two, l and r are those of its parts, n that of all words
    of the language; the score is floor(1000 a n / (l r)) at the cut where it is least, the first of equal ones. Phrases
    inside a longer one that is as frequent are left out. Equal scores go by a, then by the phrase's bytes.

    Frequent words get ids, in as many passes over the texts as the dictionary needs. n-grams of their ids are packed,
    permuted and counted in a task's quotient filter, which goes out as shards of a range of quotients each; a shard's
    sorted filters are merged by one task. Nothing is estimated: only n-grams whose two shorter parts passed a table of
    the frequent ones are counted, and that table has no false negatives. Words are the same if their 64-bit hashes are.

    Null and empty texts have no words, a null language is `und`, repeated rows count as often as they stand there. An
    empty table and one without frequent phrases give no rows; further columns are ignored.
    """
    totals, words, levels = phrase_counts(docs, text_col, lang_col, least, longest, dictionary)
    found = levels.withColumnRenamed("f", "a")
    parts = levels.unionByName(words.select(F.array("id").alias("g"), "f"))

    size = F.size("g")
    cuts = found.select("g", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("slice(g, 1, k)"), "right": F.expr("slice(g, k + 1, size(g) - k)")})
    cuts = cuts.join(parts.select(F.col("g").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(parts.select(F.col("g").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.join(words.select(F.col("id").alias("first"), "lang"), F.element_at("g", 1) == F.col("first")).join(totals, "lang")

    def whole(c: str) -> Column:
        return F.col(c).cast("decimal(18,0)")

    cuts = cuts.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n"), "below": whole("l") * whole("r")})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    scored = cuts.groupBy("g", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # A phrase as frequent as a longer one is as frequent as the one a word longer inside that.
    inner = F.array(F.expr("slice(g, 1, size(g) - 1)"), F.expr("slice(g, 2, size(g) - 1)"))
    longer = found.where(size > 2).select(F.explode(inner).alias("g"), F.col("a").alias("longer")).groupBy("g").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, "g", "left").where("longer IS NULL OR longer < a")

    spelled = kept.select("g", F.posexplode("g").alias("place", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    phrase = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    rows = kept.join(spelled, "g").select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
