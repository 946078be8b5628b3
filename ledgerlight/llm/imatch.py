"""I-Match fingerprints: terms of a middle idf band, sorted, hashed over several randomised lexicon subsets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm import text

LOW, HIGH = 0.0005, 0.1  # share of documents that a lexicon term is in
SUBSETS = 16
RATES = tuple(0.5 / 4**k for k in range(6))  # shares of the lexicon that a subset keeps, one for each scale
SLICE_ROWS = 500
MOST_SLICES = 100_000
LEAST_ID = -(2**63)
_U = np.uint64
_SEEDS = text.mix(np.arange(1, SUBSETS + 1, dtype=np.uint64))[:, None]
_LIMITS = [_U(int(rate * 2**64)) for rate in RATES]


def terms(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For chunks of rows: the first row's number and each row's distinct terms as ascending hashes.

    A term is a run of letters and digits (everything beyond ASCII counts as a letter), A-Z lower-cased.
    """
    raw, at = text.buffers(column)
    for first, last in text.chunks(at):
        hashes, ranges = text.word_hashes(raw, at[first : last + 1], text.NO_WORD)
        yield first, [np.unique(hashes[a:b]) for a, b in zip(ranges[:-1], ranges[1:], strict=True)]


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets in terms(batch.column("text")):
            found, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["term", "n"])


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Hashes of the terms whose document frequency, over all documents, is in the band; ascending.

    At least two documents have to have a term. The size is bounded at any number of documents: there are at most
    (mean distinct terms of a document) / low such terms, so the lexicon fits into the tasks' closures.
    """
    total = docs.count()
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_presence, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = counted.where((F.col("n") >= max(2.0, low * total)) & (F.col("n") <= max(2.0, high * total)))
    return np.sort(np.array([r["term"] for r in kept.select("term").collect()], dtype=np.int64).view(np.uint64))


def fingerprint(found: np.ndarray, words: np.ndarray, whole: str) -> np.ndarray:
    """The fingerprint of ascending term hashes: a 16-bit number per scale and subset, 0 where the subset has no term.

    Texts without a lexicon term have the 16 numbers of the text's SHA-256 instead.
    """
    if len(words) and len(found):
        at = np.minimum(np.searchsorted(words, found), len(words) - 1)
        found = found[words[at] == found]
    else:
        found = found[:0]
    if not len(found):
        return np.frombuffer(hashlib.sha256(whole.encode("utf-8", "surrogatepass")).digest(), dtype=np.uint16)
    drawn = text.mix(found[None, :] ^ _SEEDS)
    value = text.mix(found)[None, :]
    out = np.zeros((len(_LIMITS), SUBSETS), dtype=np.uint16)
    for scale, limit in enumerate(_LIMITS):
        inside = drawn < limit
        # The terms are sorted and distinct, so the sum of their hashes stands for the list.
        sums = text.mix(np.where(inside, value, _U(0)).sum(axis=1, dtype=np.uint64) + _SEEDS[:, 0])
        out[scale] = np.where(inside.any(axis=1), sums.astype(np.uint16) | np.uint16(1), 0)
    return out.ravel()


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of equal subset hashes among the subsets that have a term, at the scale where it is largest.

    A scale counts if at least a quarter of its subsets have terms (for very short texts: the first scale).
    """
    if np.array_equal(one, two):
        return 1.0
    if len(one) != len(two) or len(one) != len(_LIMITS) * SUBSETS:
        return 0.0
    a, b = one.reshape(-1, SUBSETS), two.reshape(-1, SUBSETS)
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    counts = used >= SUBSETS // 4
    counts[0] = True
    return float((same[counts] / np.maximum(used[counts], 1)).max())


def as_text(value: np.ndarray) -> str:
    return value.astype(">u2").tobytes().hex()


def _prints(texts: list[str], words: np.ndarray) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for first, sets in terms(pa.array(texts, pa.large_string())):
        out += [fingerprint(s, words, texts[first + k]) for k, s in enumerate(sets)]
    return out


def fingerprints(docs: DataFrame, words: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row: whole texts, null as empty, equal texts alike, one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _prints([t or "" for t in batch.column("text").to_pylist()], words)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([as_text(x) for x in found], pa.string())], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fingerprint string").withColumnRenamed("id", id_col)


def _bounds(ids: DataFrame, rows: int) -> np.ndarray:
    """Some ids of the table, the smallest among them, about evenly spaced: a slice begins at each. At most MOST_SLICES."""
    least, total = ids.agg(F.min("id"), F.count("*")).first()
    if not total:
        return np.zeros(0, dtype=np.int64)
    slices = min(MOST_SLICES, max(1, total // rows))
    share = int(2**32 * min(1.0, 4 * slices / total))
    drawn = ids.where(F.pmod(F.xxhash64("id"), F.lit(2**32)) < share).distinct().collect() if slices > 1 else []
    drawn = sorted(r["id"] for r in drawn)[3::4]
    return np.unique(np.array([least, *drawn], dtype=np.int64))


def edited(docs: DataFrame, words: np.ndarray, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Every row with its own, its edited text's and the next document's fingerprint compared.

    The next document is the one with the next smaller id, for the last one the first; the edited text is the text with
    its last floor(n / 2) code points replaced by as many (or all) of the next document's first. Rows with equal ids go
    by text; null ids come last and null texts are empty. One exchange by slices of neighbouring ids: the row at which a
    slice begins goes to the slice before as well, where the next of it is; no task gets more than a slice's rows
    together, and these stream through it. Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next; an empty table gives no rows. Ids are longs.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = _bounds(rows.select("id"), slice_rows)
    most = rows.agg(F.max("id")).first()[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                some = batch.slice(a, 500)
                own = np.asarray(some.column("id"))
                at = np.searchsorted(bounds, own, side="right") - 1
                begins = bounds[at] == own
                # Each row: to its slice, where it takes its next unless it is the first; those to the slice before.
                # The table's largest id goes to slice -1 too, as the next of the smallest.
                around = own == most
                pick = np.concatenate([np.arange(len(own)), np.flatnonzero(begins), np.flatnonzero(around)])
                where = np.concatenate([at, at[begins] - 1, np.full(around.sum(), -1)])
                takes = np.concatenate([~begins, np.ones(begins.sum(), dtype=bool), np.zeros(around.sum(), dtype=bool)])
                last = np.concatenate([np.zeros(len(own) + begins.sum(), dtype=bool), np.ones(around.sum(), dtype=bool)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(where.astype(np.int64)),
                        pa.array(last),
                        pa.array(takes),
                        *[some.column(c).take(pa.array(pick)) for c in ("doc", "id", "text")],
                    ],
                    names=["slice", "last", "takes", "doc", "id", "text"],
                )

    dealt = rows.mapInArrow(deal, "slice long, last boolean, takes boolean, doc long, id long, text string")
    dealt = dealt.repartition("slice").sortWithinPartitions("slice", "last", F.col("id").desc(), "text")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for a in range(0, len(batch), 500):
                some = batch.slice(a, 500)
                columns = [some.column(c).to_pylist() for c in ("slice", "takes", "doc", "text")]
                out: list[tuple] = []
                texts: list[str] = []
                for row in zip(*columns, _prints(columns[3], words), strict=True):
                    if held is not None and held[1] and held[0] == row[0]:
                        half = len(held[3]) // 2
                        texts.append(held[3][: len(held[3]) - half] + row[3][:half])
                        out.append((held[2], len(held[3]), held[4], row[4]))
                    held = row
                if not out:
                    continue
                found = _prints(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], pa.int64()),
                        pa.array([o[1] for o in out], pa.int64()),
                        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]),
                        pa.array([as_text(o[2]) for o in out]),
                        pa.array([as_text(x) for x in found]),
                        pa.array([likeness(o[2], x) for o, x in zip(out, found, strict=True)], pa.float64()),
                        pa.array([likeness(o[2], o[3]) for o in out], pa.float64()),
                    ],
                    names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(pair, schema).withColumnRenamed("id", id_col)
