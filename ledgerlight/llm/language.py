"""Language identification by nearest centroids of TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm import text

FEATURES = 4096
GRAMS = (2, 3)
CENTROIDS = 4
SAMPLE = 2000  # labelled rows a language's centroids are fitted on, at most about
REJECT_SHARE = 0.0005  # of a language's own rows, those further away than all others set its limit
REJECT_SLACK = 0.6
_U = np.uint64
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] += 32
for _c in range(128):
    if not chr(_c).isalpha():
        _CLASS[_c] = 32


@dataclass
class Model:
    """Unit centroids (one row each), their language numbers, the languages, idf weights, least cosine per language."""

    centroids: np.ndarray
    owner: np.ndarray
    languages: list[str]
    idf: np.ndarray
    least: np.ndarray


def gram_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """For chunks of rows: the first row's number and a matrix of counts of hashed byte n-grams of the whole texts.

    A-Z are lower-cased; runs of bytes that are no letter count as one blank; texts begin and end with a blank.
    """
    raw, at = text.buffers(column)
    for first, last in text.chunks(at, text.CHUNK_BYTES // 2, 500):
        rows = last - first
        counts = np.zeros((rows, FEATURES), dtype=np.float32)
        for r in range(rows):
            part = _CLASS[raw[at[first + r] : at[first + r + 1]]]
            padded = np.full(len(part) + 2, 32, dtype=np.uint8)
            padded[1:-1] = part
            keep = np.ones(len(padded), dtype=bool)
            keep[1:] = (padded[1:] != 32) | (padded[:-1] != 32)
            letters = padded[keep].astype(np.uint32)
            for n in GRAMS:
                if len(letters) < n:
                    continue
                code = letters[n - 1 :].copy()
                for k in range(1, n):
                    code = code * np.uint32(257) + letters[n - 1 - k : len(letters) - k]
                slot = (code * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(20)
                counts[r] += np.bincount(slot, minlength=FEATURES)
        yield first, counts


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors with damped counts."""
    return _unit(np.log1p(counts) * idf.astype(np.float32))


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        for _, counts in gram_counts(batch.column("text")):
            total += (counts > 0).sum(axis=0)
            rows += len(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(np.append(total, rows))], names=["slot", "n"])


def clusters(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of spherical k-means, started from the points furthest from those taken before."""
    chosen = [_unit(points.mean(axis=0, keepdims=True))[0]]
    while len(chosen) < min(k, len(points)):
        chosen.append(points[np.argmin((points @ np.array(chosen).T).max(axis=1))])
    found = np.array(chosen)
    for _ in range(rounds):
        nearest = np.argmax(points @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, points)
        full = np.bincount(nearest, minlength=len(found)) > 0
        found = np.where(full[:, None], _unit(sums), found)
    return found


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", k: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows: idf over all of them, k centroids for each language from about `sample` of its rows.

    A language's rows are drawn by a hash of the text, with equal chance; the number drawn does not grow with the
    table. What comes to the driver is one vector of document counts and k vectors a language. Rows without text or
    language teach nothing; no rows at all give a model without languages.
    """
    known = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    seen = known.select("text").mapInArrow(_presence, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counted = {r["slot"]: r["n"] for r in seen.collect()}
    total = max(1, counted.get(FEATURES, 0))
    idf = np.log((1 + total) / (1 + np.array([counted.get(i, 0) for i in range(FEATURES)]))) + 0.05
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return Model(np.zeros((0, FEATURES)), np.zeros(0, dtype=int), [], idf, np.zeros(0))
    drawn = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_000))
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(1_000_000 * min(1.0, sample / n)) + 1)])
    some = known.where(drawn < limit[F.col("lang")])

    def per_language(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.concatenate([vectors(c, idf) for _, c in gram_counts(pa.array(frame["text"].tolist(), pa.string()))])
        found = clusters(points, k)
        near = np.sort((points @ found.T).max(axis=1))
        least = float(near[int(REJECT_SHARE * len(near))])
        lang = frame["lang"].iloc[0]
        return pd.DataFrame({"lang": lang, "least": least, "centroid": [row.astype(float).tolist() for row in found]})

    fitted = some.groupBy("lang").applyInPandas(per_language, "lang string, least double, centroid array<double>").collect()
    languages = sorted({r["lang"] for r in fitted})
    fitted.sort(key=lambda r: (r["lang"], r["centroid"]))
    least = {r["lang"]: r["least"] for r in fitted}
    return Model(
        np.array([r["centroid"] for r in fitted]),
        np.array([languages.index(r["lang"]) for r in fitted]),
        languages,
        idf,
        np.array([REJECT_SLACK * least[x] for x in languages]),
    )


def _scorer(model: Model, inside: str | None) -> Callable:
    """`inside` names the field of the row that holds the text, where it need not travel by itself."""
    centroids = model.centroids.astype(np.float32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            texts = batch.column("text") if inside is None else batch.column("row").field(inside)
            for first, counts in gram_counts(texts):
                n = len(counts)
                has = letters[first : first + n].astype(bool)
                lang, near, out = ["und"] * n, np.zeros(n), np.ones(n, dtype=bool)
                if model.languages:
                    cosine = vectors(counts, model.idf) @ centroids.T
                    best = cosine.argmax(axis=1)
                    owner = model.owner[best]
                    near = np.where(has, np.clip(cosine[np.arange(n), best], 0, 1), 0).astype(float)
                    out = ~has | (near < model.least[owner])
                    lang = [model.languages[o] if h else "und" for o, h in zip(owner, has, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, n), pa.array(lang, pa.string()), pa.array(near), pa.array(out)],
                    names=["row", "lang_pred", "score", "rejected"],
                )

    return score


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, lang_pred, score, rejected), row being a struct of the `keep` columns, by default all.

    Whole texts are scored, in one pass and without a shuffle. Texts without a letter and null texts are `und`, with
    score 0 and rejected; others get the language of the nearest centroid and are rejected if that is further away
    than what the language's own labelled rows allow. Repeated rows agree, ties go to the first language by name,
    an empty table gives no rows, a model without languages says `und`.
    """
    kept = keep or docs.columns
    # A text that stays in the row goes to Python once.
    inside = text_col if text_col in kept and docs.schema[text_col].dataType.simpleString() == "string" else None
    row = F.struct(*[F.col(c) for c in kept]).alias("row")
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters")
    rows = docs.select(*([F.col(text_col).alias("text")] if inside is None else []), letters, row)
    return rows.mapInArrow(_scorer(model, inside), f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected, as `scored` says."""
    return scored(docs, model, text_col, keep).select("row.*", "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't rejected, with all their columns."""
    return scored(docs, model, text_col).where("NOT rejected").select("row.*")


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether a row's id, as text, falls into one part of `parts` by crc32 (a null id never does)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))
