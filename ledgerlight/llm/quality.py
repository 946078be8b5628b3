"""Quality classifier: a generalised additive model with pairwise interactions on features of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm import text

FEATURES = (
    "length",
    "upper_share",
    "digit_share",
    "mark_share",
    "symbol_share",
    "beyond_ascii_share",
    "word_length",
    "distinct_words",
    "top_word_share",
    "repeated_word_share",
    "distinct_triples",
    "line_length",
    "distinct_lines",
    "words_per_stop",
    "symbol_ends",
)
SAMPLE = 20_000  # labelled rows the tables are fitted on, at most about
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
SMOOTHING = 5.0

_UPPER, _LOWER, _DIGIT, _BLANK, _STOP, _SYMBOL, _BEYOND = range(7)
_KIND = np.full(256, _SYMBOL, dtype=np.uint8)
_KIND[128:] = _BEYOND
_KIND[65:91] = _UPPER
_KIND[97:123] = _LOWER
_KIND[48:58] = _DIGIT
_KIND[[32, *range(9, 14)]] = _BLANK
_KIND[[ord(c) for c in ".,;:'\"?-()"]] = _STOP
_LINES = np.zeros(256, dtype=bool)
_LINES[[10, 13]] = True


def _row(part: np.ndarray, words: np.ndarray, lines: np.ndarray) -> list[float]:
    kinds = _KIND[part]
    n = np.bincount(kinds, minlength=7).astype(float)
    size = max(1.0, n.sum() - n[_BLANK])
    letters = max(1.0, n[_UPPER] + n[_LOWER])
    count = max(1, len(words))
    each = np.unique(words, return_counts=True)[1]
    triples = text.shingle_hashes(words, np.array([0, len(words)]), 3)[0]
    ends = (kinds[:-1] == _SYMBOL) & (kinds[1:] == _BLANK) if len(kinds) > 1 else np.zeros(0, dtype=bool)
    return [
        np.log1p(size),
        n[_UPPER] / letters,
        n[_DIGIT] / size,
        n[_STOP] / size,
        n[_SYMBOL] / size,
        n[_BEYOND] / size,
        size / count,
        len(each) / count,
        (each.max() if len(each) else 0) / count,
        (words[1:] == words[:-1]).sum() / count,
        len(np.unique(triples)) / max(1, len(triples)),
        np.log1p(count / max(1, len(lines))),
        len(np.unique(lines)) / max(1, len(lines)),
        np.log1p(count / (1 + (part == 46).sum())),
        ends.sum() / count,
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text.buffers(batch.column("text"))
        for first, last in text.chunks(at):
            rows = at[first : last + 1]
            words, edges = text.word_hashes(raw, rows)
            lines, breaks = text.word_hashes(raw, rows, _LINES)
            table = np.array(
                [
                    _row(raw[rows[i] : rows[i + 1]], words[edges[i] : edges[i + 1]], lines[breaks[i] : breaks[i + 1]])
                    for i in range(last - first)
                ]
            )
            kept = batch.column("row").slice(first, last - first)
            yield pa.RecordBatch.from_arrays([kept, *[pa.array(c) for c in table.T]], names=["row", *FEATURES])


def features(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns and a double for each feature of the whole text (null: empty)."""
    rows = docs.select(F.col(text_col).alias("text"), F.struct(*[F.col(c) for c in keep]).alias("row"))
    measured = rows.mapInArrow(_measure, f"row {rows.schema['row'].dataType.simpleString()}" + "".join(f", {f} double" for f in FEATURES))
    return measured.select("row.*", *FEATURES)


@dataclass
class Model:
    """Bin edges and a lookup table per feature; coarser edges and a table per pair; all add up to a log-odds."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            rows = np.searchsorted(self.coarse[a], x[:, a], side="right")
            total += table[rows, np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return total


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTHING)


def _split(g: np.ndarray, h: np.ndarray) -> int | None:
    """Where cutting a range of bins in two helps most; None where it doesn't."""
    if len(g) < 2:
        return None
    left, down = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left, down) + _gain(g.sum() - left, h.sum() - down) - _gain(g.sum(), h.sum())
    best = int(np.argmax(gains))
    return best + 1 if gains[best] > 1e-9 else None


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step values per bin of a tree of the given depth over the ordered bins."""
    cut = _split(g, h) if depth else None
    if cut is None:
        return np.full(len(g), g.sum() / (h.sum() + SMOOTHING))
    return np.concatenate([shallow_tree(g[:cut], h[:cut], depth - 1), shallow_tree(g[cut:], h[cut:], depth - 1)])


def quadrant_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Step values of the best cut of a grid into four quadrants, and its gain."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return np.zeros_like(g), 0.0
    a, b = gc[:-1, :-1], hc[:-1, :-1]
    top, left, all_g = gc[:-1, -1:], gc[-1:, :-1], gc[-1, -1]
    top_h, left_h, all_h = hc[:-1, -1:], hc[-1:, :-1], hc[-1, -1]
    gains = _gain(a, b) + _gain(top - a, top_h - b) + _gain(left - a, left_h - b) + _gain(all_g - top - left + a, all_h - top_h - left_h + b)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + SMOOTHING)
    return out, float(gains[i, j])


def fit_tables(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: feature after feature, each round adds one shallow tree's steps to the feature's table; then the
    pairs with the largest gain on what is left get tables of their own. No rows give even odds for everything."""
    width = x.shape[1]
    if not len(x):
        return Model(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width, [np.zeros(0)] * width, [], [])
    share = np.clip(y.mean(), 0.001, 0.999)
    bias = float(np.log(share / (1 - share)))
    edges, coarse = [_edges(c, BINS) for c in x.T], [_edges(c, PAIR_BINS) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(x), bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            g, h = slopes()
            n = len(tables[f])
            step = RATE * shallow_tree(np.bincount(bins[f], g, n), np.bincount(bins[f], h, n))
            tables[f] += step
            total += step[bins[f]]

    grid = [np.searchsorted(e, c, side="right") for e, c in zip(coarse, x.T, strict=True)]
    sizes = [len(e) + 1 for e in coarse]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, shape = grid[a] * sizes[b] + grid[b], (sizes[a], sizes[b])
        g, h = slopes()
        return at, np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape)

    ranked = sorted(((quadrant_tree(*sums(a, b)[1:])[1], a, b) for a in range(width) for b in range(a)), reverse=True)
    pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            at, g, h = sums(a, b)
            step = RATE * quadrant_tree(g, h)[0]
            pair_tables[k] += step
            total += step.ravel()[at]
    return Model(bias, edges, tables, coarse, pairs, pair_tables)


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on labelled rows of a feature table: about `sample` of them, drawn by a hash of the id with equal chance.

    The sample bounds what comes to the driver, some doubles a row. Null labels teach nothing; a document labelled
    twice counts twice.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("_y"))
    rows = measured.join(known, F.col(id_col) == F.col("_id"))
    n = rows.count()
    share = min(1.0, sample / max(1, n))
    rows = rows.where(F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * share) + 1)
    found = rows.select("_y", *FEATURES).toPandas().sort_values(["_y", *FEATURES])
    return fit_tables(found[list(FEATURES)].to_numpy(float), found["_y"].to_numpy(float))


def _scorer(model: Model, kept: int) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([np.asarray(c, dtype=float) for c in batch.columns[kept:]])
            p = 1 / (1 + np.exp(-model.log_odds(x)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*batch.schema.names[:kept], "score", "predicted"]
            )

    return score


def score(measured: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5).

    Empty and null texts are scored as texts of length 0, equal texts alike; an empty table gives no rows.
    """
    kept = ", ".join(f"`{c}` {measured.schema[c].dataType.simpleString()}" for c in keep)
    return measured.select(*keep, *FEATURES).mapInArrow(_scorer(model, len(keep)), f"{kept}, score double, predicted int")
