"""Random forest on binned columns: a tree is one task's work, whatever the table's length, in bounded memory."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from ledgerlight.session import cut, stored_file

BINS = 32
SPLIT_ROWS = 100_000  # rows that the bounds of the bins are drawn from
BLOCK_ROWS = 65_536
CHUNK_ROWS = 1 << 18  # rows of a tree that are worked on at once
WALK_ROWS = 5000  # rows that go down the trees together: few enough for the cache, many for the calls that a step costs
TREE_SCHEMA = "tree int, feature array<int>, bin array<int>, child array<int>, counts array<double>, gain array<double>"


def walk(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, child: np.ndarray, steps: int) -> np.ndarray:
    """The leaf that each row of x comes to: `child` has two places a node, first above its threshold, then up to it.

    Both children of a leaf are the leaf. A value that is no number goes above.
    """
    n, width = x.shape
    flat, base = x.ravel(), np.arange(n) * width
    # All rows are at the root first.
    node = child[(x[:, feature[0]] <= threshold[0]).astype(np.intp)]
    f, at, down = np.empty(n, np.intp), np.empty(n, np.intp), np.empty(n, bool)
    v, t = np.empty(n, x.dtype), np.empty(n, threshold.dtype)
    for _ in range(steps - 1):
        # Places are valid; `clip` only spares take a copy.
        np.take(feature, node, out=f, mode="clip")
        np.add(base, f, out=at)
        np.take(flat, at, out=v, mode="clip")
        np.take(threshold, node, out=t, mode="clip")
        np.less_equal(v, t, out=down)
        np.add(node, node, out=at)
        np.add(at, down, out=at)
        np.take(child, at, out=node, mode="clip")
    return node


def bounds(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most bins - 1 thresholds between the different values, each bin with about the same weight.

    What is no finite number has no weight; where there is any, the largest number is the last threshold.
    """
    known = np.isfinite(values)
    if not known.all():
        return np.append(bounds(values[known], weights[known], bins - 1), values[known].max(initial=-np.inf))
    values, place = np.unique(values, return_inverse=True)
    between = (values[:-1] + values[1:]) / 2
    if len(between) < bins:
        return between
    reached = np.cumsum(np.bincount(place, weights=weights))
    wanted = np.arange(1, bins) * reached[-1] / bins
    # The place whose weight up to it is nearest to the wanted one.
    at = np.clip(np.searchsorted(reached, wanted), 1, len(reached) - 1)
    at -= wanted - reached[at - 1] <= reached[at] - wanted
    return between[np.unique(np.clip(at, 0, len(between) - 1))]


def binned(columns: list[np.ndarray], thresholds: list[np.ndarray]) -> np.ndarray:
    """(rows, columns) of bin numbers: values up to a threshold are below it, what is no number is in the last bin."""
    codes = np.empty((len(columns[0]), len(columns)), dtype=np.uint8)
    for j, (x, t) in enumerate(zip(columns, thresholds, strict=True)):
        codes[:, j] = np.searchsorted(t, x)
    return codes


def _gini(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and impurity over the last axis."""
    total = counts.sum(axis=-1)
    share = counts / np.where(total > 0, total, 1.0)[..., None]
    return total, 1.0 - (share * share).sum(axis=-1)


class Rows:
    """All rows' bins (a row per column) and labels, in a file without a name on the worker's disk that is mapped to memory."""

    def __init__(self, files: list[str], n: int, width: int):
        import pyarrow.parquet as pq

        self.n = n
        self.codes, self.label = self.held((width, n), np.uint8), self.held((n,), np.uint8)
        at = 0
        for uri in files:
            store, path = stored_file(uri)
            with pq.ParquetFile(path, filesystem=store) as f:
                for batch in f.iter_batches(16):
                    for codes, label in zip(batch["codes"], batch["label"], strict=True):
                        label = np.frombuffer(label.as_py(), dtype=np.uint8)
                        self.codes[:, at : at + len(label)] = np.frombuffer(codes.as_py(), dtype=np.uint8).reshape(width, -1)
                        self.label[at : at + len(label)] = label
                        at += len(label)
        if at != n:
            raise ValueError(f"{at} rows instead of {n}")

    def held(self, shape: tuple, kind) -> np.ndarray:
        with tempfile.TemporaryFile() as f:
            return np.memmap(f, dtype=kind, mode="w+", shape=shape)


def grow(rows: Rows, class_weights: np.ndarray, depth: int, tried: int, least: int, rng: np.random.Generator, state: tuple) -> dict[str, np.ndarray]:
    """One tree on a Poisson draw of all rows, level by level over chunks of rows.

    `state` has the rows that are in open nodes with their node on the level and how often they were drawn; it is kept
    in files as the rows are, so memory is bounded by a chunk and a level's histograms.
    """
    width, classes = len(rows.codes), len(class_weights)
    row_at, node_at, drawn_at = state
    starts = range(0, rows.n, CHUNK_ROWS)
    left_in = []
    counts = np.zeros(classes)
    for start in starts:
        drawn = rng.poisson(1.0, min(CHUNK_ROWS, rows.n - start)).astype(np.uint8)
        inside = np.flatnonzero(drawn)
        row_at[start : start + len(inside)] = inside + start
        node_at[start : start + len(inside)] = 0
        drawn_at[start : start + len(inside)] = drawn[inside]
        left_in.append(len(inside))
        counts += np.bincount(rows.label[inside + start], weights=drawn[inside], minlength=classes)
    feature, bin_, child, all_counts, gains = [0], [255], [(0, 0)], [counts], [0.0]
    frontier = np.array([0])  # numbers of the level's nodes in the tree
    for _ in range(depth):
        known = np.array([all_counts[i] for i in frontier])
        total, impurity = _gini(known * class_weights)
        k = len(frontier)
        columns = np.sort(rng.random((k, width)).argsort(axis=1)[:, :tried], axis=1)
        cells = np.zeros((tried, k * BINS * classes))
        for start, m in zip(starts, left_in, strict=True):
            r, node = row_at[start : start + m].astype(np.intp), node_at[start : start + m].astype(np.intp)
            label, drawn = rows.label[r].astype(np.intp), drawn_at[start : start + m].astype(float)
            for j in range(tried):
                key = (node * BINS + rows.codes[columns[node, j], r]) * classes + label
                cells[j] += np.bincount(key, weights=drawn, minlength=cells.shape[1])
        best = np.zeros(k)
        split = np.zeros((2, k), dtype=np.intp)
        for j in range(tried):
            low = cells[j].reshape(k, BINS, classes).cumsum(axis=1)[:, :-1]
            high = known[:, None] - low
            weight_low, impurity_low = _gini(low * class_weights)
            weight_high, impurity_high = _gini(high * class_weights)
            gain = impurity[:, None] - (weight_low * impurity_low + weight_high * impurity_high) / total[:, None]
            gain[(low.sum(axis=2) < least) | (high.sum(axis=2) < least)] = 0.0
            at = gain.argmax(axis=1)
            gain = gain[np.arange(k), at]
            better = gain > best
            best[better], split[0, better], split[1, better] = gain[better], columns[better, j], at[better]
        # A pure node gains nothing but rounding.
        best[(known > 0).sum(axis=1) < 2] = 0.0
        opened = np.flatnonzero(best > 1e-15)
        if not len(opened):
            break
        place = np.full(k, -1)
        place[opened] = 2 * np.arange(len(opened))
        counts = np.zeros((2 * len(opened), classes))
        for i, (start, m) in enumerate(zip(starts, left_in, strict=True)):
            node = node_at[start : start + m].astype(np.intp)
            stays = place[node] >= 0
            node, r, drawn = node[stays], row_at[start : start + m][stays], drawn_at[start : start + m][stays]
            node = place[node] + (rows.codes[split[0, node], r] > split[1, node])
            key = node * classes + rows.label[r]
            counts += np.bincount(key, weights=drawn, minlength=counts.size).reshape(counts.shape)
            left_in[i] = m = len(r)
            row_at[start : start + m], node_at[start : start + m], drawn_at[start : start + m] = r, node, drawn
        first = len(feature)
        for i, number in enumerate(frontier[opened]):
            feature[number], bin_[number], gains[number] = int(split[0, opened[i]]), int(split[1, opened[i]]), float(best[opened[i]])
            child[number] = (first + 2 * i + 1, first + 2 * i)
        frontier = np.arange(first, first + len(counts))
        feature += [0] * len(counts)
        bin_ += [255] * len(counts)
        gains += [0.0] * len(counts)
        child += [(i, i) for i in frontier.tolist()]
        all_counts += list(counts)
    return pruned(np.array(feature), np.array(bin_), np.array(child), np.array(all_counts) * class_weights, np.array(gains))


def pruned(feature, bin_, child, counts, gain) -> dict[str, np.ndarray]:
    """Two leaves of a node that predict the same class become one; the nodes that are left are numbered anew."""
    own = np.arange(len(feature))
    winner = counts.argmax(axis=1)
    is_leaf = child[:, 0] == own
    for i in own[::-1]:  # children have higher numbers
        a, b = child[i]
        if a != i and is_leaf[a] and is_leaf[b] and winner[a] == winner[b]:
            is_leaf[i] = True
    kept = np.zeros(len(own), dtype=bool)
    kept[0] = True
    for i in own:
        if kept[i] and not is_leaf[i]:
            kept[child[i]] = True
    child[is_leaf] = own[is_leaf, None]
    number = np.cumsum(kept) - 1
    leaf = is_leaf[kept]
    return {
        "feature": np.where(leaf, 0, feature[kept]),
        "bin": np.where(leaf, 255, bin_[kept]),
        "child": number[child[kept]].ravel(),
        "counts": counts[kept].ravel(),
        "gain": np.where(leaf, 0.0, gain[kept]),
    }


@dataclass
class Trees:
    """The nodes of all trees, one after another, as arrays; a node's children are counted from its tree's first node."""

    features: list[str]
    thresholds: list[np.ndarray]
    starts: np.ndarray  # a tree's first node, and the end
    steps: list[int]
    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray
    share: np.ndarray  # (nodes, classes)

    def shares(self, columns: list[np.ndarray]) -> np.ndarray:
        """(rows, classes): the classes' shares in a row's leaf, as the mean over the trees."""
        codes = binned(columns, self.thresholds)
        total = np.zeros((len(codes), self.share.shape[1]))
        for at in range(0, len(codes), WALK_ROWS):
            part = codes[at : at + WALK_ROWS]
            for t, steps in enumerate(self.steps):
                a, b = self.starts[t], self.starts[t + 1]
                leaf = walk(part, self.feature[a:b], self.bin[a:b], self.child[2 * a : 2 * b], steps)
                total[at : at + WALK_ROWS] += self.share[a:b][leaf]
        return total / len(self.steps)


def levels_below(child: np.ndarray) -> int:
    """Levels below the root."""
    level, steps = np.array([0]), 0
    while True:
        below = child.reshape(-1, 2)[level]
        level = below[below[:, 0] != level].ravel()
        if not len(level):
            return steps
        steps += 1


class ForestModel(Model, MLWritable, MLReadable):
    """A fitted forest as a stage: adds `probability`, an array with the share of each class."""

    hasSummary = False

    def __init__(self, features: list[str] | None = None, thresholds: list[np.ndarray] | None = None, classes: int = 2, nodes: pd.DataFrame | None = None):
        super().__init__()
        self.features, self.thresholds, self.classes, self.nodes = features, thresholds, classes, nodes

    def trees(self) -> Trees:
        child = [np.asarray(c, dtype=np.intp) for c in self.nodes["child"]]
        counts = np.concatenate([np.asarray(c) for c in self.nodes["counts"]]).reshape(-1, self.classes)
        return Trees(
            self.features,
            self.thresholds,
            np.cumsum([0] + [len(c) // 2 for c in child]),
            [levels_below(c) for c in child],
            np.concatenate([np.asarray(f, dtype=np.intp) for f in self.nodes["feature"]]),
            np.concatenate([np.asarray(b, dtype=np.uint8) for b in self.nodes["bin"]]),
            np.concatenate(child),
            counts / counts.sum(axis=1, keepdims=True),
        )

    @property
    def featureImportances(self) -> np.ndarray:
        """Impurity that the splits on a column take away, by weight; a tree's parts add up to 1 before they are summed."""
        total = np.zeros(len(self.features))
        for feature, gain, counts in zip(self.nodes["feature"], self.nodes["gain"], self.nodes["counts"], strict=True):
            weight = np.asarray(counts).reshape(-1, self.classes).sum(axis=1)
            own = np.bincount(np.asarray(feature), weights=np.asarray(gain) * weight, minlength=len(total))
            total += own / own.sum() if own.sum() > 0 else 0.0
        return total / total.sum() if total.sum() > 0 else total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.trees())

        @F.pandas_udf("array<double>")
        def probability(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for batch in columns:
                yield pd.Series(list(shared.value.shares([c.to_numpy(float, na_value=np.nan) for c in batch])))

        return dataset.withColumn("probability", probability(*[F.col(c).cast("double") for c in self.features]))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        about = {"features": m.features, "thresholds": [t.tolist() for t in m.thresholds], "classes": m.classes}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=about)
        self.sparkSession.createDataFrame(m.nodes, TREE_SCHEMA).write.parquet(f"{path}/data")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nodes = self.sparkSession.read.parquet(f"{path}/data").toPandas().sort_values("tree", ignore_index=True)
        model = ForestModel(about["features"], [np.array(t) for t in about["thresholds"]], about["classes"], nodes)
        return model._resetUid(about["uid"])


def fit(df: DataFrame, features: list[str], label: str, weights: dict[int, float], n_trees: int, depth: int, least: int, tried: int, seed: int) -> ForestModel:
    """`n_trees` trees, each on a Poisson draw of all rows of `df`, with `tried` columns a node.

    The rows are binned and written once, a byte a value; the tasks that grow the trees read them from the shared folder,
    which pyarrow has to be able to read. Every level of a tree looks at all its open rows, so a tree is the same as if
    its rows were held in memory. The driver gets the sample for the bins' bounds and the nodes.
    """
    spark = df.sparkSession
    width = len(features)
    number = F.col(label).cast("double")
    rows = cut(df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], number.alias("label")), "rows")
    ends = rows.agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.col("label") != F.floor("label")).alias("broken")).first()
    n = ends["n"]
    if not n or ends["labelled"] < n or ends["low"] < 0 or ends["high"] > 99 or ends["broken"]:
        raise ValueError("a forest needs rows, and whole labels from 0 to 99 that are not null")
    classes = max(2, int(ends["high"]) + 1)
    class_weights = np.array([weights.get(i, 1.0) for i in range(classes)])
    drawn = (rows if n <= SPLIT_ROWS else rows.sample(SPLIT_ROWS / n, seed)).toPandas()
    each = class_weights[drawn["label"].to_numpy(int)]
    thresholds = [bounds(drawn[f"x{i}"].to_numpy(float), each) for i in range(width)]

    def bins(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), BLOCK_ROWS):
                block = part.iloc[at : at + BLOCK_ROWS]
                codes = binned([block[f"x{i}"].to_numpy(float) for i in range(width)], thresholds)
                yield pd.DataFrame({"codes": [codes.T.tobytes()], "label": [block["label"].to_numpy(np.uint8).tobytes()]})

    blocks = cut(rows.mapInPandas(bins, "codes binary, label binary"), "bins")
    files = sorted(r["file"] for r in blocks.select(F.col("_metadata.file_path").alias("file")).distinct().collect())

    def grown(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = state = None
        for part in parts:
            for tree in part["id"].tolist():
                if held is None:
                    held = Rows(files, n, width)
                    state = tuple(held.held((n,), kind) for kind in (np.uint32 if n < 2**32 else np.int64, np.uint16, np.uint8))
                nodes = grow(held, class_weights, depth, min(tried, width), least, np.random.default_rng([seed, tree]), state)
                yield pd.DataFrame([{"tree": tree} | nodes])

    tasks = min(n_trees, 4 * spark.sparkContext.defaultParallelism)
    nodes = cut(spark.range(0, n_trees, 1, tasks).mapInPandas(grown, TREE_SCHEMA), "trees").toPandas()
    return ForestModel(list(features), thresholds, classes, nodes.sort_values("tree", ignore_index=True))
