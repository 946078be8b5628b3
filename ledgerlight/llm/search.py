"""Ranked lexical search: a trie of documents per task, searched depth first for each item with upper bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.llm import text
from ledgerlight.session import cut

TOP = 20
BLOCK_TERMS = 20_000  # terms of the items that are searched for in one pass, repeats included
TREE_CELLS = 12_000_000  # documents times terms of one trie
LEAF = 24  # documents that a subtree needs at least to be split further
_U = np.uint64


def terms_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For chunks of rows: the first row's number, hashes of all terms and each row's range of them."""
    raw, at = text.buffers(column)
    for first, last in text.chunks(at):
        yield first, *text.word_hashes(raw, at[first : last + 1], text.NO_WORD)


@dataclass
class Block:
    """Items of one pass: their ids, and each one's terms as numbers into the sorted hashes with how often it has them."""

    ids: list
    hashes: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]


def blocks(items: DataFrame, id_col: str, text_col: str, most: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of at most `most` terms, or one longer item, read partition by partition."""
    ids: list = []
    held: list[np.ndarray] = []
    size = 0

    def block() -> Block:
        known = np.unique(np.concatenate(held))
        numbered = []
        for h in held:
            own, often = np.unique(h, return_counts=True)
            numbered.append((np.searchsorted(known, own), often.astype(np.int64)))
        return Block(list(ids), known, numbered)

    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).distinct()
    for row in rows.toLocalIterator():
        for _, hashes, _ in terms_of(pa.array([row["t"]], pa.string())):
            if ids and size + len(hashes) > most:
                yield block()
                ids, held, size = [], [], 0
            ids.append(row["id"])
            held.append(hashes)
            size += len(hashes)
    if ids:
        yield block()


def _counter(known: np.ndarray) -> Callable:
    """Each document's number of terms and its vector restricted to the known terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, ranges in terms_of(batch.column("t")):
                rows = len(ranges) - 1
                row = np.repeat(np.arange(rows), np.diff(ranges))
                place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                hit = known[place] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
                cells, tf = np.unique(row[hit] * max(len(known), 1) + place[hit], return_counts=True)
                at = np.searchsorted(cells, np.arange(rows + 1) * max(len(known), 1)).astype(np.int32)
                terms = pa.array((cells % max(len(known), 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, rows),
                        pa.array(np.diff(ranges).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(at), terms),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "tf"],
                )

    return count


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents that hold it) of a task's rows."""
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        here = np.bincount(np.asarray(batch.column("terms").flatten()))
        if len(here) > len(total):
            here, total = total, here
        total = total.astype(np.int64)
        total[: len(here)] += here
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["term", "df"])


@dataclass
class Node:
    """Documents whose vectors begin alike: the greatest tf of each term below, the least m, and children or documents."""

    tf: np.ndarray
    m: int
    first: int
    last: int
    children: list[Node] = field(default_factory=list)


class Tree:
    """A path-compressed trie of documents: vectors in the order of the terms' frequencies share their beginnings.

    A subtree of few documents is kept as a leaf, and neighbouring small subtrees share one.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, matrix: np.ndarray, rank: np.ndarray, leaf: int = LEAF):
        # A document's path: its terms' frequency ranks ascending, so the most frequent term comes first.
        inverse = np.argsort(rank)
        by_rank = matrix[:, inverse] > 0
        paths = []
        for row in by_rank:
            paths.append(np.flatnonzero(row).astype(">u4"))
        keys = [p.tobytes() for p in paths]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        self.ids, self.m, self.matrix = ids[order], m[order], matrix[order]
        self.shared = [0] * len(order)
        for i in range(1, len(order)):
            a, b = paths[order[i - 1]], paths[order[i]]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared[i] = int(differ[0]) if len(differ) else n
        self.shared = np.array(self.shared, dtype=np.int64)
        self.leaf = leaf
        self.root = self._grow(0, len(order))

    def _grow(self, first: int, last: int) -> Node:
        top = Node(np.zeros(0, dtype=np.int32), 0, first, last)
        todo, seen = [top], []
        while todo:
            node = todo.pop()
            seen.append(node)
            if node.last - node.first <= self.leaf:
                continue
            inner = self.shared[node.first + 1 : node.last]
            ends = node.first + 1 + np.flatnonzero(inner == inner.min())
            edges = [node.first, *ends.tolist(), node.last]
            begin = node.first
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                # Small neighbours come together until they fill a leaf.
                if b - begin > self.leaf and begin < a:
                    node.children.append(Node(top.tf, 0, begin, a))
                    begin = a
                if b - begin >= self.leaf:
                    node.children.append(Node(top.tf, 0, begin, b))
                    begin = b
            if begin < node.last:
                node.children.append(Node(top.tf, 0, begin, node.last))
            todo.extend(node.children)
        for node in reversed(seen):
            if node.children:
                node.tf = np.maximum.reduce([c.tf for c in node.children])
                node.m = min(c.m for c in node.children)
            else:
                node.tf = self.matrix[node.first : node.last].max(axis=0)
                node.m = int(self.m[node.first : node.last].min())
        return top

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], top: int) -> None:
        """Put the documents with the highest scores into the heap `best` of (score, -id).

        A score grows with tf and falls with m, so a node's greatest tfs and least m bound the scores below it. Subtrees
        go best bound first, and one that cannot reach the heap's least score is left out.
        """
        stack = [(math.inf, self.root)]
        while stack:
            bound, node = stack.pop()
            if len(best) == top and bound < best[0][0]:
                continue
            if node.children:
                tf = np.array([c.tf[terms] for c in node.children])
                bounds = _score(tf, np.array([c.m for c in node.children]), weights)
                for i in np.argsort(bounds, kind="stable"):
                    if bounds[i] > 0 and not (len(best) == top and bounds[i] < best[0][0]):
                        stack.append((int(bounds[i]), node.children[i]))
                continue
            scores = _score(self.matrix[node.first : node.last][:, terms], self.m[node.first : node.last], weights)
            least = best[0][0] if len(best) == top else 1
            for i in np.flatnonzero(scores >= least):
                entry = (int(scores[i]), -int(self.ids[node.first + i]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def _score(tf: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sum of weight * ((10^9 tf) div (1000 tf + 12 m)) of each row, in whole numbers."""
    tf = tf.astype(np.int64)
    return ((1_000_000_000 * tf) // (1000 * tf + 12 * m[:, None]) * weights).sum(axis=1)


def _searcher(block: Block, weights: np.ndarray, rank: np.ndarray, documents: int, all_terms: int, top: int) -> Callable:
    width = max(len(rank), 1)
    most = max(LEAF, TREE_CELLS // width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in block.items]
        for batch in batches:
            for first in range(0, batch.num_rows, most):
                part = batch.slice(first, most)
                lists = part.column("terms")
                matrix = np.zeros((part.num_rows, width), dtype=np.int32)
                row = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths()))
                matrix[row, np.asarray(lists.flatten())] = np.asarray(part.column("tf").flatten())
                m = 75 + (25 * np.asarray(part.column("n")) * documents) // all_terms
                tree = Tree(np.asarray(part.column("doc_id")), m, matrix, rank)
                for (terms, often), heap in zip(block.items, best, strict=True):
                    if len(terms):
                        tree.search(terms, weights[terms] * often, heap, top)
        rows = [(k, -d, s) for k, heap in enumerate(best) for s, d in heap]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "doc_id", "score"])

    return search


def ranked(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with the highest scores above 0.

    Terms are runs of ASCII digits, letters and anything beyond ASCII, A-Z lower-cased. A term's weight is
    floor(1000 ln((2N + 2) / (2df + 1))), a document's m is 75 + (25 n N) div L, its score sums weight times
    (10^9 tf) div (1000 tf + 12 m) over the item's terms, repeats included; equal scores go by ascending document id.

    One pass over the texts gives each document's length and its vector restricted to the items' terms. Each task puts
    its vectors into tries of bounded size and searches them for every item; what it found so far also prunes its later
    tries. Only its best documents leave a task. Items beyond `block_terms` terms are searched for in further passes.
    Terms are the same if their 64-bit hashes are.

    Null and empty texts have no terms and are never found; null items find nothing. Rows that share a document id are
    documents of their own, null document ids are left out of the answer, though not of N and L. An item's repeated rows
    are one item; rows that share an item id with different texts each give their own answer. No documents or no items
    give no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("t"))
    kind = items.schema[item_id].dataType
    found = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for block in blocks(items, item_id, item_text, block_terms):
        vectors = cut(rows.mapInArrow(_counter(block.hashes), "doc_id long, n long, terms array<int>, tf array<int>"), "vectors")
        documents, all_terms = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            continue
        counted = vectors.select("terms").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = np.zeros(max(len(block.hashes), 1), dtype=np.int64)
        for r in counted.collect():  # a row for each term of the block at most
            df[r["term"]] = r["df"]
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()])
        rank = np.empty(len(df), dtype=np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
        searcher = _searcher(block, weights, rank, documents, all_terms, top)
        hits = cut(vectors.where("doc_id IS NOT NULL AND n > 0").mapInArrow(searcher, "item int, doc_id long, score long"), "hits")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind.simpleString()}")
        found = found.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return found.withColumnsRenamed({"doc_id": doc_id, "item_id": item_id})
