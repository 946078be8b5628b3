import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlight.llm import search

DOCS = "doc_id long, text string, n int, terms int, item_id int, rank int"
ITEMS = "item_id long, text string, score int, doc_id int"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, top=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    out = []
    for item, t in set(items):
        scored = []
        for i, c in held:
            if i is None:
                continue
            m, score = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms, 0
            for w in terms(t):
                if c[w]:
                    df = sum(w in x for _, x in held)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
            if score > 0:
                scored.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in docs], DOCS).repartition(parts)
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    return sorted(map(tuple, search.ranked(d, b, **options).collect()), key=str)


def sample(n=300, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(80)] + ["É", "the", "The", "of", "x9"]
    weight = [1 / (k + 1) for k in range(len(words))]

    def body(size):
        return rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weight, k=size))

    docs = [(i, body(rng.choice([0, 1, 5, 40, 400]))) for i in range(n)]
    docs += [(1000 + i, docs[2][1]) for i in range(60)]  # copies: ties beyond the top
    docs += [(2000, None), (None, body(30)), (2001, ""), (2002, "..."), (1, body(9)), (1, body(9))]
    items = [(k, body(rng.choice([3, 12, 40]))) for k in range(25)]
    items += [(100, None), (101, ""), (102, "unheard of"), (103, "the the the w1"), (None, "w2 w3"), (0, items[0][1])]
    return docs, items


@pytest.mark.parametrize("parts, options", [(1, {}), (5, {}), (3, {"block_terms": 40}), (2, {"top": 3})])
def test_against_scores_of_all_documents(spark, parts, options):
    docs, items = sample()
    assert run(spark, docs, items, parts, **options) == brute(docs, items, options.get("top", 20))


def test_small_trees_and_leaves_give_the_same(spark, monkeypatch):
    docs, items = sample(seed=4)
    want = brute(docs, items)
    monkeypatch.setattr(search, "TREE_CELLS", 3000)
    assert run(spark, docs, items) == want


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    # Ten kinds of documents that share the beginnings of their paths.
    kinds = rng.random((10, 60)) < 0.2
    matrix = (kinds[rng.integers(0, 10, 2000)] * rng.integers(1, 5, (2000, 60))).astype(np.int32)
    m = rng.integers(80, 200, 2000)
    rank = np.empty(60, dtype=np.int64)
    rank[np.argsort(-(matrix > 0).sum(axis=0), kind="stable")] = np.arange(60)
    tree = search.Tree(np.arange(2000), m, matrix, rank, leaf=8)
    seen, todo = 0, [tree.root]
    weights = np.arange(1, 61)
    while todo:
        node = todo.pop()
        rows = slice(node.first, node.last)
        assert (node.tf == tree.matrix[rows].max(axis=0)).all() and node.m == tree.m[rows].min()
        if node.children:
            assert [c.first for c in node.children] == [node.first, *[c.last for c in node.children[:-1]]]
            assert node.children[-1].last == node.last
        else:
            seen += node.last - node.first
        todo += node.children
    assert seen == 2000
    scored = []
    inner = search._score
    search._score = lambda tf, m, w: scored.append(len(m)) or inner(tf, m, w)
    try:
        best = []
        tree.search(np.arange(60)[kinds[3]], weights[kinds[3]], best, 20)
    finally:
        search._score = inner
    assert sum(scored) < 1000
    scores = inner(tree.matrix[:, kinds[3]], tree.m, weights[kinds[3]])
    assert sorted(-s for s, _ in best) == sorted((-scores).tolist())[:20]


def test_no_documents_no_items(spark):
    docs, items = sample(20)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    assert run(spark, [(1, None), (2, "")], items) == []


def test_long_text(spark):
    docs = [(1, "é " * 1_500_000 + "needle"), (2, "needle"), (3, "é")]
    assert run(spark, docs, [(1, "Needle é")]) == brute(docs, [(1, "Needle é")])
