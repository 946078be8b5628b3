import hashlib
import random
import re

import pytest

from ledgerlight.llm import decontaminate

DOCS = "doc_id long, text string, id string, digest int, w string, h int"
ITEMS = "item_id long, text string, win int, len int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, window=13, share=20):
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, it in items:
            v = words(it)
            n = min(len(v), window)
            for s in range(len(v) - n + 1 if v else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == v[s : s + n]:
                        hit |= set(range(at, at + n))
                        found.add(i)
        names = sorted(str(i) for i in found if i is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), sha, bool(hit) and share * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    return sorted((tuple(r)[:6] for r in decontaminate.contamination(d, b, **options).collect()), key=str)


def sample():
    rng = random.Random(11)
    pool = [f"{a}{b}" for a in ("ka", "lo", "mi", "ñu", "é") for b in range(20)] + ["the", "of", "and"] * 20
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([14, 20, 30])))) for i in range(8)]
    items += [(20, "Two Words"), (21, "alone"), (22, "a b c d e f"), (23, items[0][1]), (None, items[1][1]), (24, ""), (25, None), (26, "..."), (2, "the second text of an item that has its id twice and runs on a little longer")]
    docs = []
    for i in range(40):
        body = rng.choices(pool, k=rng.choice([0, 5, 60, 200]))
        if i % 3 == 0:
            v = words(rng.choice(items[:8])[1])
            at = rng.randrange(len(body) + 1)
            cut = rng.randrange(len(v))
            body[at:at] = v if i % 2 else v[cut:] + v[:cut]
        if i % 7 == 0:
            body += ["two", "words", "Alone", "alone", "a", "b", "c", "d", "e", "f"]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(body).upper() if i % 5 == 0 else " ".join(body)))
    v = items[3][1]
    docs += [(50, v + " " + v), (51, v * 3), (52, None), (53, ""), (54, docs[9][1]), (9, docs[9][1]), (9, "other text of the same id " + v), (None, v), (55, "the " * 9000 + v)]
    return docs, items


@pytest.mark.parametrize("block", [7, 500_000])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
    docs, items = sample()
    if block < 100:
        docs, items = docs[::4] + docs[-9:], items[:1] + items[3:4] + items[9:12]
    assert run(spark, docs, items) == brute(docs, items)


def test_other_window_and_share(spark):
    docs, items = sample()
    assert run(spark, docs, items, window=8, shingle=3, share=3) == brute(docs, items, 8, 3)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c")]) == []
    assert run(spark, [(1, "a b c"), (2, None)], []) == brute([(1, "a b c"), (2, None)], [])


def test_only_prefixes_are_joined(spark):
    """A window of frequent shingles and one rare one is looked up by the rare one alone."""
    from pyspark.sql import functions as F

    common = "one two three four five six seven eight nine ten"
    docs = [(i, f"{common} w{i} x{i} y{i} z{i}") for i in range(50)]
    items = spark.createDataFrame([(1, f"{common} w7 x7 y7")], "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    texts, found = decontaminate._found(d, items, "doc_id", "text")
    assert texts.columns == ["id", "digest", "n", "hs5"]
    assert [(r["id"], r["start"], r["len"], r["item"]) for r in found.collect()] == [(7, 0, 13, "1")]
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" in joined and "Window" not in joined
    assert d.count() == texts.count() == 50 and texts.agg(F.sum(F.size("hs5"))).first()[0] == 50 * 10


def test_no_shuffle_before_the_broadcast_join(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    tokens = spark.createDataFrame([(5, 1)], "k long, h long")
    w = d.select("doc_id", decontaminate.words(F.col("text")).alias("w"))
    plan = w.select("doc_id", F.posexplode(decontaminate._shingles("w", 5)).alias("pos", "h")).join(F.broadcast(tokens), "h")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text
