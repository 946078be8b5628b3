import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from ledgerlight.llm import components, minhash, text
from ledgerlight.llm.components import connected

SCHEMA = "doc_id long, text string, id string, t string, n int, key string"


def shingles(t, k):
    w = (t or "").encode().lower().split()
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {(d, len(s), least[root(i)], d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))}


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x", "y", 1, "z") for d, t in rows], SCHEMA)
    return {tuple(r) for r in minhash.near_duplicates(df, **options).collect()}


def texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = rng.choices(words, k=rng.choice([3, 9, 40, 120]))
        for copy in range(rng.choice([1, 2, 5])):
            own = list(base)
            for _ in range(copy):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own))
    # A chain: each is like the one before only.
    chain = rng.choices(words, k=200)
    for _ in range(6):
        at = rng.randrange(180)
        chain = chain[:at] + rng.choices(words, k=6) + chain[at + 6 :]
        rows.append("\t".join(chain).upper())
    # A passage that many otherwise different texts share.
    passage = rng.choices(words, k=40)
    rows += [" ".join(passage + rng.choices(words, k=15)) for _ in range(30)]
    # A large group of copies of one another, some like its first only through others.
    body = rng.choices(words, k=100)
    for _ in range(40):
        own = list(body)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(100)] = "new" + str(rng.random())
        rows.append(" ".join(own))
    rows += ["", None, "   \n", "one", "one", "ONE", "É é", "é é"]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows, strict=True))


@pytest.mark.parametrize("k", [4, 5])
def test_equals_all_pairs(spark, k):
    rows = texts()
    assert run(spark, rows, shingle=k) == brute(rows, k, 80)


def test_blocks_of_a_family_meet_one_another(spark, monkeypatch):
    monkeypatch.setattr(minhash, "OTHERS_BLOCK", 300)
    monkeypatch.setattr(minhash, "ALL_BLOCK", 700)
    rows = texts()
    assert run(spark, rows, slots=64, band_rows=2) == brute(rows, 5, 80)


def test_only_members_behind_the_leader_are_alike(spark):
    """One band holds all three; the leader is like neither of the others, which are like one another."""
    rng = random.Random(4)
    for _ in range(500):
        base = [f"w{rng.random()}" for _ in range(100)]
        near = base[:97] + [f"n{rng.random()}" for _ in range(3)]
        leader = [f"l{rng.random()}" for _ in range(25)] + base[25:]
        rows = [(1, " ".join(leader)), (2, " ".join(base)), (3, " ".join(near))]
        sets = [s for _, part in text.word_shingles(pa.array([t for _, t in rows]), 5) for s in part]
        sig = minhash.super_minhash(np.concatenate(sets), np.repeat([0, 1, 2], [len(s) for s in sets]), 3, 4)
        if len(set(minhash.band_keys(sig, 4)[:, 0].tolist())) == 1:
            break
    else:
        raise AssertionError("no fixture with a common band")
    expected = brute(rows, 5, 80)
    assert {(d, c) for d, _, c, _ in expected} == {(1, 1), (2, 2), (3, 2)}
    assert run(spark, rows, slots=4, band_rows=4) == expected


@pytest.mark.parametrize("size", [1, 5, 10, 30, 97, 400])
def test_comparer_counts_like_set_intersection(size):
    rng = np.random.default_rng(size)
    sets = []
    for _ in range(12):
        own = rng.integers(0, 2**64, size, dtype=np.uint64)
        sets.append(own)
        for share in (0.0, 0.05, 0.15, 0.3):
            new = rng.random(size) < share
            sets.append(np.where(new, rng.integers(0, 2**64, size, dtype=np.uint64), own))
    sets = [np.unique(s).view(np.int64) for s in sets]
    for i, x in enumerate(sets):
        keys = [np.array([7, i])]
        others = pd.DataFrame({"id": [i], "c": [i], "n": [len(x)], "shingles": [x], "keys": keys})
        for j, y in enumerate(sets):
            everyone = pd.DataFrame({"id": [j], "c": [j], "n": [len(y)], "aside": [False], "shingles": [y], "keys": [np.array([j, 7])]})
            both = len(np.intersect1d(x, y))
            wanted = [(i, j)] if i != j and 100 * both >= 80 * (len(x) + len(y) - both) else []
            assert list(minhash._comparer(80)(others, everyone).itertuples(index=False, name=None)) == wanted
            apart = everyone.assign(keys=[np.array([-1])])
            assert not len(minhash._comparer(80)(others, apart))


def test_long_text_and_copies(spark):
    rng = random.Random(1)
    long = " ".join(f"u{rng.randrange(50_000)}" for _ in range(60_000))
    rows = [(1, long), (2, long + " end"), (3, long.replace("u1", "v1")), *[(10 + i, "same words in all of these texts") for i in range(300)]]
    assert run(spark, rows) == brute(rows, 5, 80)


def test_defined_cases(spark):
    assert run(spark, []) == set()
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (5, "another text with its own words")]
    found = run(spark, rows)
    assert found == {(5, 2, 5, True), (None, 2, None, True), (7, 2, 5, False)} | {(5, 2, 5, True)}


def test_signature_estimates_with_low_variance():
    rng = np.random.default_rng(0)
    errors, n, slots = [], 300, 512
    for _ in range(40):
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = pool[: n + 60], pool[60 : n + 120]
        sig = minhash.super_minhash(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, slots)
        j = (n) / (n + 120)
        errors.append((sig[0] == sig[1]).mean() - j)
    plain = (j * (1 - j) / slots) ** 0.5
    assert abs(np.mean(errors)) < 3 * plain / 40**0.5 and np.std(errors) < plain


def test_signature_of_few_elements_fills_all_slots():
    sig = minhash.super_minhash(np.array([7, 9], dtype=np.uint64), np.array([0, 1]), 3, 64)
    assert np.isfinite(sig[:2]).all() and np.isinf(sig[2]).all()
    assert sorted(sig[0].astype(int)) == list(range(64))


def test_word_hashes_split_like_bytes():
    import pyarrow as pa

    rows = ["a b", " A  b ", None, "", "é\tÉ\x0bx", "b", "xy\r\nxy"]
    raw, at = text.buffers(pa.array(rows))
    hashes, ranges = text.word_hashes(raw, at)
    seen = {}
    for i, t in enumerate(rows):
        own = hashes[ranges[i] : ranges[i + 1]].tolist()
        words = (t or "").encode().lower().split()
        assert len(own) == len(words)
        for h, w in zip(own, words, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(components, "TASK_LINKS", 40)
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2060)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    ends = {x for a, b in links if a != b for x in (a, b)}
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: root(x) for x in ends}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
