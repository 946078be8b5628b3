import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlight.llm import collocations
from ledgerlight.llm.quotient import Filter, Packing, permute, restore

SCHEMA = "doc_id long, text string, lang string, id int, word int, g int, rank int, a int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (t or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                for s in range(len(w) - k + 1):
                    counts[lang, tuple(w[s : s + k])] += 1
    found = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    out = {}
    for (lang, p), a in found.items():
        inside = any(
            other == lang and len(q) > len(p) and 100 * f >= 100 * a and any(q[s : s + len(p)] == p for s in range(len(q) - len(p) + 1))
            for (other, q), f in found.items()
        )
        if inside:
            continue
        n = totals[lang]
        cuts = [(1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], n))
    return sorted(
        (lang, i + 1, x[2].decode(), -x[1], x[3], x[4], x[5], -x[0]) for lang, all_ in out.items() for i, x in enumerate(sorted(all_)[:top])
    )


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(i, t, lang, 1, 2, 3, 4, 5) for i, t, lang in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, collocations.collocations(df, **options).collect()))


def sample(n=250, seed=1):
    rng = random.Random(seed)
    words = ["of", "the", "The", "é", "ñ-x", "a\x00b", " ", *[f"w{k}" for k in range(25)]]
    weight = [1 / (k + 1) for k in range(len(words))]
    fixed = ["new york city hall of", "the of the of the of", "ñ-x é w1", "a\x00b  "]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 8)):
            parts += rng.choices(words, weight, k=rng.randrange(8))
            parts.append(rng.choice(fixed))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", " ?!"]) for w in parts)
        rows.append((i, text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(1, rows[1][1], rows[1][2])] * 5 + [(None, None, "en"), (900, "", None), (901, " .\n", "xx")]


@pytest.mark.parametrize(
    "parts, options",
    [(1, {"least": 5}), (6, {"least": 5}), (3, {"least": 20, "dictionary": 7}), (2, {"least": 2, "top": 9}), (2, {"least": 8, "longest": 3})],
)
def test_against_counts_of_all_phrases(spark, parts, options):
    rows = sample(120 if options["least"] == 2 else 250)
    want = brute(rows, options["least"], options.get("longest", 5), options.get("top", 2000))
    assert len(want) > 10 and run(spark, rows, parts, **options) == want


def test_many_shards_and_small_filters_give_the_same(spark, monkeypatch):
    rows = sample(seed=2)
    monkeypatch.setattr(collocations, "FILTER_KEYS", 50)
    monkeypatch.setattr(collocations, "SHARD_KEYS", 100)
    assert run(spark, rows, least=6) == brute(rows, 6, 5, 2000)


def test_no_frequent_phrase_and_no_rows(spark):
    assert run(spark, sample(30), least=10_000) == [] and run(spark, []) == []
    assert run(spark, [(1, "a b a c a", None)], least=2) == []  # a frequent word, but no phrase


def test_long_text(spark):
    rows = [(1, "é the " * 300_000, "fr"), (2, "é the", "en")]
    assert run(spark, rows) == brute(rows, 100, 5, 2000)


def test_permutation_is_invertible():
    rng = np.random.default_rng(2)
    for width in (1, 2, 3, 9, 30, 33, 63, 64):
        x = rng.integers(0, 2**width, 1000, dtype=np.uint64)
        y = permute(x, width)
        assert (restore(y, width) == x).all() and (y >> np.uint64(width - 1) <= 1).all()
    every = np.arange(1 << 12, dtype=np.uint64)
    assert len(np.unique(permute(every, 12))) == 1 << 12


@pytest.mark.parametrize("bits", [1, 7, 16, 21, 25, 33])
@pytest.mark.parametrize("n", [2, 3, 5])
def test_filters_lose_nothing(bits, n):
    rng = np.random.default_rng(bits * 10 + n)
    packing = Packing(n, bits)
    grams = [rng.integers(0, min(2**bits, 40), 3000) for _ in range(n)]
    counts = rng.choice([1, 2, 254, 255, 256, 10**12], 3000)
    want = Counter()
    for g, c in zip(zip(*[x.tolist() for x in grams], strict=True), counts.tolist(), strict=True):
        want[g] += c
    halves = [Filter.of(packing, [x[k::2] for x in packing.pack(grams)], counts[k::2]) for k in (0, 1)]
    for shard_bits in (0, 1, 5):
        parts: dict[int, list[Filter]] = {}
        for f in halves:
            for k, shard in f.shards(shard_bits):
                parts.setdefault(k, []).append(Filter.read(packing, k, shard_bits, shard.payload(k, shard_bits)))
        got = {}
        for k in parts:
            f = Filter.merged(packing, parts[k])
            assert (np.diff(f.limbs[0].astype(object)) >= 0).all()
            got |= dict(zip(zip(*[x.tolist() for x in packing.unpack(f.limbs)], strict=True), f.counts.tolist(), strict=True))
        assert got == dict(want)
