import random
import re

import pytest

from ledgerlight.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, id string, t int, n_words int, spans int"


def run(spark, texts, **options):
    rows = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in texts], SCHEMA)
    found = licenses.scan(rows, **options)
    return {r["doc_id"]: r for r in licenses.digest(found).collect()}, {r["doc_id"]: r for r in found.collect()}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(text, wanted):
    """Base places, labels and best likeness from all word sequences of a text."""
    w = WORD.findall((text or "").translate(LOWER))
    base, labels, best = [], set(), 0.0
    for n in wanted:
        size = len(n.words.split(" "))
        for s in range(len(w)):
            for e in range(s + 1, min(len(w), s + size + n.errors) + 1):
                here = " ".join(w[s:e])
                if abs(len(here) - len(n.words)) > n.errors:
                    continue
                d = distance(here, n.words)
                if d <= n.errors:
                    labels.add(n.label)
                    best = max(best, 1 - d / len(n.words))
                    if d == 0 and n.base:
                        base.append((s, n.label))
    return len(w), base, labels, best


def spoiled(rng, words):
    out = list(words)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("xyé9 ")
        elif kind == 1:
            out.insert(at, rng.choice("xyñ "))
        else:
            del out[at]
    return "".join(out)


def texts():
    rng = random.Random(5)
    filler = ["license", "the", "mit", "gnu", "général", "Public", "under", "cc", "by", "4", "submit", "licenses", "ß"]
    every = [*licenses.PHRASES, *licenses.NOTICES]
    out = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += rng.choices(filler, k=rng.randrange(6))
            parts.append(spoiled(rng, rng.choice(every)))
        out.append((i, rng.choice([" ", "  ", ", ", "\n", "-"]).join(parts)))
    return out


def test_all_word_sequences_give_the_same(spark):
    wanted = licenses.notices()
    rows = texts()
    got, spans = run(spark, rows)
    assert len(got) == len(rows)
    for i, t in rows:
        n, base, labels, best = brute(t, wanted)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (n, len(base)), t
        assert (r["first_word"], r["last_word"]) == (min(base, default=(None,))[0], max(base, default=(None,))[0])
        assert r["base_labels"] == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r["labels"].split(","))) == labels, t
        # Of near matches that overlap one another the leftmost is reported, so the best one may be left out.
        assert r["score"] <= best + 1e-12 and (r["score"] > 0) == (best > 0)
        if r["n_base"]:
            assert r["score"] == 1.0
        for s in spans[i]["spans"]:
            words = WORD.findall(t[s["start"] : s["end"]].translate(LOWER))
            assert distance(" ".join(words), s["notice"]) == s["edits"]
            assert len(words) == s["last_word"] - s["first_word"] + 1


def test_spans_point_into_the_text(spark):
    t = "É é — Released  under the\nMIT\tLicence; or Apache-License."
    _, found = run(spark, [(1, t)])
    assert [(s["label"], t[s["start"] : s["end"]], s["edits"], s["base"]) for s in found[1]["spans"]] == [
        ("mit", "MIT\tLicence", 1, False),
        ("apache", "Apache-License", 0, True),
    ]


def test_parts_of_words_are_no_phrase(spark):
    got, _ = run(spark, [(1, "permit license"), (2, "mit licensed"), (3, "submit licenses by"), (4, "acc by")])
    assert [got[i]["n_base"] for i in (1, 2, 3, 4)] == [0, 0, 0, 0]
    assert [got[i]["labels"] for i in (1, 2, 3, 4)] == ["", "mit", "", ""]


@pytest.mark.parametrize("text", [None, "", " \n.", "a"])
def test_texts_without_notices(spark, text):
    got, _ = run(spark, [(1, text), (None, text)])
    assert tuple(got[1])[1:] == (1 if text == "a" else 0, 0, None, None, "", "", 0.0)
    assert None in got


def test_long_texts_repeats_and_no_rows(spark):
    long = "é " * 1_200_000 + "MIT License " * 2000
    rows = spark.createDataFrame([(1, long), (2, "Mit license"), (2, "Mit license")], "doc_id long, text string")
    out = sorted(licenses.digest(licenses.scan(rows)).collect(), key=lambda r: r["doc_id"])
    assert [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"]) for r in out] == [
        (1, 1_204_000, 2000, 1_200_000, 1_203_998), (2, 2, 1, 0, 0), (2, 2, 1, 0, 0),
    ]
    assert licenses.digest(licenses.scan(rows.limit(0))).count() == 0
