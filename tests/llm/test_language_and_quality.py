import math
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import language, quality
from ledgerlight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = QUERIES["op2_language_id"](spark, SF)
    assert found.count() == docs.count() and set(found.columns) >= {"doc_id", "held_out", "lang_pred", "score"}
    rows = found.join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").where("held_out AND n > 40").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert len(rows) > 100 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    # Clean documents aren't rejected.
    assert np.mean([r["rejected"] for r in rows]) < 0.01


SMALL = "/root/testdata/sf0.001"


def plain_grams(text):
    """Counts of hashed n-grams of one text, byte by byte."""
    kept = "".join(chr(b) if b > 127 or chr(b).isalpha() else " " for b in (text or "").encode().lower())
    kept = re.sub(" +", " ", f" {kept} ")
    found = Counter()
    for n in language.GRAMS:
        for i in range(len(kept) - n + 1):
            code = 0
            for c in reversed(kept[i : i + n]):
                code = (code * 257 + ord(c)) % 2**32
            found[(code * 2654435761 + n) % 2**32 >> 20] += 1
    return found


def test_language_of_every_text_as_a_plain_nearest_centroid(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    train = docs.where(~language.held_out(F.col("doc_id"), 5, 0))
    model = language.fit(train)
    grams = {r["doc_id"]: plain_grams(r["text"]) for r in docs.select("doc_id", "text").collect()}
    letters = {r["doc_id"]: any(c.isalpha() for c in r["text"] or "") for r in docs.select("doc_id", "text").collect()}
    taught = [r["doc_id"] for r in train.where("lang IS NOT NULL").select("doc_id").collect() if letters[r["doc_id"]]]
    seen = Counter(slot for i in taught for slot in grams[i])
    idf = [math.log((1 + len(taught)) / (1 + seen[slot])) + 0.05 for slot in range(language.FEATURES)]
    assert model.idf == pytest.approx(idf)
    close = 0
    for r in QUERIES["op2_language_id"](spark, SMALL).collect():
        vector = {slot: math.log1p(n) * idf[slot] for slot, n in grams[r["doc_id"]].items()}
        size = math.sqrt(sum(v * v for v in vector.values()))
        if not letters[r["doc_id"]]:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        best = {}
        for centroid, owner in zip(model.centroids, model.owner, strict=True):
            cosine = sum(v * centroid[slot] for slot, v in vector.items()) / size
            best[model.languages[owner]] = max(cosine, best.get(model.languages[owner], -1.0))
        assert r["score"] == pytest.approx(max(0.0, max(best.values())), abs=1e-4)
        first, second = sorted(best.values(), reverse=True)[:2]
        close += first - second < 1e-4
        assert first - second < 1e-4 or best[r["lang_pred"]] == first
    assert close < 0.05 * len(grams)


def test_held_out_matches_crc32(spark):
    import zlib

    rows = spark.range(200).select("id", language.held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_language_defined_cases(spark):
    train = [("the cat and the dog of the house " * 5, "en"), ("der hund und die katze aus dem haus " * 5, "de"), (None, "en"), ("123", "de"), ("nothing known", None)]
    train = spark.createDataFrame(train, "text string, lang string")
    model = language.fit(train)
    assert model.languages == ["de", "en"]
    rows = [(1, None, "s"), (2, "", "s"), (3, "12 34 !?", "s"), (4, "the dog and the cat", "s"), (5, "die katze und der hund", "s"), (6, "x", "s"), (7, "the dog and the cat", "s"), (None, "the cat " * 30_000, "s"), (9, "漢字かな交じり文の例", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("row", F.lit(1)).withColumn("letters", F.lit(2))
    found = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert all((found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True) for i in (1, 2, 3))
    assert found[4]["lang_pred"] == found[7]["lang_pred"] == found[None]["lang_pred"] == "en" and found[5]["lang_pred"] == "de"
    assert found[9]["rejected"] and not found[4]["rejected"]
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and {4, 5, 7} <= {r["doc_id"] for r in kept.collect()}
    assert language.identify(docs.limit(0), model).count() == 0
    none = language.fit(train.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}


def test_clusters_find_groups():
    rng = np.random.default_rng(2)
    centres = language._unit(rng.random((3, 50)))
    points = language._unit(np.repeat(centres, 40, axis=0) + rng.normal(0, 0.005, (120, 50)))
    found = language.clusters(points, 3)
    assert ((centres @ found.T).max(axis=1) > 0.99).all()


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        ranks[s == v] = ranks[s == v].mean()
    n = y.sum()
    return (ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_quality_on_held_out_rows(spark):
    found = QUERIES["op3_quality"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.count() == docs.count()
    rows = found.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    y, s = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    assert len(rows) > 80 and auc(y, s) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def plain_features(text):
    raw = (text or "").encode()
    low = raw.lower()
    blank = b" \t\n\x0b\x0c\r"
    kinds = ["u" if 65 <= b <= 90 else "l" if 97 <= b <= 122 else "d" if 48 <= b <= 57 else " " if b in blank else "." if b in b".,;:'\"?-()" else "b" if b > 127 else "s" for b in raw]
    n = Counter(kinds)
    size, letters = max(1, len(raw) - n[" "]), max(1, n["u"] + n["l"])
    words = re.findall(rb"[^ \t-\r]+", low)
    count = max(1, len(words))
    lines = re.findall(rb"[^\n\r]+", low)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)] or ([tuple(words)] if words else [])
    return [
        math.log1p(size), n["u"] / letters, n["d"] / size, n["."] / size, n["s"] / size, n["b"] / size, size / count,
        len(set(words)) / count, max(Counter(words).values(), default=0) / count, sum(a == b for a, b in zip(words, words[1:])) / count,
        len(set(triples)) / max(1, len(triples)), math.log1p(count / max(1, len(lines))), len(set(lines)) / max(1, len(lines)),
        math.log1p(count / (1 + raw.count(b"."))), sum(a == "s" and b == " " for a, b in zip(kinds, kinds[1:])) / count,
    ]


def plain_score(model, x):
    total = model.bias
    for value, edges, table in zip(x, model.edges, model.tables, strict=True):
        total += table[bisect_right(list(edges), value)]
    for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
        total += table[bisect_right(list(model.coarse[a]), x[a])][bisect_right(list(model.coarse[b]), x[b])]
    return 1 / (1 + math.exp(-total))


def test_quality_of_every_text_as_a_plain_sum_over_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(~language.held_out(F.col("doc_id"), 3, 1))
    model = quality.fit(quality.features(docs), labels)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    measured = {r["doc_id"]: [r[f] for f in quality.FEATURES] for r in quality.features(docs).collect()}
    for i, text in texts.items():
        assert plain_features(text) == pytest.approx(measured[i], rel=1e-12, abs=1e-12), i
    found = QUERIES["op3_quality"](spark, SMALL).collect()
    assert {r["doc_id"] for r in found} == set(texts) and model.pairs
    for r in found:
        assert r["score"] == pytest.approx(plain_score(model, measured[r["doc_id"]]), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_quality_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "A plain sentence."), (5, "A plain sentence."), (None, "word " * 50_000), (6, "###"), (7, "éé")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("row", F.lit(1))
    measured = quality.features(docs)
    none = quality.fit(measured, spark.createDataFrame([(1, None)], "doc_id long, quality int"))
    found = {r["doc_id"]: r["score"] for r in quality.score(measured, none).collect()}
    assert set(found.values()) == {0.5} and len(found) == 8
    model = quality.fit(measured, spark.createDataFrame([(4, 1), (4, 1), (6, 0), (99, 0), (None, 1)], "doc_id long, quality int"))
    found = {r["doc_id"]: r["score"] for r in quality.score(measured, model).collect()}
    assert found[1] == found[2] == found[3] and found[4] == found[5]
    assert quality.features(docs.limit(0)).count() == 0


def test_tables_learn_steps_and_a_pair():
    rng = np.random.default_rng(4)
    x = rng.random((4000, 4))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)).astype(float)
    model = quality.fit_tables(x[:3000], y[:3000])
    assert (1, 0) in model.pairs
    assert auc(y[3000:], model.log_odds(x[3000:])) > 0.95
    lone = quality.shallow_tree(np.array([1.0, 1, -1, -1]), np.ones(4))
    assert lone[0] == lone[1] > 0 > lone[2] == lone[3]
