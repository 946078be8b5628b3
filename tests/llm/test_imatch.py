import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import imatch
from ledgerlight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Edited texts by neighbours in descending (id, text) order; null ids last."""
    order = sorted(rows, key=lambda r: (r[1] or ""))
    order = sorted(order, key=lambda r: -(2**63) if r[0] is None else r[0], reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((d, t, n, t[: len(t) - half] + n[:half]))
    return out


@pytest.mark.parametrize("slice_rows", [1, 3, 500])
def test_edits_follow_the_order_of_ids(spark, slice_rows):
    rows = [(i * 3 - 40, f"text {i} " * (i % 7) + "é😀" * (i % 3)) for i in range(60)] + [(2, "dup b"), (2, "dup a"), (500, None), (501, ""), (None, "no id"), (700, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slice", F.lit(1)).withColumn("takes", F.lit("c")).repartition(4)
    words = imatch.lexicon(docs, low=0.01, high=0.9)
    found = imatch.edited(docs, words, slice_rows=slice_rows).collect()
    want = sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, _, e in brute(rows)), key=str)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == want
    prints = {}
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(r["fingerprint"], 0)


def test_one_and_no_document(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    (row,) = imatch.edited(docs, imatch.lexicon(docs)).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1.0
    assert imatch.edited(docs.limit(0), imatch.lexicon(docs.limit(0))).count() == 0


def test_lexicon_is_the_band(spark):
    rows = [(i, " ".join(["all", f"own{i}"] + [f"mid{i % 10}"] * 3)) for i in range(100)] + [(200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = imatch.lexicon(docs, low=0.05, high=0.5)
    import pyarrow as pa

    wanted = np.sort(np.concatenate([s for _, sets in imatch.terms(pa.array([" ".join(f"MID{i}" for i in range(10))])) for s in sets]))
    assert np.array_equal(words, wanted)


def test_likeness_separates(spark):
    found = QUERIES["op6_imatch"](spark, SF).toPandas()
    assert len(found) == 1000
    same = found.fingerprint == found.edited_fingerprint
    assert (found.near_edited[same] == 1).all()
    y = np.concatenate([np.ones(len(found)), np.zeros(len(found))])
    s = np.concatenate([found.near_edited, found.near_next])
    wins = (found.near_edited.to_numpy()[:, None] > found.near_next.to_numpy()[None, :]).mean() + 0.5 * (found.near_edited.to_numpy()[:, None] == found.near_next.to_numpy()[None, :]).mean()
    assert len(y) == len(s) and wins > 0.8


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = imatch.lexicon(docs)
    prints = imatch.fingerprints(docs, words).join(docs.select("doc_id", "text"), "doc_id")
    assert prints.groupBy("text").agg(F.countDistinct("fingerprint").alias("n")).where("n > 1").count() == 0
    texts = docs.select("text").distinct().count()
    assert prints.select("fingerprint").distinct().count() > 0.9 * texts


def test_texts_without_lexicon_terms_keep_their_whole_digest():
    none = np.zeros(0, dtype=np.uint64)
    prints = [imatch.fingerprint(none, none, f"text {i}") for i in range(3000)]
    assert len({imatch.as_text(p) for p in prints}) == 3000
    assert imatch.likeness(prints[0], prints[0].copy()) == 1.0 and imatch.likeness(prints[0], prints[1]) == 0.0
