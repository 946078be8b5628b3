import math

import pytest

from ledgerlight.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, key int, band int, rest int, row string"


def water_fill(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_names, rest = {}, list(names), sum(sizes.values())
    while open_names:
        over = [s for s in open_names if most * sizes[s] < rest * w[s] / sum(w[x] for x in open_names) - 1e-9]
        if not over:
            total = sum(w[x] for x in open_names)
            target |= {s: rest * w[s] / total for s in open_names}
            break
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
            open_names.remove(s)
    return target


def build(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, 3, 4, "r") for i, t, s in rows], SCHEMA)


def sample():
    rows = [(i, "word " * (1 + i * 7 % 23), "hot" if i % 3 else f"s{i % 17}") for i in range(900)]
    return rows + [(1000, None, "s1"), (1001, "", "s1"), (1002, "  \t", None), (1003, "a b c", None), (1004, "x " * 20_000, "long"), (5, "repeated id", "hot"), (None, "no id here", "hot")]


@pytest.mark.parametrize("band_rows", [7, 2_000])
def test_targets_and_selection(spark, monkeypatch, band_rows):
    monkeypatch.setattr(mixing, "BAND_ROWS", band_rows)
    rows = sample()
    found = mixing.mixed(build(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = water_fill(sizes)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    got, source = {}, {(i, len((t or "").split())): s for i, t, s in rows}
    for r in found:
        assert r["taken"] <= 3 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0)
        s = source[(r["doc_id"], r["size"])]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        total = got.setdefault(s, [0, 0])
        total[0] += r["taken"]
        total[1] = max(total[1], r["size"])
    for s, (taken, longest) in got.items():
        assert abs(taken - targets[s]) <= longest / 2 + 1e-6


def test_order_is_efraimidis_spirakis(spark):
    import hashlib

    rows = [(i, "abcdef " * (1 + i % 9), f"s{i % 4}") for i in range(200)]
    found = {r["doc_id"]: r for r in mixing.mixed(build(spark, rows)).collect()}
    for s in range(4):
        own = [i for i, _, x in rows if x == f"s{s}"]
        keys = {}
        for i in own:
            n = found[i]["size"]
            w = 1 / (1 + abs(math.log(max(len(rows[i][1]) / n, 1.0) / 6)))
            u = (int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            keys[i] = -math.log(u) / w
        size, target = found[own[0]]["source_size"], found[own[0]]["target"]
        epochs = int(target // size)
        left = target - epochs * size
        upto = 0
        for i in sorted(own, key=lambda i: keys[i]):
            n = found[i]["size"]
            more = upto + n <= left or (upto < left and upto + n - left < left - upto)
            assert found[i]["taken"] == n * (epochs + more)
            upto += n


def test_mix_repeats_rows_and_keeps_columns(spark):
    rows = sample()
    docs = build(spark, rows)
    taken = {}
    for r in mixing.mixed(docs).collect():
        taken[(r["doc_id"], r["size"])] = taken.get((r["doc_id"], r["size"]), 0) + r["taken"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = {}
    for r in mixed.collect():
        n = len((r["text"] or "").split())
        got[(r["doc_id"], n)] = got.get((r["doc_id"], n), 0) + n
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in got.items() if v}


def test_bands_are_even_whatever_the_weights(spark, monkeypatch):
    """Keys of very large and very small weights spread over the bands; the mix is still in the order of the keys."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "BAND_ROWS", 100)
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"))
    for weight in (F.lit(1000.0), F.lit(0.001), F.when(F.col("doc_id") % 2 == 0, 1e6).otherwise(1e-6)):
        rows = mixing.sized(docs, "doc_id", "text", "source", weight, "mix").drop("row")
        made = mixing.bands(rows.withColumn("rest", F.lit(1.0)), 4_000)
        counts = [r["count"] for r in made.groupBy("band").count().collect()]
        assert len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(counts) < 2 * 4_000 / len(counts)
        found = mixing.mixed(docs, weight=weight).collect()
        keys = {r["id"]: r["key"] for r in rows.select("id", "key").collect()}
        for source in ("a", "b"):
            own = [r for r in found if (r["doc_id"] % 4 == 0) == (source == "b")]
            low, high = min(r["taken"] for r in own), max(r["taken"] for r in own)
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1.5
            if low < high:
                assert max(keys[r["doc_id"]] for r in own if r["taken"] == high) < min(keys[r["doc_id"]] for r in own if r["taken"] == low)


def test_weight_and_empty(spark):
    from pyspark.sql import functions as F

    docs = build(spark, [(i, "a b c d", f"s{i % 3}") for i in range(300)])
    found = mixing.mixed(docs, weight=F.when(F.col("doc_id") < 150, 20.0).otherwise(0.05)).collect()
    # Of the source with the smallest target (37 of its 100 documents), nearly all that is taken is heavy.
    least = min(r["target"] for r in found)
    taken = [r["doc_id"] < 150 for r in found if r["target"] == least and r["taken"]]
    assert 35 <= len(taken) <= 39 and sum(taken) >= len(taken) - 2
    assert mixing.mixed(docs.limit(0)).count() == 0
