import datetime as dt
import gzip
import random

from pyspark.sql import functions as F

from ledgerlight.llm import warc
from ledgerlight.llm.queries import QUERIES

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)


def record(i, kind="response", url="http://a.example/x", minutes=0, status=None, digest=None, headers=(), payload=b"body"):
    full = kind == "response"
    return {
        "record_id": i,
        "type": kind,
        "url": url,
        "date": None if minutes is None else T0 + dt.timedelta(minutes=minutes),
        "digest": digest,
        "status": status or (200 if full else 304),
        "headers": [{"name": k, "value": v} for k, v in headers],
        "payload": payload if full else b"",
    }


def frame(spark, rows):
    return spark.createDataFrame([(r["record_id"], r["type"], r["url"], r["date"], r["digest"], r["status"], [(h["name"], h["value"]) for h in r["headers"]], r["payload"]) for r in rows], warc.SCHEMA)


def resolved(spark, rows):
    return {r["record_id"]: r for r in warc.resolve(frame(spark, rows)).collect()}


def test_files_round_trip(spark, tmp_path):
    rows = [record("r1", headers=[("ETag", '"1"'), ("X", "a: b")], payload=b"line\r\n\r\nmore\x00\xff"), record("r2", "revisit", minutes=5, digest="sha1:AB"), record("r3", payload=b"")]
    plain = b"".join(warc.encode(r) for r in rows)
    assert list(warc.records(plain)) == rows
    zipped = b"".join(gzip.compress(warc.encode(r)) for r in rows)
    assert list(warc.records(zipped)) == rows
    assert list(warc.records(zipped[:-10]))[:2] == rows[:2]
    assert list(warc.records(b"")) == [] and list(warc.records(b"WARC/1.1\r\nbroken")) == []
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(zipped)
    found = warc.read(spark, str(tmp_path)).collect()
    assert sorted(r["record_id"] for r in found) == ["r1", "r1", "r2", "r2", "r3", "r3"]
    assert {bytes(r["payload"]) for r in found if r["record_id"] == "r1"} == {b"line\r\n\r\nmore\x00\xff"}


def test_canonical(spark):
    urls = {
        "HTTP://User@WWW.Example.com:80/A?b=2&a=1&utm_source=x#top": "example.com/A?a=1&b=2",
        "https://example.com": "example.com/",
        "https://example.com:8443/p?ref=x": "example.com:8443/p",
        "https://example.com/p?referrer=1": "example.com/p?referrer=1",
        "not a url": "not a url/",
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.canonical(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in rows} == urls
    assert spark.range(1).select(warc.canonical(F.lit(None).cast("string"))).first()[0] == "/"


def test_validators_and_headers(spark):
    etag = [("ETag", '"v1"'), ("Content-Type", "text/html"), ("Content-Length", "4"), ("Cache-Control", "max-age=1")]
    rows = [
        record("full", minutes=0, headers=etag, digest="d1"),
        record("same", "revisit", minutes=1, headers=[("etag", 'W/"v1"'), ("Cache-Control", "max-age=9"), ("Content-Length", "0"), ("Date", "now")]),
        record("other", "revisit", minutes=2, headers=[("ETag", '"v2"')]),
        record("digest", "revisit", minutes=3, digest="d1"),
        record("bad digest", "revisit", minutes=4, digest="d9", headers=[("ETag", '"v1"')]),
        record("nothing", "revisit", minutes=5),
        record("early", "revisit", minutes=-1, headers=etag),
        record("at once", "revisit", minutes=0, headers=etag),
        record("elsewhere", "revisit", minutes=9, url="http://b.example/", headers=etag),
        record("not modified response", minutes=6, status=304, headers=[("ETag", '"v1"')], payload=b""),
        record("no date", "revisit", minutes=None, headers=etag),
        record(None, "revisit", minutes=9, headers=etag),
        record("old", minutes=0, url="http://c.example/", headers=[("Last-Modified", "m1")]),
        record("modified", "revisit", minutes=1, url="http://c.example/", headers=[("Last-Modified", "m1")]),
        record("modified since", "revisit", minutes=1, url="http://c.example/#x", headers=[("Last-Modified", "m2")]),
    ]
    found = resolved(spark, rows)
    outcome = {k: r["outcome"] for k, r in found.items()}
    assert outcome == {
        "full": "response", "same": "resolved", "other": "mismatch", "digest": "resolved", "bad digest": "mismatch", "nothing": "mismatch",
        "early": "no_response", "at once": "no_response", "elsewhere": "no_response", "not modified response": "resolved", "no date": "no_response",
        None: "no_response", "old": "response", "modified": "resolved", "modified since": "mismatch",
    }
    assert {h["name"].lower(): h["value"] for h in found["same"]["headers"]} == {"etag": 'W/"v1"', "content-type": "text/html", "content-length": "4", "cache-control": "max-age=9", "date": "now"}
    assert bytes(found["same"]["payload"]) == b"body" and found["other"]["payload"] is None


def test_as_of_equals_brute_force_on_a_hot_url(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        url = "http://hot.example/" if i % 3 else f"http://h{i % 11}.example/p"
        kind = "response" if rng.random() < 0.3 else "revisit"
        rows.append(record(f"{i:04d}", kind, url, minutes=rng.randrange(200), headers=[("ETag", "x")], payload=str(i).encode()))
    found = resolved(spark, rows + rows[:5])
    for r in rows:
        if r["type"] == "revisit":
            earlier = [(x["date"], x["record_id"]) for x in rows if x["type"] == "response" and x["url"] == r["url"] and x["date"] < r["date"]]
            assert found[r["record_id"]]["source_id"] == (max(earlier)[1] if earlier else None)
    assert warc.resolve(frame(spark, rows[:1]).limit(0)).count() == 0


def test_query_resolves_derived_crawl(spark):
    found = QUERIES["op5_warc_revisits"](spark, "/root/testdata/sf0.001").collect()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    counts = {}
    for r in found:
        kind = r["record_id"].rsplit(":", 1)[1]
        counts.setdefault(kind, []).append(r["outcome"])
    assert len(counts["response"]) == len(counts["same"]) == len(pages)
    assert set(counts["response"]) == {"response"} and counts["same"].count("resolved") > 0.9 * len(pages)
    assert "resolved" not in counts["other"]


def test_unknown_urls_are_not_the_same(spark):
    tag = [("ETag", '"1"')]
    rows = []
    for k, url in enumerate([None, "", "http:///x"]):
        rows += [record(f"a{k}", url=url, headers=tag), record(f"b{k}", "revisit", url=url, minutes=5, headers=tag)]
    found = resolved(spark, rows)
    for k in range(3):
        assert (found[f"b{k}"]["outcome"], found[f"b{k}"]["source_id"], found[f"b{k}"]["page"]) == ("no_response", None, None)
        assert found[f"a{k}"]["outcome"] == "response"


def test_further_columns_may_have_any_name(spark):
    tag = [("ETag", '"1"')]
    rows = frame(spark, [record("a", headers=tag), record("b", "revisit", minutes=5, headers=tag)])
    wide = rows.withColumns({c: F.lit(7) for c in ("page", "source_id", "stored", "outcome", "t", "band", "at")})
    assert sorted(map(str, warc.resolve(wide).collect())) == sorted(map(str, warc.resolve(rows).collect()))


def test_more_bands_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    rows = [record(f"r{i:03d}", rng.choice(["response", "revisit"]), rng.choice(["http://a/x", "http://a/x", "http://b/y"]), rng.randrange(400), headers=[("ETag", '"1"')]) for i in range(300)]
    want = {k: v["source_id"] for k, v in resolved(spark, rows).items()}
    monkeypatch.setattr(warc, "BAND_ROWS", 2)
    assert {k: v["source_id"] for k, v in resolved(spark, rows).items()} == want
