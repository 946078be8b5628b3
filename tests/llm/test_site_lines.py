import random

from pyspark.sql import functions as F

from ledgerlight.llm import site_lines
from ledgerlight.llm.queries import QUERIES


def lines_of(spark, html):
    return spark.createDataFrame([(html,)], "h string").select(site_lines.html_lines(F.col("h"))).first()[0]


def test_html_lines(spark):
    html = "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>one</a></li></ul></nav><!-- no -->a <b>bold</b> word<br>next\r\n  last </body>"
    assert lines_of(spark, html) == ["T", "one", "a bold word", "next", "last"]
    assert lines_of(spark, None) == [] and lines_of(spark, "") == [] and lines_of(spark, "<p></p>") == []
    assert lines_of(spark, "<script>unclosed") == ["unclosed"]


def test_equals_brute_force(spark):
    rng = random.Random(9)
    pages = []
    for i in range(400):
        h = "Hot.example" if i % 3 else f"h{i % 13}.example"
        body = [f"line {rng.randrange(60)}" for _ in range(rng.randrange(12))] + ["footer of all"] * (i % 4 > 0)
        pages.append((i, f"https://u@{h}:80/p/{i}?q", "<p>" + "</p><p>".join(body) + "</p>"))
    pages += [(900, None, "<p>footer of all"), (901, "nonsense", None), (902, "http://single.example/", "<p>mine"), (5, pages[5][1], pages[5][2]), (None, "http://hot.example/", "<p>footer of all</p><p>" + "own " * 40_000)]
    hosts = {}
    read = []
    for i, u, h in pages:
        name = "" if u is None or "//" not in u else u.split("//")[1].split("/")[0].split("@")[-1].split(":")[0].lower()
        lines = [x for x in (h or "").replace("</p>", "\n").replace("<p>", "\n").split("\n") if x.strip()]
        lines = [x.strip() for x in lines]
        read.append((i, name, lines))
        hosts.setdefault(name, []).append(set(lines))
    want = []
    for i, name, lines in read:
        n = len(hosts[name])
        kept = [x for x in lines if not ((c := sum(x in s for s in hosts[name])) >= 3 and c > 0.2 * n)]
        want.append((i, name, len(lines), len(lines) - len(kept), "\n".join(kept)))
    df = spark.createDataFrame([(i, u, h, "c", 1) for i, u, h in pages], "page_id long, url string, html string, host string, lines int")
    found = [tuple(r) for r in site_lines.without_boilerplate(df).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert site_lines.without_boilerplate(df.limit(0)).count() == 0


def test_hot_host_is_cut_into_slices(spark, monkeypatch):
    """A third of the pages in one host, copies among them: no task joins more than some slices, the result is the same."""
    rows = [(i, f"http://{'hot' if i % 3 == 0 else 'h' + str(i % 50)}.example/{i}", f"<p>own {i if i % 2 else 0}<p>shared<p>{i % 40}") for i in range(1_500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(map(tuple, site_lines.without_boilerplate(df).collect()))
    monkeypatch.setattr(site_lines, "SLICE_PAGES", 20)
    totals = df.groupBy(site_lines.host(F.col("url")).alias("host")).agg(F.count("*").alias("pages"))
    hot = site_lines.slices(totals)
    assert {r["slices"] for r in hot.collect()} == {25}
    dealt = site_lines._sliced(df.withColumn("host", site_lines.host(F.col("url"))), hot)
    dealt = dealt.groupBy("host", F.pmod(F.xxhash64("page_id", "html"), "slices")).count()
    assert dealt.agg(F.max("count")).first()[0] < 60
    assert sorted(map(tuple, site_lines.without_boilerplate(df).collect())) == whole


def test_pages_are_parsed_once(spark):
    """The join reads written lines; taking them out of the pages is not in its plan."""
    df = spark.createDataFrame([(1, "http://a.example/", "<p>one<p> \x0b two \t three \x0c\r\n")], "page_id long, url string, html string")
    found = site_lines.without_boilerplate(df)
    assert "<script" not in found._jdf.queryExecution().toString()
    assert found.first()["text"] == "one\ntwo \t three"


def test_query_drops_shared_lines(spark):
    found = QUERIES["op10_site_lines"](spark, "/root/testdata/sf0.01")
    row = found.agg(F.count("*").alias("n"), F.sum("n_dropped").alias("d"), F.sum("n_lines").alias("all")).first()
    assert row["n"] == 250 and 0 < row["d"] < row["all"]
