"""WARC records, and not-modified revisits resolved against the latest earlier full response of the same URL."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ledgerlight.session import cut

LEAST_BANDS = 64  # parts of the time line that a URL's captures are looked through in, at least
BAND_ROWS = 200_000  # captures of a part, about: even a URL with a third of all has no more of them in one task
HEADERS = "array<struct<name:string,value:string>>"
SCHEMA = f"record_id string, type string, url string, date timestamp, digest string, status int, headers {HEADERS}, payload binary"
_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("url", pa.string()),
        ("date", pa.timestamp("us", tz="UTC")),
        ("digest", pa.string()),
        ("status", pa.int32()),
        ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("payload", pa.binary()),
    ]
)
# Header fields of a 304 response that never replace those of the stored response.
NOT_MERGED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
_TRACKING = r"^(utm_[^=]*|gclid|fbclid|ref)(=.*)?$"


def _fields(block: bytes) -> list[tuple[str, str]]:
    out = []
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out.append((name.strip().decode("latin-1"), value.strip().decode("utf-8", "replace")))
    return out


def _members(content: bytes) -> Iterator[bytes]:
    """A file's bytes: as they are, or its gzip members one after the other; a broken member ends the file."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content[:2] == b"\x1f\x8b":
        reader = zlib.decompressobj(31)
        try:
            yield reader.decompress(content) + reader.flush()
        except zlib.error:
            return
        content = reader.unused_data


def records(content: bytes) -> Iterator[dict]:
    """The records of a WARC file. A record without a readable head ends its part of the file."""
    import datetime

    for part in _members(content):
        at = 0
        while True:
            while part[at : at + 2] == b"\r\n":
                at += 2
            end = part.find(b"\r\n\r\n", at)
            if not part.startswith(b"WARC/", at) or end < 0:
                break
            head = {k.lower(): v for k, v in _fields(part[at:end])}
            size = head.get("content-length", "")
            if not size.isdigit():
                break
            block = part[end + 4 : end + 4 + int(size)]
            at = end + 4 + int(size)
            try:
                date = datetime.datetime.fromisoformat(head.get("warc-date", "").replace("Z", "+00:00"))
            except ValueError:
                date = None
            row = {
                "record_id": head.get("warc-record-id"),
                "type": head.get("warc-type"),
                "url": head.get("warc-target-uri"),
                "date": date,
                "digest": head.get("warc-payload-digest"),
                "status": None,
                "headers": [],
                "payload": block,
            }
            if row["type"] in ("response", "revisit") and block.startswith(b"HTTP/"):
                first, _, rest = block.partition(b"\r\n")
                lines, _, row["payload"] = (b"\r\n" + rest).partition(b"\r\n\r\n")
                code = first.split(b" ")[1:2]
                row["status"] = int(code[0]) if code and code[0].isdigit() else None
                row["headers"] = [{"name": k, "value": v} for k, v in _fields(lines)]
            yield row


def encode(row: dict) -> bytes:
    """A record as bytes, the other way round."""
    reason = {200: "OK", 304: "Not Modified"}.get(row["status"], "-")
    lines = "".join(f"{h['name']}: {h['value']}\r\n" for h in row["headers"] or [])
    block = f"HTTP/1.1 {row['status']} {reason}\r\n{lines}\r\n".encode() + (row["payload"] or b"")
    head = {
        "WARC-Type": row["type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Target-URI": row["url"],
        "WARC-Date": row["date"].strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
        "WARC-Payload-Digest": row["digest"],
        "Content-Length": str(len(block)),
    }
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None).encode() + b"\r\n" + block + b"\r\n\r\n"


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 200):
            part = b"".join(encode(row) for row in batch.slice(at, 200).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], names=["content"])


def to_warc(rows: DataFrame) -> DataFrame:
    """(content): parts of WARC files with the records of a table that has this module's columns."""
    return rows.mapInArrow(_encode_rows, "content binary")


def _parse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, size = [], 0
        for content in batch.column(0):
            for row in records(content.as_py() or b""):
                held.append(row)
                size += len(row["payload"])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                    held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def parse(files: DataFrame, content_col: str = "content") -> DataFrame:
    """The records of WARC files, plain or gzipped, given as a column of bytes (null: no records)."""
    return files.select(content_col).mapInArrow(_parse_rows, SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files below a path; a file is read by one task."""
    return parse(spark.read.format("binaryFile").load(path))


def canonical(url: Column) -> Column:
    """Host in lower case without www and default port, path, and the query without tracking fields in order.

    Scheme, user and fragment say nothing; an empty path is /.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1)
    fields = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda x: (x != "") & ~x.rlike(_TRACKING)))
    query = F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise("")
    return F.concat(host, F.when(path == "", "/").otherwise(path), query)


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def _latest(rows: DataFrame) -> DataFrame:
    """(record_id, page, source_id): for every revisit the last response of its page that is strictly earlier.

    A page's captures are never ordered together: bands of the time line keep their last response, a row per page and
    band; that is carried on over a page's bands, and only rows of a band are compared with each other.
    """
    micros = F.unix_micros("date")
    events = rows.select("record_id", "type", "page", micros.alias("t")).where("t IS NOT NULL AND record_id IS NOT NULL AND page IS NOT NULL")
    bands = max(LEAST_BANDS, -(-events.count() // BAND_ROWS))
    shares = [k / bands for k in range(1, bands)]
    bounds = events.agg(F.percentile_approx(F.col("t").cast("double"), shares, max(10_000, 10 * bands))).first()[0] or []
    # A bucketizer has two buckets at least; nothing lies in the last one of these.
    splits = [-float("inf"), *(sorted(set(bounds)) or [2.0**62]), float("inf")]
    events = Bucketizer(splits=splits, inputCol="at", outputCol="band").transform(events.withColumn("at", F.col("t").cast("double"))).drop("at")
    full = F.when(F.col("type") == "response", F.struct("t", "record_id"))
    sums = events.groupBy("page", "band").agg(F.max(full).alias("last"))
    before = Window.partitionBy("page").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("page", "band", F.max("last").over(before).alias("carried"))
    near = Window.partitionBy("page", "band").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    inside = events.withColumn("near", F.max(full).over(near)).where("type = 'revisit'")
    found = inside.join(carried, ["page", "band"])
    return found.select("record_id", "page", F.coalesce("near", "carried")["record_id"].alias("source_id"))


def resolve(rows: DataFrame) -> DataFrame:
    """Full responses and revisits as (record_id, url, page, date, outcome, source_id, headers, payload).

    `rows` are records. A response that isn't a 304 stands for itself (outcome response). A revisit gets the payload of
    the latest strictly earlier response of its canonical URL if that validates (resolved): where both have an ETag
    these must agree, weakly, or else where both have Last-Modified these must; where both have a payload digest these
    must agree too; with nothing to compare it isn't validated. Its headers are the stored ones, with the fields that a
    304 may update replaced. Otherwise it has no payload and keeps its own headers: mismatch, or no_response. Of
    responses at the same time the one with the greatest id counts. Records with the same id count as one; those
    without id or date are never a source, and a revisit without them is no_response. So is one whose URL is null or
    has no host: its page is null, and unknown URLs are not the same. Other types are left out, further columns ignored.
    """
    rows = rows.select(*_ARROW.names).where("type = 'response' OR type = 'revisit'")
    rows = rows.withColumn("page", canonical(F.col("url"))).withColumn("page", F.when(F.col("page").rlike("^[^/?]"), F.col("page"))).withColumn("type", F.when(F.col("status") == 304, "revisit").otherwise(F.col("type")))
    latest = _latest(rows).groupBy("record_id", "page").agg(F.max("source_id").alias("source_id"))
    revisits = rows.where("type = 'revisit'").drop("payload").join(latest, ["record_id", "page"], "left")
    stored = rows.where("type = 'response' AND record_id IS NOT NULL").groupBy("record_id").agg(F.min(F.struct("payload", "headers", "digest")).alias("stored"))
    both = revisits.join(stored.withColumnRenamed("record_id", "source_id"), "source_id", "left")
    old = F.col("stored.headers")

    def agree(a: Column, b: Column, otherwise: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(otherwise)

    def tag(h: Column) -> Column:
        return F.regexp_replace(_header(h, "etag"), "^W/", "")

    digests = agree(F.col("digest"), F.col("stored.digest"), F.lit(None).cast("boolean"))
    dates = agree(_header(F.col("headers"), "last-modified"), _header(old, "last-modified"), F.lit(None).cast("boolean"))
    validators = agree(tag(F.col("headers")), tag(old), dates)
    holds = F.coalesce(validators, digests, F.lit(False)) & F.coalesce(digests, F.lit(True))
    outcome = F.when(F.col("stored").isNull(), "no_response").when(holds, "resolved").otherwise("mismatch")
    news = F.filter("headers", lambda h: ~F.lower(h["name"]).isin(*NOT_MERGED))
    names = F.transform(news, lambda h: F.lower(h["name"]))
    merged = F.concat(F.filter(old, lambda h: ~F.array_contains(names, F.lower(h["name"]))), news)
    both = both.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "page",
        "date",
        "outcome",
        F.when(F.col("outcome") != "no_response", F.col("source_id")).alias("source_id"),
        F.when(F.col("outcome") == "resolved", merged).otherwise(F.col("headers")).alias("headers"),
        F.when(F.col("outcome") == "resolved", F.col("stored.payload")).alias("payload"),
    )
    own = rows.where("type = 'response'")
    return both.union(own.select("record_id", "url", "page", "date", F.lit("response"), F.col("record_id"), "headers", "payload"))


def crawl(pages: DataFrame) -> DataFrame:
    """Records derived from a table of pages (page_id, url, html), some hours apart.

    Each page is a response and, a week later, a 304 revisit with its ETag; every seventh has a revisit with another
    ETag as well, every eleventh one from before its own response.
    """

    def headers(*pairs: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("name"), v.cast("string").alias("value")) for k, v in pairs])

    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    day = F.lit(86_400)
    at = F.lit(1_700_000_000) + F.col("page_id") * 60
    rows = pages.where("page_id IS NOT NULL").select("page_id", "url", "html", tag.alias("tag"), at.alias("at"))
    kinds = F.array(
        F.lit("response"),
        F.lit("same"),
        F.when(F.col("page_id") % 7 == 0, "other"),
        F.when(F.col("page_id") % 11 == 0, "early"),
    )
    rows = rows.select("*", F.explode(F.array_compact(kinds)).alias("kind"))
    full = F.col("kind") == "response"
    moved = F.when(full, 0).when(F.col("kind") == "same", 7 * day).when(F.col("kind") == "other", 8 * day).otherwise(-3 * day)
    own_tag = F.when(F.col("kind") == "other", F.lit('"changed"')).otherwise(F.col("tag"))
    length = F.when(full, F.octet_length("html")).otherwise(0)
    return rows.select(
        F.concat(F.lit("urn:page:"), F.col("page_id").cast("string"), F.lit(":"), F.col("kind")).alias("record_id"),
        F.when(full, "response").otherwise("revisit").alias("type"),
        "url",
        F.timestamp_seconds(F.col("at") + moved).alias("date"),
        F.when(full, F.concat(F.lit("md5:"), F.md5(F.coalesce("html", F.lit(""))))).alias("digest"),
        F.when(full, 200).otherwise(304).alias("status"),
        headers(("Content-Type", F.lit("text/html")), ("ETag", own_tag), ("Content-Length", length), ("X-Seen", F.col("kind"))).alias("headers"),
        F.when(full, F.coalesce("html", F.lit("")).cast("binary")).otherwise(F.lit(b"")).alias("payload"),
    )


def crawled(pages: DataFrame) -> DataFrame:
    """The pages' records written as WARC parts into the shared folder, read back and resolved."""
    return resolve(cut(parse(to_warc(crawl(pages))), "records"))
