"""The registered queries of this folder: each applies its operator to its whole table and returns the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.llm import collocations, decontaminate, imatch, language, licenses, minhash, mixing, pii, quality, search, site_lines, token_files, warc
from ledgerlight.session import configure, cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(job):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return job(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_dedup")
def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id"), 5, 0))
    model = language.fit(docs.where("NOT held_out"))
    return language.identify(docs, model, keep=("doc_id", "held_out"))


@query("op3_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id"), 3, 1))
    measured = cut(quality.features(docs, keep=("doc_id", "held_out")), "features")
    model = quality.fit(measured.where("NOT held_out"), table(spark, sf_dir, "labels"))
    return quality.score(measured, model, keep=("doc_id", "held_out"))


MIXING_SQL = """
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
         / greatest(coalesce(1 / (1 + abs(ln(greatest(length(text)::DOUBLE / greatest(size, 1), 1.0) / 6))), 0.25), 1e-6) AS key
  FROM d
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS turn FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM o
),
t AS (
  SELECT source, source_size, least(3.0 * source_size, w * (SELECT arg_min(level, turn) FROM l WHERE 3.0 * source_size / w >= level)) AS target
  FROM l
),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) AS upto,
         sum(k.size) OVER (PARTITION BY k.source, k.key, k.doc_id) AS own
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 4) AS target,
       (size * (epochs + CASE WHEN rest > 0 AND (upto <= rest OR (upto - own < rest AND upto - rest < rest - (upto - own))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query("op4_source_mix", MIXING_SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 4))


@query("op6_imatch")
def imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return imatch.edited(docs, imatch.lexicon(docs)).withColumnRenamed("id", "doc_id")


def _words_sql(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents),
b AS (SELECT item_id, {_words_sql('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, s, s + least(len(w), 13) - 1), ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
found AS (
  SELECT p.doc_id, p.s, p.n, item_id
  FROM (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS words
        FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)) p
  JOIN win ON win.n = p.n AND win.words = p.words
),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""


@query("op7_decontamination", DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")


@query("op8_token_files")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenised(table(spark, sf_dir, "documents"))


@query("op9_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


@query("op5_warc_revisits")
def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.crawled(table(spark, sf_dir, "pages"))
    headers = F.array_join(F.transform("headers", lambda h: F.concat_ws(":", h["name"], h["value"])), "\n")
    return found.select("record_id", "page", "outcome", "source_id", headers.alias("headers"), F.sha2("payload", 256).alias("payload_sha256"))


_BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
SITE_LINES_SQL = f"""
WITH t AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '')) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is)<script\\b.*?</script\\s*>', '', 'g'), '(?is)<style\\b.*?</style\\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
           '{_BLOCK}', chr(10), 'g'), '<[^>]*>', '', 'g') AS body
  FROM pages
),
p AS (
  SELECT *, [y FOR y IN [trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
                      FOR x IN string_split(replace(body, chr(13), chr(10)), chr(10))] IF y <> ''] AS lines
  FROM t
),
n AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY ALL),
h AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
b AS (SELECT host, list(line) AS common FROM n JOIN h USING (host) WHERE n >= 3 AND n > 0.2 * pages GROUP BY host),
k AS (SELECT page_id, p.host, lines, [x FOR x IN lines IF NOT list_contains(coalesce(common, []), x)] AS kept FROM p LEFT JOIN b ON b.host = p.host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped, array_to_string(kept, chr(10)) AS text FROM k
"""


@query("op10_site_lines", SITE_LINES_SQL)
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.without_boilerplate(table(spark, sf_dir, "pages"))


@query("op11_license_notices")
def license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def _terms_sql(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, {_terms_sql('text')} AS w FROM documents),
b AS (SELECT item_id, term, count(*) AS often FROM (SELECT item_id, unnest({_terms_sql('text')}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark) i) GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, len AS n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM d) x WHERE term IN (SELECT term FROM b) GROUP BY ALL),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, c GROUP BY term, n_docs),
s AS (
  SELECT item_id, doc_id, sum(often * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM tf JOIN wt USING (term) JOIN b USING (term), c GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) r WHERE rank <= 20
"""


@query("op12_ranked_search", SEARCH_SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


COLLOCATIONS_SQL = """
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM t),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
f AS (
  SELECT lang, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100
),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
s AS (
  SELECT c.lang, c.phrase, c.a, c.size, cut, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * c.a::HUGEINT * n.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM c) c JOIN n ON n.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(list_slice(w, 1, cut), ' ')
  JOIN f y ON y.lang = c.lang AND y.k = size - cut AND y.phrase = array_to_string(list_slice(w, cut + 1, size), ' ')
),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM s) q WHERE place = 1),
i AS (
  SELECT lang, array_to_string(list_slice(w, u, u + v - 1), ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - v + 2)) AS u FROM (SELECT *, unnest(range(2, size)) AS v FROM c)) GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score
FROM (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 100 * a) q
WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATIONS_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
