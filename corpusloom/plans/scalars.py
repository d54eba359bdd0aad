"""Registered queries that show scalar functions, gates and scores over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import address, text
from corpusloom.functions.decode import undefined_bytes
from corpusloom.operators import corpus, gates, merge
from corpusloom.plans import ingest
from corpusloom.session import table
from corpusloom.sources import pages

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__], SQL[function.__name__] = function, sql
        return function

    return register


def _bodies(spark, d):
    return table(spark, d, "releases").filter("body IS NOT NULL").select("id", "title", "date", "url", "body")


_SPACE = r"[\s\x{0B}\x{85}\x{1C}-\x{1F}\p{Z}]"
#: A body that carries the damage these functions are about, made of the corpus' own.
_MADE = "body || CASE WHEN id % 3 = 0 THEN chr(150) || 'x' || chr(129) WHEN id % 3 = 1 THEN chr(153) ELSE '' END"


def _made():
    return F.concat("body", F.when(F.col("id") % 3 == 0, "\x96x\x81").when(F.col("id") % 3 == 1, "\x99").otherwise(""))


@query(rf"SELECT id, md5(trim(regexp_replace(body, '{_SPACE}+', ' ', 'g'))) AS digest FROM releases WHERE body IS NOT NULL")
def norm_ws(spark, d):
    return _bodies(spark, d).select("id", F.md5(text.collapse("body")).alias("digest"))


@query(r"SELECT id, md5(trim(regexp_replace(regexp_replace(regexp_replace(body, '\r\n?|\x0C', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))) AS digest FROM releases WHERE body IS NOT NULL")
def normalize_layout(spark, d):
    return _bodies(spark, d).select("id", F.md5(text.normal_layout("body")).alias("digest"))


@query(r"SELECT id, len(regexp_extract_all(body, '[a-z][A-Z]'))::INT AS capitals, len(regexp_extract_all(body, '\d{2,}[.,]\d+[.,]\d{3,}'))::INT AS merged FROM releases WHERE body IS NOT NULL")
def artefacts(spark, d):
    return _bodies(spark, d).select("id", text.artefacts("body").alias("a")).select("id", F.col("a.inner_capitals").alias("capitals"), F.col("a.merged").alias("merged"))


@query(f"SELECT id, md5(translate({_MADE}, chr(150) || chr(153), '–™')) AS digest FROM releases WHERE body IS NOT NULL AND NOT regexp_matches(body, '[\\x{{80}}-\\x{{9F}}]')")
def undo_c1(spark, d):
    return _bodies(spark, d).filter(~F.col("body").rlike("[\\x{80}-\\x{9F}]")).select("id", F.md5(text.undo_c1(_made())).alias("digest"))


@query("SELECT id, len(regexp_extract_all(" + _MADE + r", '[\x{81}\x{8D}\x{8F}\x{90}\x{9D}]'))::INT AS n FROM releases WHERE body IS NOT NULL")
def undefined_bytes_left(spark, d):
    return _bodies(spark, d).withColumn("body", _made()).select("id", F.size(undefined_bytes()).alias("n"))


@query("SELECT id, CASE WHEN url <> '' AND id % 2 = 0 THEN url ELSE '/press/' || CASE WHEN s = '' THEN 'release' ELSE s END || '-' || CASE WHEN coalesce(date, '') = '' THEN 'undated' ELSE date END END AS url FROM (SELECT id, url, date, trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM releases)")
def synthetic_url(spark, d):
    rows = table(spark, d, "releases")
    return rows.select("id", text.synthetic_url(F.when(F.col("id") % 2 == 0, F.col("url")), F.col("title"), F.col("date")).alias("url"))


_KEY = "CASE WHEN regexp_matches(detail_id, '^[0-9]{14}$') THEN coalesce('https://web.archive.example/web/' || detail_id || 'id_/' || r.url, '') ELSE '' END"


@query(f"SELECT r.id, {_KEY} <> '' AND coalesce(CASE WHEN r.id % 2 = 0 THEN o.origin_url END, {_KEY}) = {_KEY} AS own FROM releases r LEFT JOIN body_origin o ON r.url = o.url")
def own_page(spark, d):
    """Rows whose text came from the page that their own reference leads to; every other row's
    recorded origin is left aside."""
    rows = table(spark, d, "releases").select("id", "url", "detail_id").join(table(spark, d, "body_origin"), "url", "left")
    return rows.withColumn("origin_url", F.when(F.col("id") % 2 == 0, F.col("origin_url"))).select("id", address.own_page().alias("own"))


@query(r"SELECT id, CASE WHEN regexp_matches(date, '^\d{1,2}\.\d{1,2}\.\d{4}$') THEN regexp_extract(date, '(\d{4})$', 1) || '-' || lpad(regexp_extract(date, '^\d+\.(\d+)', 1), 2, '0') || '-' || lpad(regexp_extract(date, '^(\d+)', 1), 2, '0') END AS iso FROM releases WHERE regexp_matches(date, '^\d{1,2}\.\d{1,2}\.\d{4}$')")
def german_dates(spark, d):
    rows = table(spark, d, "releases").filter(F.col("date").rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"))
    return rows.select("id", text.german_date(F.col("date")).alias("iso"))


_MONTH = "CASE lower(regexp_extract(date, '([A-Za-z]+) \\d', 1)) WHEN 'january' THEN '01' WHEN 'february' THEN '02' WHEN 'march' THEN '03' WHEN 'april' THEN '04' WHEN 'may' THEN '05' WHEN 'june' THEN '06' WHEN 'july' THEN '07' WHEN 'august' THEN '08' WHEN 'september' THEN '09' WHEN 'october' THEN '10' WHEN 'november' THEN '11' ELSE '12' END"
_LONG = r"^(January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}, \d{4}$"


@query(f"SELECT id, regexp_extract(date, '(\\d{{4}})$', 1) || '-' || {_MONTH} || '-' || lpad(regexp_extract(date, ' (\\d{{1,2}}),', 1), 2, '0') AS iso FROM releases WHERE regexp_matches(date, '{_LONG}')")
def english_long_dates(spark, d):
    return table(spark, d, "releases").filter(F.col("date").rlike(_LONG)).select("id", text.german_date(F.col("date")).alias("iso"))


_PAIR = "CASE id % 4 WHEN 0 THEN body || ' more' WHEN 1 THEN replace(body, ' ', '  ') WHEN 2 THEN substr(body, 1, length(body) // 2) ELSE body END"


@query(f"SELECT id, length({_PAIR}) >= length(body) AS not_shorter, regexp_replace({_PAIR}, '(?:{_SPACE}|•)+', '', 'g') = regexp_replace(body, '(?:{_SPACE}|•)+', '', 'g') AS same_text FROM releases WHERE body IS NOT NULL")
def gates_of_rewrites(spark, d):
    """The gates that stay within the JVM, against a longer, a wider, a shorter and the same text."""
    kind = F.col("id") % 4
    new = F.when(kind == 0, F.concat("body", F.lit(" more"))).when(kind == 1, F.replace("body", F.lit(" "), F.lit("  "))).when(kind == 2, F.expr("substr(body, 1, CAST(length(body) / 2 AS INT))")).otherwise(F.col("body"))
    rows = _bodies(spark, d).withColumn("new", new)
    return rows.select("id", gates.not_shorter("body", "new").alias("not_shorter"), gates.same_text("body", "new").alias("same_text"))


@query("SELECT id, CASE WHEN coalesce(title, '') = '' THEN 0 ELSE greatest(length(coalesce(body, '')), 1) END AS article, CASE WHEN length(coalesce(body, '')) > 0 THEN length(body) WHEN coalesce(title, '') <> '' THEN 1 ELSE 0 END AS detail FROM releases")
def scores(spark, d):
    """What a capture with each row's title and text would be worth, as article and as page."""
    from corpusloom.plans.pipeline import detail_score

    rows = table(spark, d, "releases")
    return rows.select("id", ingest.article_score(F.col("title"), F.col("body")).alias("article"), detail_score().alias("detail"))


@query("SELECT url, CASE WHEN hex(content) LIKE '25504446%' OR hex(content) LIKE 'D0CF11E0%' THEN octet_length(content) ELSE 0 END AS score FROM page_cache")
def attachment_score(spark, d):
    """The worth of cached attachments, by their bytes in place of their text."""
    size = F.repeat(F.lit("x"), F.octet_length("content"))
    return table(spark, d, "page_cache").select("url", ingest.attachment_score(pages.kind_of(), size).cast("long").alias("score"))


@query("""WITH v AS (SELECT DISTINCT url, CASE WHEN contains(url, 'mirror-1.example') THEN 'mirror-1.example' WHEN contains(url, 'mirror-2.example') THEN 'mirror-2.example' WHEN contains(url, 'mirror-3.example') THEN 'mirror-3.example' END AS own FROM releases WHERE body_html IS NULL AND url IS NOT NULL)
 SELECT url, CASE WHEN own IS NULL THEN 1 ELSE 3 END AS variants FROM v""")
def mirror_variants(spark, d):
    rows = table(spark, d, "releases").filter("body_html IS NULL AND url IS NOT NULL").select("url").distinct()
    return pages.domain_variants(rows, ["mirror-1.example", "mirror-2.example", "mirror-3.example"]).groupBy("url").agg(F.count("*").cast("int").alias("variants"))


@query("""WITH s AS (SELECT url, max(id) AS id, arg_max(grade, id) AS grade FROM releases WHERE id % 2 = 0 AND url IS NOT NULL GROUP BY url), n AS (SELECT url, min(id) AS ord FROM releases WHERE id % 2 = 1 AND url IS NOT NULL GROUP BY url)
 SELECT url, coalesce(grade, '') AS grade FROM s UNION ALL SELECT url, 'full' FROM n WHERE url NOT IN (SELECT url FROM s)""")
def stored_with_grades(spark, d):
    """Rows that arrive without a grade are stored as full ones."""
    rows = table(spark, d, "releases").filter("url IS NOT NULL")
    stored = rows.filter("id % 2 = 0").groupBy("url").agg(F.max("id").alias("id"), F.max_by(F.coalesce("grade", F.lit("")), "id").alias("grade"))
    new = rows.filter("id % 2 = 1").select("url", F.lit("t").alias("title"), F.lit(None).cast("string").alias("body"), F.lit(None).cast("string").alias("body_html"), F.lit(None).cast("string").alias("grade"), F.col("id").alias("ord"))
    return stored.select("url", "grade").unionByName(merge.insert_releases(stored, new).select("url", "grade"))


@query("SELECT id, date FROM releases WHERE date IS NOT NULL ORDER BY date DESC, id DESC LIMIT 201")
def order_date(spark, d):
    """The largest page there is, newest first."""
    return corpus.browse(table(spark, d, "releases").filter("date IS NOT NULL").select("id", "date"), 10_000)
