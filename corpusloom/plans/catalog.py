"""The registered queries over the corpus tables, each beside its SQL.

Plans are DataFrames of the operators; the SQL says the same in ANSI terms for DuckDB.
Every query runs over its whole tables; limits stand only where a page or a top list is
what is asked for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import address, flags, text
from corpusloom.operators import corpus, dedupe, fts, merge, search
from corpusloom.session import shared_dir, spread, table
from corpusloom.sources import pages

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def releases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "releases")


def origins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "body_origin")


def calls(spark: SparkSession, d: str) -> DataFrame:
    """The call log without its exact repeats."""
    return table(spark, d, "wayback_calls").dropDuplicates(["id"])


_MOJIBAKE = r"(contains(coalesce(body, ''), 'â€') OR contains(coalesce(body, ''), 'Ã') OR regexp_matches(coalesce(body, ''), '[\x{80}-\x{9F}]'))"
_PLAIN = "(body_html IS NULL AND NOT lower(coalesce(url, '')) LIKE '%.pdf' AND NOT lower(coalesce(url, '')) LIKE '%.doc')"
_NODATE, _SHORT, _TEASER = "coalesce(date, '') = ''", "length(coalesce(body, '')) < 300", "coalesce(grade IN ('teaser', 'stub'), false)"
_FOLD = f"translate(lower({{}}), '{text.ACCENTS}', '{text.BARE}')"
_COUNT = "count(CASE WHEN {} THEN 1 END)"
_SOURCES = f"""SELECT source, count(*) AS n, min(CASE WHEN date <> '' THEN date END) AS first, max(CASE WHEN date <> '' THEN date END) AS last,
 {_COUNT.format(_TEASER)} AS teaser, {_COUNT.format(_SHORT)} AS short, {_COUNT.format(_NODATE)} AS nodate, {_COUNT.format(_MOJIBAKE)} AS mojibake, {_COUNT.format(_PLAIN)} AS plain
 FROM releases GROUP BY source"""
_PAGE = "CASE WHEN strpos(o.origin_url, 'id_/') > 0 THEN substr(o.origin_url, strpos(o.origin_url, 'id_/') + 4) END"
_KEY = "CASE WHEN regexp_matches(detail_id, '^[0-9]{14}$') THEN coalesce('https://web.archive.example/web/' || detail_id || 'id_/' || r.url, '') ELSE '' END"
_ROWS = f"SELECT r.id, coalesce(r.source, '') AS source, coalesce(r.date, '') AS date, coalesce(r.url, '') AS url, coalesce(r.title, '') AS title, length(coalesce(body, '')) AS body_len, {_MOJIBAKE} AS damaged, o.origin_url FROM releases r LEFT JOIN body_origin o ON r.url = o.url"


# -- scans, projections, filters ---------------------------------------------------------


@query(f"SELECT count(*) AS total, {_COUNT.format("grade = 'teaser'")} AS teaser, {_COUNT.format("grade = 'stub'")} AS stub, count(o.origin_url) AS wayback, {_COUNT.format("o.origin_url IS NULL AND coalesce(detail_id, '') <> ''")} AS platform_id, {_COUNT.format(_SHORT)} AS short, {_COUNT.format("length(coalesce(body, '')) = 0")} AS empty, {_COUNT.format(_NODATE)} AS nodate, {_COUNT.format(_MOJIBAKE)} AS mojibake, {_COUNT.format(_PLAIN.replace('url', 'r.url'))} AS plain FROM releases r LEFT JOIN body_origin o ON r.url = o.url")
def quality_counts(spark, d):
    return corpus.quality_counts(releases(spark, d), origins(spark, d))


@query(_ROWS)
def project_row(spark, d):
    return corpus.list_rows(releases(spark, d), origins(spark, d)).select("id", "source", "date", "url", "title", "body_len", "damaged", "origin_url")


def _flag(name: str, condition: str) -> None:
    def run(spark, d):
        return releases(spark, d).filter(flags.FLAGS[name]()).select("id", "source")

    QUERIES[f"flag_{name}"], SQL[f"flag_{name}"] = run, f"SELECT id, source FROM releases WHERE {condition}"


for _name, _condition in (("teaser", _TEASER), ("short", _SHORT), ("nodate", _NODATE), ("mojibake", _MOJIBAKE), ("plain", _PLAIN)):
    _flag(_name, _condition)


@query(r"SELECT id FROM releases WHERE regexp_matches(coalesce(body, ''), '[\x{80}-\x{9F}]') OR regexp_matches(coalesce(body, ''), '[ÃÂĂâ][\x{80}-\x{17F}\x{20AC}]')")
def damaged_regex(spark, d):
    return releases(spark, d).filter(flags.damaged()).select("id")


@query(f"SELECT id FROM releases WHERE {_SHORT} AND {_PLAIN} AND source IN ('kelvaro_news', 'pazur_pl', 'brixton_de') AND date >= '2000' AND date <= '2015-12'")
def filter_search(spark, d):
    return corpus.where(releases(spark, d), ["kelvaro_news", "pazur_pl", "brixton_de"], "2000", "2015-12", ["short", "plain", "unknown"]).select("id")


@query("SELECT url FROM page_cache WHERE lower(url) LIKE '%id_/http://%.asp'")
def listing_pattern_scan(spark, d):
    return pages.like_scan(table(spark, d, "page_cache"), "%id\\_/http://%.asp")


@query("SELECT url FROM page_cache WHERE lower(url) LIKE '%brixton-de.example%'")
def host_scan(spark, d):
    return pages.like_scan(table(spark, d, "page_cache"), "%brixton-de.example%")


@query("SELECT source, url FROM releases WHERE url IS NOT NULL")
def source_urls(spark, d):
    return releases(spark, d).filter("url IS NOT NULL").select("source", "url")


@query("SELECT url, sha256(content) AS sha FROM page_cache")
def content_hash(spark, d):
    return table(spark, d, "page_cache").select("url", pages.content_hash().alias("sha"))


@query("SELECT content_sha256, count(*) AS urls, min(url) AS first_url FROM page_cache WHERE content_sha256 IS NOT NULL GROUP BY content_sha256 HAVING count(*) > 1")
def same_bytes(spark, d):
    return pages.same_bytes(table(spark, d, "page_cache"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN h LIKE '25504446%' THEN 'pdf' WHEN h LIKE 'D0CF11E0%' THEN 'doc' WHEN h LIKE '7B5C727466%' THEN 'rtf'
 WHEN regexp_matches(h, '^(20|09|0D|0A)*3C') THEN 'html' ELSE 'unrecognised' END AS kind FROM (SELECT hex(content) AS h FROM page_cache)) GROUP BY kind""")
def kind_of(spark, d):
    return table(spark, d, "page_cache").groupBy(pages.kind_of().alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT url, max(CAST(fetched_at AS DOUBLE)) AS fetched_at FROM page_cache GROUP BY url")
def latest_pages(spark, d):
    return table(spark, d, "page_cache").groupBy("url").agg(F.max("fetched_at").alias("fetched_at"))


@query("SELECT DISTINCT regexp_extract(origin_url, '/web/(\\d{14})id_/', 1) AS ts FROM body_origin")
def capture_timestamps(spark, d):
    return origins(spark, d).select(address.timestamp_of("origin_url").alias("ts")).distinct()


@query("SELECT page, max(ts) AS ts FROM (SELECT regexp_extract(url, '/web/(\\d{14})id_/', 1) AS ts, substr(url, strpos(url, 'id_/') + 4) AS page FROM page_cache WHERE strpos(url, 'id_/') > 0) GROUP BY page")
def latest_snapshot(spark, d):
    cache = table(spark, d, "page_cache").select(address.timestamp_of("url").alias("ts"), address.page_of("url").alias("page"))
    return cache.filter("page IS NOT NULL").groupBy("page").agg(F.max("ts").alias("ts"))


# -- addresses ----------------------------------------------------------------------------


@query(f"SELECT r.id, {_KEY} AS capture, coalesce(o.origin_url, {_KEY}) AS origin_key, {_PAGE} AS page, CASE WHEN strpos(o.origin_url, 'id_/') > 0 THEN substr(o.origin_url, 1, strpos(o.origin_url, 'id_/') - 1) || '/' || {_PAGE} ELSE o.origin_url END AS viewer FROM releases r LEFT JOIN body_origin o ON r.url = o.url")
def address_algebra(spark, d):
    rows = releases(spark, d).join(origins(spark, d), "url", "left")
    return rows.select("id", address.capture_key().alias("capture"), address.origin_key().alias("origin_key"), address.page_of("origin_url").alias("page"), address.viewer_url("origin_url").alias("viewer"))


@query(f"SELECT origin_class, count(*) AS n FROM (SELECT CASE WHEN o.origin_url = {_KEY} THEN 'computed' WHEN {_PAGE} = r.url THEN 'located' ELSE 'inferred' END AS origin_class FROM body_origin o JOIN releases r ON o.url = r.url) GROUP BY 1")
def origin_class(spark, d):
    rows = origins(spark, d).join(releases(spark, d).select("url", "detail_id"), "url")
    return rows.groupBy(address.origin_class().alias("origin_class")).agg(F.count("*").alias("n"))


@query(f"SELECT kind, count(*) AS n FROM (SELECT CASE WHEN p IS NULL OR p = url THEN NULL WHEN lower(regexp_extract(p, '[^/]*$')) = lower(regexp_extract(url, '[^/]*$')) THEN 'mirror' ELSE 'other' END AS kind FROM (SELECT o.url, {_PAGE} AS p FROM body_origin o JOIN releases r ON o.url = r.url)) GROUP BY 1")
def capture_kind(spark, d):
    rows = origins(spark, d).join(releases(spark, d).select("url"), "url")
    return rows.groupBy(address.capture_kind().alias("kind")).agg(F.count("*").alias("n"))


@query(f"SELECT r.id FROM body_origin o JOIN releases r ON o.url = r.url WHERE NOT (o.origin_url = {_KEY}) AND NOT regexp_matches(lower(regexp_extract(r.url, '^[^?]*')), '\\.(pdf|doc)$')")
def inferred_only(spark, d):
    rows = origins(spark, d).join(releases(spark, d).select("id", "url", "detail_id"), "url")
    attachment = F.lower(F.regexp_extract("url", "^[^?]*", 0)).rlike(r"\.(pdf|doc)$")
    return rows.filter((F.col("origin_url") != address.capture_key()) & ~attachment).select("id")


@query("SELECT DISTINCT lower(regexp_extract(url, '[^/]*$')) AS name FROM releases WHERE url IS NOT NULL")
def attachment_name(spark, d):
    return releases(spark, d).filter("url IS NOT NULL").select(address.base_name("url").alias("name")).distinct()


@query("SELECT id, replace(url, ':80/', '/') AS url FROM releases")
def normalize_url(spark, d):
    return releases(spark, d).select("id", F.replace("url", F.lit(":80/"), F.lit("/")).alias("url"))


# -- joins --------------------------------------------------------------------------------


@query("SELECT r.id, o.origin_url FROM releases r JOIN body_origin o ON r.url = o.url")
def join_origin_inner(spark, d):
    return releases(spark, d).select("id", "url").join(origins(spark, d), "url").select("id", "origin_url")


@query("SELECT o.url, c.content_sha256 FROM body_origin o JOIN page_cache c ON o.origin_url = c.url")
def join_origin_cache(spark, d):
    cache = table(spark, d, "page_cache").select(F.col("url").alias("origin_url"), "content_sha256")
    return origins(spark, d).join(cache, "origin_url").select("url", "content_sha256")


@query("SELECT r.id, octet_length(c.content) AS size FROM releases r JOIN body_origin o ON r.url = o.url JOIN page_cache c ON o.origin_url = c.url WHERE hex(c.content) LIKE '25504446%'")
def join_attachments(spark, d):
    cache = table(spark, d, "page_cache").filter(pages.kind_of() == "pdf").select(F.col("url").alias("origin_url"), F.octet_length("content").cast("long").alias("size"))
    return releases(spark, d).select("id", "url").join(origins(spark, d), "url").join(cache, "origin_url").select("id", "size")


@query("""SELECT r.id, c.url AS capture FROM (SELECT r.id, r.url, CASE WHEN regexp_matches(detail_id, '^[0-9]{14}$') AND o.url IS NULL THEN detail_id ELSE regexp_extract(o.origin_url, '/web/(\\d{14})id_/', 1) END AS ts FROM releases r LEFT JOIN body_origin o ON r.url = o.url) r
 JOIN page_cache c ON c.url = 'https://web.archive.example/web/' || r.ts || 'id_/' || r.url""")
def join_computed_key(spark, d):
    """Rows with the cached capture whose address their time and their own address make."""
    rows = releases(spark, d).select("id", "url", "detail_id").join(origins(spark, d).select("url", "origin_url", F.lit(True).alias("there")), "url", "left")
    ts = F.when(address.is_timestamp("detail_id") & F.col("there").isNull(), F.col("detail_id")).otherwise(address.timestamp_of("origin_url"))
    rows = rows.select("id", address.capture_url(ts, F.col("url")).alias("capture"))
    return rows.join(table(spark, d, "page_cache").select(F.col("url").alias("capture")), "capture").select("id", "capture")


@query("SELECT DISTINCT origin_url FROM body_origin o WHERE NOT EXISTS (SELECT 1 FROM page_cache c WHERE c.url = o.origin_url)")
def uncached_origins(spark, d):
    return origins(spark, d).select("origin_url").distinct().join(table(spark, d, "page_cache").select(F.col("url").alias("origin_url")), "origin_url", "left_anti")


@query("""WITH r AS (SELECT lower(regexp_extract(url, '[^/]*$')) AS name, count(*) AS rows_n FROM releases WHERE url IS NOT NULL GROUP BY 1),
 c AS (SELECT lower(regexp_extract(url, '[^/]*$')) AS name, count(*) AS pages_n FROM page_cache WHERE url IS NOT NULL GROUP BY 1)
 SELECT coalesce(r.name, c.name) AS name, coalesce(rows_n, 0) AS rows_n, coalesce(pages_n, 0) AS pages_n FROM r FULL JOIN c ON r.name = c.name""")
def join_basename(spark, d):
    side = lambda df, n: df.filter("url IS NOT NULL").groupBy(address.base_name("url").alias("name")).agg(F.count("*").alias(n))
    both = side(releases(spark, d), "rows_n").join(side(table(spark, d, "page_cache"), "pages_n"), "name", "full")
    return both.select("name", F.coalesce("rows_n", F.lit(0)).alias("rows_n"), F.coalesce("pages_n", F.lit(0)).alias("pages_n"))


@query("SELECT r.id, t.slug, t.label FROM releases r LEFT JOIN source_tags t ON r.source = t.source")
def join_company(spark, d):
    rows = corpus.company_of(releases(spark, d).select("id", "source"), table(spark, d, "source_tags"))
    return rows.select("id", F.when(F.col("slug") != "other", F.col("slug")).alias("slug"), F.when(F.col("label") != "other", F.col("label")).alias("label"))


@query("SELECT r.id, max(l.date) AS listed FROM releases r JOIN terratec_early__listing_1 l ON r.title = l.title WHERE r.title <> '' GROUP BY r.id")
def join_title_date(spark, d):
    listed = table(spark, d, "terratec_early__listing_1").filter("title <> ''").groupBy("title").agg(F.max("date").alias("listed"))
    return releases(spark, d).filter("title <> ''").select("id", "title").join(listed, "title").select("id", "listed")


@query("SELECT DISTINCT l.url FROM terratec_early__listing_1 l WHERE NOT EXISTS (SELECT 1 FROM terratec_early__listing_1 e WHERE e.lang = 'en' AND e.date_str = l.date_str) AND l.lang = 'de'")
def join_cross_language(spark, d):
    rows = table(spark, d, "terratec_early__listing_1")
    return rows.filter("lang = 'de'").join(rows.filter("lang = 'en'").select("date_str"), "date_str", "left_anti").select("url").distinct()


# -- aggregates ---------------------------------------------------------------------------


@query(_SOURCES)
def list_sources(spark, d):
    return corpus.list_sources(releases(spark, d))


@query(f"SELECT coalesce(t.slug, 'other') AS slug, coalesce(t.label, 'other') AS label, sum(n)::BIGINT AS n, sum(teaser)::BIGINT AS teaser, sum(short)::BIGINT AS short, sum(nodate)::BIGINT AS nodate, sum(mojibake)::BIGINT AS mojibake, sum(plain)::BIGINT AS plain, min(first) AS first, max(last) AS last, string_agg(s.source, ',' ORDER BY s.source) AS sources FROM ({_SOURCES}) s LEFT JOIN source_tags t ON s.source = t.source GROUP BY 1, 2")
def roll_up(spark, d):
    return corpus.roll_up(corpus.list_sources(releases(spark, d)), table(spark, d, "source_tags"))


@query("SELECT outcome, kind, count(*) AS n, round(avg(duration), 6) AS mean FROM (SELECT DISTINCT * FROM wayback_calls) GROUP BY outcome, kind")
def outcome_counts(spark, d):
    return calls(spark, d).groupBy("outcome", "kind").agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("mean"))


@query("SELECT kind, count(CASE WHEN outcome = 'ok' THEN 1 END) AS ok, count(CASE WHEN outcome = 'timeout' THEN 1 END) AS timeout, count(CASE WHEN outcome = '503' THEN 1 END) AS o503, count(CASE WHEN outcome = '429' THEN 1 END) AS o429 FROM (SELECT DISTINCT * FROM wayback_calls) GROUP BY kind")
def outcome_pivot(spark, d):
    wide = calls(spark, d).groupBy("kind").pivot("outcome", ["ok", "timeout", "503", "429"]).count().na.fill(0)
    return wide.select("kind", "ok", "timeout", F.col("503").alias("o503"), F.col("429").alias("o429"))


@query("SELECT url, count(*) AS n, max(attempt) AS attempts, count(CASE WHEN outcome <> 'ok' THEN 1 END) AS failed FROM (SELECT DISTINCT * FROM wayback_calls) WHERE url IS NOT NULL GROUP BY url")
def calls_by_url(spark, d):
    return calls(spark, d).filter("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("n"), F.max("attempt").alias("attempts"), corpus.count_if(F.col("outcome") != "ok").alias("failed"))


@query("""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN r < 0.2 THEN '0.0' WHEN r < 0.4 THEN '0.2' WHEN r < 0.6 THEN '0.4' WHEN r < 0.8 THEN '0.6' WHEN r < 1 THEN '0.8' ELSE '1.0' END AS bucket
 FROM (SELECT length(coalesce(body, '')) * 1.0 / length(body_html) AS r FROM releases WHERE length(body_html) > 0)) GROUP BY bucket""")
def retention_histogram(spark, d):
    rows = releases(spark, d).filter(F.length("body_html") > 0).select((flags.size() / F.length("body_html")).alias("r"))
    bucket = F.when(F.col("r") < 0.2, "0.0").when(F.col("r") < 0.4, "0.2").when(F.col("r") < 0.6, "0.4").when(F.col("r") < 0.8, "0.6").when(F.col("r") < 1, "0.8").otherwise("1.0")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT source, min(s) AS least, max(s) AS most, quantile_disc(s, 0.5) AS median FROM (SELECT source, length(coalesce(body, '')) AS s FROM releases) GROUP BY source")
def body_sizes(spark, d):
    return releases(spark, d).select("source", flags.size().alias("s")).groupBy("source").agg(F.min("s").alias("least"), F.max("s").alias("most"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY s)").cast("int").alias("median"))


@query("SELECT source, shape, n FROM (SELECT source, shape, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, shape) AS k FROM (SELECT source, regexp_extract(body_html, '^<(\\w+)', 1) AS shape, count(*) AS n FROM releases WHERE body_html <> '' GROUP BY 1, 2)) WHERE k <= 4")
def top_shapes_per_source(spark, d):
    shapes = releases(spark, d).filter("body_html <> ''").groupBy("source", F.regexp_extract("body_html", r"^<(\w+)", 1).alias("shape")).agg(F.count("*").alias("n"))
    k = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "shape"))
    return shapes.withColumn("k", k).filter("k <= 4").select("source", "shape", "n")


@query("SELECT md5(body) AS body_md5, min(id) AS first_id, count(*) - 1 AS surplus FROM releases WHERE length(body) > 0 GROUP BY body HAVING count(*) > 1")
def surplus_copies(spark, d):
    """Repeated bodies by their digest; bodies themselves don't travel."""
    rows = releases(spark, d).filter(F.length("body") > 0).select("id", F.md5("body").alias("body_md5"), F.sha1("body").alias("sha"), F.length("body").alias("n"))
    return rows.groupBy("body_md5", "sha", "n").agg(F.min("id").alias("first_id"), (F.count("*") - 1).alias("surplus")).filter("surplus > 0").select("body_md5", "first_id", "surplus")


# -- windows, one of several --------------------------------------------------------------


@query("SELECT id, lag(id) OVER w AS prev_id, lead(id) OVER w AS next_id FROM releases WINDOW w AS (PARTITION BY source ORDER BY coalesce(date, ''), id)")
def neighbours(spark, d):
    return corpus.neighbours(releases(spark, d))


def _arrivals(spark, d) -> DataFrame:
    """Arrivals with the length of their texts; bodies don't travel through the aggregate."""
    return releases(spark, d).filter("title <> ''").select("title", "date", flags.size().alias("size"), F.col("id").alias("ord"))


_KEPT = "SELECT title, date, ord FROM (SELECT title, date, id AS ord, row_number() OVER (PARTITION BY title, date ORDER BY {}) AS k FROM releases WHERE title <> '') WHERE k = 1"


@query(_KEPT.format("length(coalesce(body, '')) DESC, id"))
def dedupe_longest(spark, d):
    return dedupe.keep(_arrivals(spark, d), ["title", "date"], [F.col("size")]).select("title", "date", "ord")


@query(_KEPT.format("id"))
def dedupe_first(spark, d):
    return dedupe.first(_arrivals(spark, d), ["title", "date"]).select("title", "date", "ord")


@query(_KEPT.format("id DESC"))
def dedupe_last(spark, d):
    return dedupe.last(_arrivals(spark, d), ["title", "date"]).select("title", "date", "ord")


@query(_KEPT.format("CASE WHEN lower(url) LIKE '%.php' THEN 0 ELSE 1 END DESC, length(coalesce(body, '')) DESC, id"))
def dedupe_rank(spark, d):
    rows = releases(spark, d).filter("title <> ''").select("title", "date", F.when(F.lower("url").endswith(".php"), 0).otherwise(1).alias("kind"), flags.size().alias("size"), F.col("id").alias("ord"))
    return dedupe.keep(rows, ["title", "date"], [F.col("kind"), F.col("size")]).select("title", "date", "ord")


@query(r"""WITH k AS (SELECT id, source, date, lower(trim(regexp_replace(title, '\s+', ' ', 'g'))) AS t, length(coalesce(body, '')) AS s FROM releases WHERE coalesce(date, '') <> ''),
 g AS (SELECT *, first_value(id) OVER w AS twin_id, first_value(s) OVER w AS best FROM k WHERE t <> '' WINDOW w AS (PARTITION BY source, t, length(date) ORDER BY s DESC, id))
 SELECT id, twin_id, best >= 300 AND best >= 3 * s AS accepted FROM g WHERE s < 300 AND id <> twin_id""")
def twin_pairs(spark, d):
    """Twins by source, title and the form of the date, as the copies' dates are spelled apart."""
    rows = releases(spark, d).withColumn("date", F.when(F.col("date") != "", F.length("date").cast("string")))
    return dedupe.twins(rows, text.title_key("title"))


_CAPTURES = "SELECT regexp_extract(url, '/web/(\\d{14})id_/', 1) AS ts, substr(url, strpos(url, 'id_/') + 4) AS page, CASE WHEN hex(content) LIKE '25504446%' THEN 0 ELSE octet_length(content) END AS score FROM page_cache WHERE strpos(url, 'id_/') > 0"


@query(f"""WITH c AS ({_CAPTURES}), b AS (SELECT page, min(ts) AS earliest, min(CASE WHEN score > 0 THEN ts END) AS t1 FROM c GROUP BY page),
 s AS (SELECT c.page, min(c.ts) AS t2 FROM c JOIN b ON c.page = b.page WHERE CAST(substr(c.ts, 1, 4) AS INT) >= CAST(substr(t1, 1, 4) AS INT) + 1 GROUP BY c.page),
 n AS (SELECT c.page, max(c.ts) AS t3 FROM c JOIN b ON c.page = b.page LEFT JOIN s ON s.page = c.page WHERE score > 0 AND c.ts > t1 AND c.ts IS DISTINCT FROM t2 GROUP BY c.page),
 x AS (SELECT c.*, row_number() OVER (PARTITION BY c.page ORDER BY score DESC, c.ts) AS k FROM c JOIN b ON c.page = b.page LEFT JOIN s ON s.page = c.page LEFT JOIN n ON n.page = c.page WHERE score > 0 AND (c.ts = t1 OR c.ts = t2 OR c.ts = t3))
 SELECT b.page, x.ts, x.score, b.earliest FROM b LEFT JOIN x ON b.page = x.page AND x.k = 1""")
def best_matching_snapshot(spark, d):
    cache = table(spark, d, "page_cache").filter(F.instr("url", address.MARK) > 0)
    captures = cache.select(address.page_of("url").alias("page"), address.timestamp_of("url").alias("ts"), F.when(pages.kind_of() == "pdf", F.lit(0)).otherwise(F.octet_length("content")).cast("long").alias("score"))
    return dedupe.best_capture(captures).select("page", "ts", "score", "earliest")


# -- sorting and paging -------------------------------------------------------------------


@query("SELECT id, coalesce(date, '') AS date, substr(coalesce(body, ''), 1, 240) AS excerpt FROM releases ORDER BY coalesce(date, '') DESC, id DESC LIMIT 51")
def browse(spark, d):
    rows = releases(spark, d).select("id", F.coalesce("date", F.lit("")).alias("date"), F.substring(F.coalesce("body", F.lit("")), 1, corpus.EXCERPT).alias("excerpt"))
    return corpus.browse(rows)


@query("SELECT id, date FROM releases WHERE date < '2010-06-01' OR (date = '2010-06-01' AND id < 500) ORDER BY date DESC, id DESC LIMIT 21")
def browse_keyset(spark, d):
    return corpus.browse(releases(spark, d).select("id", "date"), 20, ("2010-06-01", 500))


@query("SELECT source, CASE WHEN substr(min(d), 1, 4) = substr(max(d), 1, 4) THEN substr(min(d), 1, 4) ELSE substr(min(d), 1, 4) || '–' || substr(max(d), 1, 4) END AS years FROM (SELECT source, date AS d FROM releases WHERE date <> '') GROUP BY source")
def year_span(spark, d):
    return releases(spark, d).filter("date <> ''").groupBy("source").agg(text.year_span(F.min("date"), F.max("date")).alias("years"))


# -- scalar functions ---------------------------------------------------------------------


@query(r"SELECT id, regexp_replace(coalesce(body, ''), '[\s\x{0B}\x{85}\p{Z}•]+', '', 'g') AS squashed FROM releases")
def squash(spark, d):
    return releases(spark, d).select("id", text.squash(F.coalesce("body", F.lit(""))).alias("squashed"))


@query("SELECT id, CASE WHEN trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') = '' THEN 'release' ELSE trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') END AS slug FROM releases WHERE title IS NOT NULL")
def slugify(spark, d):
    return releases(spark, d).filter("title IS NOT NULL").select("id", text.slug("title").alias("slug"))


@query("SELECT id, CASE WHEN length(title) > 20 AND strpos(substr(title, 21), substr(title, 1, 20)) > 0 THEN rtrim(substr(title, 1, 20 + strpos(substr(title, 21), substr(title, 1, 20)) - 1)) ELSE title END AS title FROM releases")
def dedupe_repeated_title(spark, d):
    return releases(spark, d).select("id", text.without_repeat(F.col("title")).alias("title"))


@query(f"SELECT id, {_FOLD.format('title')} AS folded FROM releases WHERE title IS NOT NULL")
def fold_accents(spark, d):
    return releases(spark, d).filter("title IS NOT NULL").select("id", text.fold("title").alias("folded"))


@query(f"SELECT id, list_filter([CASE WHEN {_TEASER} THEN 'teaser' END, CASE WHEN {_SHORT} THEN 'short' END, CASE WHEN {_NODATE} THEN 'undated' END, CASE WHEN {_MOJIBAKE} THEN 'damaged' END], lambda x: x IS NOT NULL)::VARCHAR AS badges FROM releases")
def badges(spark, d):
    marks = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in (("teaser", flags.teaser()), ("short", flags.short()), ("undated", flags.nodate()), ("damaged", flags.mojibake()))]))
    return releases(spark, d).select("id", F.concat(F.lit("["), F.array_join(marks, ", "), F.lit("]")).alias("badges"))


@query(r"SELECT id, regexp_extract(body, '(?i)(januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember) (\d{4})', 2) AS year FROM releases WHERE body IS NOT NULL")
def german_month_year(spark, d):
    return releases(spark, d).filter("body IS NOT NULL").select("id", F.regexp_extract("body", r"(?iu)(januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember) (\d{4})", 2).alias("year"))


# -- writes as plans ----------------------------------------------------------------------


@query("SELECT url, coalesce(CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN 'x' || title END, title) AS title FROM (SELECT url, max(id) AS id, arg_max_null(title, id) AS title FROM releases WHERE url IS NOT NULL GROUP BY url)")
def coalesce_upgrade(spark, d):
    rows = releases(spark, d).filter("url IS NOT NULL").groupBy("url").agg(F.max("id").alias("id"), F.max_by(F.coalesce("title", F.lit("\0")), "id").alias("t")).select("url", "id", F.when(F.col("t") != "\0", F.col("t")).alias("title"))
    updates = rows.select("url", F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, F.concat(F.lit("x"), "title")).alias("title"))
    return merge.coalesce_upgrade(rows, updates, ["title"]).select("url", "title")


@query("""WITH stored AS (SELECT * FROM releases WHERE id % 2 = 0), incoming AS (SELECT url, min(id) AS ord FROM releases WHERE id % 2 = 1 AND url IS NOT NULL GROUP BY url)
 SELECT i.url, (SELECT coalesce(max(id), 0) FROM stored) + row_number() OVER (ORDER BY ord) AS id FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.url = i.url)""")
def insert_or_ignore(spark, d):
    rows = releases(spark, d)
    stored, incoming = rows.filter("id % 2 = 0").select("id", "url"), rows.filter("id % 2 = 1 AND url IS NOT NULL").select("url", F.col("id").alias("ord"))
    return merge.insert_or_ignore(stored, incoming).select("url", "id")


@query("SELECT url, origin_url FROM body_origin WHERE url NOT IN (SELECT url FROM releases WHERE grade = 'stub' AND url IS NOT NULL)")
def origin_clear(spark, d):
    return merge.clear_origins(origins(spark, d), releases(spark, d).filter("grade = 'stub'").select("url"))


@query("SELECT url, origin_url FROM body_origin")
def origin_record(spark, d):
    rows = origins(spark, d).filter(address.is_capture("origin_url"))
    return merge.record_origins(origins(spark, d), rows.withColumn("ord", F.lit(1)))


# -- full text ----------------------------------------------------------------------------

_FOLDED = _FOLD.format("concat(coalesce(title, ''), ' ', coalesce(body, ''))")
_TOKENS = f"SELECT id, unnest(regexp_extract_all({_FOLDED}, '[\\p{{L}}\\p{{N}}\\p{{Co}}][\\p{{L}}\\p{{N}}\\p{{M}}\\p{{Co}}]*')) AS tok FROM releases"
_HAS = "SELECT DISTINCT id FROM t WHERE tok = '{}'"


_OPEN: dict[tuple[str, str], str] = {}


def _index(spark, d) -> fts.Index:
    """The written index of a folder's releases, made at the first query of a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _OPEN:
        path = f"{shared_dir(spark).rstrip('/')}/fts-{uuid.uuid4().hex}"
        fts.write_index(releases(spark, d), path)
        _OPEN[key] = path
    return fts.open_index(spark, _OPEN[key])


def _search(spark, d, expression):
    return fts.matches(_index(spark, d).postings, fts.read(expression)[0])


@query(f"SELECT tok AS term, count(*) AS n, count(DISTINCT id) AS docs FROM ({_TOKENS}) GROUP BY tok")
def fts_vocabulary(spark, d):
    return _index(spark, d).postings.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct("id").alias("docs"))


@query(f"WITH t AS ({_TOKENS}) SELECT id FROM ({_HAS.format('tampere')} INTERSECT {_HAS.format('warranty')})")
def fts_and(spark, d):
    return _search(spark, d, "Tampere AND warranty")


@query(f"WITH t AS ({_TOKENS}) SELECT id FROM ({_HAS.format('garantie')} UNION {_HAS.format('garantia')})")
def fts_or(spark, d):
    return _search(spark, d, "Garantie OR garantía")


@query(f"WITH t AS ({_TOKENS}) SELECT id FROM ({_HAS.format('kassel')} EXCEPT {_HAS.format('lyon')})")
def fts_not(spark, d):
    return _search(spark, d, "Kassel NOT Lyon")


@query(f"WITH t AS ({_TOKENS}) SELECT DISTINCT id FROM t WHERE starts_with(tok, 'nym')")
def fts_prefix(spark, d):
    return _search(spark, d, "nym*")


@query("SELECT id FROM releases WHERE regexp_matches(' ' || array_to_string(regexp_extract_all(strip_accents(lower(coalesce(body, ''))), '[\\p{L}\\p{N}\\p{Co}][\\p{L}\\p{N}\\p{M}\\p{Co}]*'), ' ') || ' ', ' free of charge ')")
def fts_phrase(spark, d):
    return _search(spark, d, 'body:"free of charge"')


@query(f"""WITH t AS ({_TOKENS}), h AS (SELECT id, count(CASE WHEN tok = 'prototype' THEN 1 END) AS f, count(*)::DOUBLE AS len FROM t GROUP BY id),
 s AS (SELECT count(*)::DOUBLE AS n FROM releases), a AS (SELECT (SELECT sum(len) FROM h) / s.n AS av, s.n FROM s), d AS (SELECT count(*)::DOUBLE AS df FROM h WHERE f > 0)
 SELECT id, round(-(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) > 0 THEN ln((n - df + 0.5) / (df + 0.5)) ELSE 0.000001 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / av)), 6) AS score FROM h, a, d WHERE f > 0""")
def fts_bm25(spark, d):
    return fts.bm25(_index(spark, d), fts.read("prototype")[0]).select("id", F.round("score", 6).alias("score"))


@query()
def fts_top_matches(spark, d):
    rows = releases(spark, d)
    page = fts.top(_index(spark, d), '"noise gate" OR Rauschfilter', 8).join(rows.select("id", "body"), "id")
    return fts.with_snippet(page, '"noise gate" OR Rauschfilter').select("id", F.round("score", 6).alias("score"), "snippet").orderBy("score", "id")


@query(f"""WITH t AS ({_TOKENS}) SELECT (SELECT count(DISTINCT id) FROM t WHERE id % 3 = 0 AND id % 2 = 1) AS missing, (SELECT count(DISTINCT id) FROM t WHERE id % 3 <> 0 AND id % 5 = 0 AND id % 2 = 0) AS orphans""")
def fts_agreement(spark, d):
    """An index of part of the rows against another part: what lacks, and what is stale."""
    rows = releases(spark, d)
    kept, index = rows.filter("NOT (id % 5 = 0 AND id % 2 = 0)"), fts.postings(rows.filter("id % 3 <> 0 OR id % 2 = 0"))
    missing = fts.missing(index, kept).agg(F.count("*").alias("missing"))
    return missing.withColumn("orphans", fts.orphans(index.filter("id % 3 <> 0"), kept).agg(F.count("*")).scalar())


@query(f"""WITH t AS ({_TOKENS}) SELECT id FROM t WHERE tok = 'warranty' AND id % 4 <> 0 GROUP BY id UNION SELECT id FROM releases WHERE id % 4 = 0 AND id % 8 = 0 AND body <> ''""")
def fts_maintained(spark, d):
    """An index with a segment of changes upon it: every fourth row went, every eighth came back
    with another text."""
    rows = releases(spark, d)
    path = f"{shared_dir(spark).rstrip('/')}/fts-{uuid.uuid4().hex}"
    fts.write_index(rows, path)
    back = rows.filter("id % 8 = 0 AND body <> ''").select("id", F.lit("").alias("title"), F.lit("the warranty").alias("body"))
    fts.update_index(spark, path, back, rows.filter("id % 4 = 0").select("id"))
    return fts.matches(fts.open_index(spark, path).postings, fts.read("warranty")[0])


@query(f"""WITH t AS ({_TOKENS}), i AS (SELECT DISTINCT id FROM t WHERE tok = 'warranty'), s AS (SELECT id FROM releases WHERE contains({_FOLDED}, 'warranty'))
 SELECT (SELECT count(*) FROM i) AS indexed, (SELECT count(*) FROM s) AS scanned, (SELECT count(*) FROM i WHERE id NOT IN (SELECT id FROM s)) AS outside""")
def token_probe(spark, d):
    """Rows that the index has for a word against a scan of the texts."""
    found = _search(spark, d, "warranty")
    both = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit("")))
    scanned = releases(spark, d).filter(text.fold(both).contains("warranty")).select("id")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(found, "indexed").withColumn("scanned", count(scanned, "s").scalar()).withColumn("outside", count(found.join(scanned, "id", "left_anti"), "o").scalar())


def _companies(spark, d) -> dict[str, list[str]]:
    """Those of the table, and the ones asked for here without sources if it lacks them."""
    return {"brixtone": [], "kelvaro": [], "pazur": []} | corpus.companies(table(spark, d, "source_tags"))


_LISTED = "coalesce(r.source, '') AS source, coalesce(title, '') AS title, coalesce(date, '') AS date"


@query(f"""WITH t AS ({_TOKENS}), h AS (SELECT DISTINCT id FROM t WHERE tok IN ('garantie', 'garantia'))
 SELECT r.id, {_LISTED} FROM releases r JOIN h ON r.id = h.id JOIN source_tags s ON r.source = s.source WHERE s.slug = 'brixtone' AND r.date >= '2000' AND {_PLAIN} ORDER BY r.date DESC, r.id DESC LIMIT 21""")
def search_by_date(spark, d):
    """A query within a company, a span and a flag, newest first."""
    request = search.checked({"q": "Garantie OR garantía", "company": "brixtone", "from": "2000", "flags": ["plain"], "order": "date", "limit": "20"}, _companies(spark, d))
    return search.rows_of(releases(spark, d), origins(spark, d), _index(spark, d), request)[0].select("id", "source", "title", "date")


@query(f"""WITH t AS ({_TOKENS}), h AS (SELECT id, count(CASE WHEN tok = 'prototype' THEN 1 END) AS f, count(*)::DOUBLE AS len FROM t GROUP BY id),
 s AS (SELECT count(*)::DOUBLE AS n FROM releases), a AS (SELECT (SELECT sum(len) FROM h) / s.n AS av, s.n FROM s), d AS (SELECT count(*)::DOUBLE AS df FROM h WHERE f > 0),
 x AS (SELECT id, round(-(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) > 0 THEN ln((n - df + 0.5) / (df + 0.5)) ELSE 0.000001 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / av)), 6) AS score FROM h, a, d WHERE f > 0)
 SELECT x.id, x.score, {_LISTED} FROM x JOIN releases r ON x.id = r.id WHERE {_TEASER} ORDER BY x.score, x.id LIMIT 11""")
def search_by_rank(spark, d):
    """A query among teasers and stubs, best first."""
    rows, _ = search.rows_of(releases(spark, d), origins(spark, d), _index(spark, d), search.Request(q="prototype", flags=["teaser"], limit=10))
    return rows.select("id", F.round("score", 6).alias("score"), "source", "title", "date")


@query(f"""SELECT r.id, {_LISTED}, substr(coalesce(body, ''), 1, 240) AS excerpt FROM releases r WHERE source IN (SELECT source FROM source_tags WHERE slug IN ('kelvaro', 'pazur')) AND source IN ('kelvaro_news', 'pazur_pl', 'brixton_de') ORDER BY coalesce(date, '') DESC, id DESC LIMIT 31""")
def search_browse(spark, d):
    """No query: the newest rows of what sources and companies have in common."""
    request = search.checked({"source": ["kelvaro_news,pazur_pl", "brixton_de"], "company": "kelvaro,pazur", "limit": "30"}, _companies(spark, d))
    return search.rows_of(releases(spark, d), origins(spark, d), None, request)[0].select("id", "source", "title", "date", "excerpt")


@query(f"""WITH w AS (SELECT id, lag(id) OVER w AS prev_id, lead(id) OVER w AS next_id FROM releases WINDOW w AS (PARTITION BY source ORDER BY coalesce(date, ''), id))
 SELECT r.id, r.title, {_MOJIBAKE} AS is_damaged, CASE WHEN {_PAGE} <> r.url THEN o.origin_url END AS origin_url, w.prev_id, w.next_id FROM releases r JOIN w ON r.id = w.id LEFT JOIN body_origin o ON r.url = o.url WHERE r.id = 321""")
def release_detail(spark, d):
    return search.detail(releases(spark, d), origins(spark, d), 321).select("id", "title", "is_damaged", "origin_url", "prev_id", "next_id")


# -- extraction, repair, gates, flows -----------------------------------------------------


@query()
def decode_pages(spark, d):
    from corpusloom.functions.decode import decode_html

    cache = table(spark, d, "page_cache").filter(pages.kind_of() == "html")
    return cache.select("url", F.md5(decode_html()).alias("md5"))


@query()
def repair_counts(spark, d):
    from corpusloom.functions.decode import repair

    rows = releases(spark, d).filter(flags.damaged()).select(repair().alias("r"))
    return rows.groupBy(F.col("r.method").alias("method")).agg(F.count("*").alias("n"))


@query()
def encoding_report(spark, d):
    from corpusloom.plans.pipeline import encoding_report as run

    return run(releases(spark, d))


@query()
def verify_encoding(spark, d):
    from corpusloom.plans.pipeline import verify_encoding as run

    return run(releases(spark, d), origins(spark, d), table(spark, d, "page_cache")).groupBy("verdict").agg(F.count("*").alias("n"))


@query()
def parse_listing(spark, d):
    """The cached pages as their sources' parsers read them: entries, dated and titled ones."""
    from corpusloom.functions import parsers
    from corpusloom.functions.decode import decode_html

    cache = spread(table(spark, d, "page_cache").filter(pages.kind_of() == "html").select(F.col("url").alias("key"), F.lit(None).cast("string").alias("source"), decode_html().alias("page"), address.page_of("url").alias("url")))
    return parsers.parsed(cache).agg(F.count("*").alias("entries"), F.count_if(F.col("date") != "").alias("dated"), F.count_if(F.col("title") != "").alias("titled"))


@query()
def extract_pages(spark, d):
    from corpusloom.plans.pipeline import extracted_pages

    return extracted_pages(table(spark, d, "page_cache")).select("url", F.length("body").alias("body_len"), F.length("body_html").alias("html_len"))


@query()
def verify_body_origin(spark, d):
    from corpusloom.plans.pipeline import verify_origins

    rows = verify_origins(releases(spark, d), origins(spark, d), table(spark, d, "page_cache"))
    return rows.groupBy("origin_class", "verdict").agg(F.count("*").alias("n"))


@query()
def retext(spark, d):
    from corpusloom.plans.pipeline import retext as run

    return run(releases(spark, d)).select("id", F.length("body").alias("body_len"))


@query()
def gates_between_arrivals(spark, d):
    """Why the shortest text of a title may be replaced by the longest."""
    from corpusloom.operators.gates import safe_to_write

    texts = releases(spark, d).filter("title <> '' AND body <> ''")
    size = F.struct(F.length("body").alias("n"), "id")
    ends = texts.groupBy("title").agg(F.min(size)["id"].alias("old_id"), F.max(size)["id"].alias("new_id")).filter("old_id <> new_id")
    body = lambda c: texts.select(F.col("id").alias(f"{c}_id"), F.col("body").alias(c))
    pairs = spread(ends.join(body("old"), "old_id").join(body("new"), "new_id").filter("old <> new"))
    return pairs.select(safe_to_write("old", "new").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL '15 minutes', to_timestamp(ts)::TIMESTAMP) AS start, kind, count(*) AS n, count(CASE WHEN outcome <> 'ok' THEN 1 END) AS failed, round(avg(duration), 6) AS mean FROM (SELECT DISTINCT * FROM wayback_calls) WHERE ts IS NOT NULL GROUP BY 1, 2")
def calls_by_window(spark, d):
    from corpusloom.streaming.calls import by_window, timed

    return by_window(timed(calls(spark, d)).filter("at IS NOT NULL"))


@query("""WITH c AS (SELECT kind, ts, lag(ts) OVER (PARTITION BY kind ORDER BY ts) AS p FROM (SELECT DISTINCT * FROM wayback_calls) WHERE ts IS NOT NULL),
 g AS (SELECT kind, ts, sum(CASE WHEN p IS NULL OR ts - p > 600 THEN 1 ELSE 0 END) OVER (PARTITION BY kind ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM c)
 SELECT kind, count(*) AS n FROM g GROUP BY kind, s""")
def call_sessions(spark, d):
    from corpusloom.streaming.calls import sessions, timed

    return sessions(timed(calls(spark, d)).filter("at IS NOT NULL")).select("kind", "n")


# -- further joins, cursors and stores ----------------------------------------------------


@query("SELECT source, count(*) AS total FROM releases GROUP BY source")
def source_total(spark, d):
    return releases(spark, d).groupBy("source").agg(F.count("*").alias("total"))


@query("SELECT DISTINCT c.url FROM page_cache c WHERE EXISTS (SELECT 1 FROM releases r WHERE r.url = CASE WHEN strpos(c.url, 'id_/') > 0 THEN substr(c.url, strpos(c.url, 'id_/') + 4) ELSE c.url END)")
def already_stored(spark, d):
    page = F.coalesce(address.page_of("url"), F.col("url")).alias("page")
    return table(spark, d, "page_cache").select("url", page).join(releases(spark, d).select(F.col("url").alias("page")), "page", "left_semi").select("url").distinct()


@query("SELECT l.url, r.grade, length(coalesce(r.body, '')) AS body_len FROM (SELECT DISTINCT url FROM terratec_early__listing_1 WHERE url IS NOT NULL) l LEFT JOIN (SELECT url, arg_max(grade, id) AS grade, arg_max(coalesce(body, ''), id) AS body FROM releases WHERE url IS NOT NULL GROUP BY url) r ON l.url = r.url")
def stored_state(spark, d):
    stored = releases(spark, d).filter("url IS NOT NULL").groupBy("url").agg(F.max_by("grade", "id").alias("grade"), F.max_by(flags.size(), "id").alias("size"))
    listed = table(spark, d, "terratec_early__listing_1").filter("url IS NOT NULL").select("url").distinct()
    return listed.join(stored, "url", "left").select("url", "grade", F.coalesce("size", F.lit(0)).alias("body_len"))


@query("SELECT id, source FROM releases WHERE body_html IS NULL ORDER BY id LIMIT 100")
def pending(spark, d):
    return releases(spark, d).filter("body_html IS NULL").select("id", "source").orderBy("id").limit(100)


@query("SELECT coalesce(a.name, b.name) AS name, coalesce(a.url, b.url) AS url, coalesce(b.title, a.title) AS title FROM (SELECT lower(regexp_extract(url, '[^/]*$')) AS name, max(url) AS url, max(title) AS title FROM releases WHERE url IS NOT NULL GROUP BY 1) a FULL JOIN (SELECT lower(regexp_extract(url, '[^/]*$')) AS name, max(url) AS url, max(title) AS title FROM terratec_early__listing_1 WHERE url IS NOT NULL GROUP BY 1) b ON a.name = b.name")
def join_merge_channels(spark, d):
    side = lambda df, p: df.filter("url IS NOT NULL").groupBy(address.base_name("url").alias("name")).agg(F.max("url").alias(f"{p}url"), F.max("title").alias(f"{p}title"))
    both = side(releases(spark, d), "a_").join(side(table(spark, d, "terratec_early__listing_1"), "b_"), "name", "full")
    return both.select("name", F.coalesce("a_url", "b_url").alias("url"), F.coalesce("b_title", "a_title").alias("title"))


@query("SELECT lower(regexp_extract(url, '[^/]*$')) AS name, arg_max(url, (CASE WHEN hex(content) LIKE '25504446%' THEN '1' ELSE '0' END) || url) AS page, count(*) AS copies FROM page_cache WHERE url IS NOT NULL GROUP BY 1")
def group_attachments(spark, d):
    cache = table(spark, d, "page_cache").filter("url IS NOT NULL")
    best = F.struct((pages.kind_of() == "pdf").alias("real"), F.col("url").alias("u"))
    return cache.groupBy(address.base_name("url").alias("name")).agg(F.max(best).alias("b"), F.count("*").alias("copies")).select("name", F.col("b.u").alias("page"), "copies")


@query("SELECT url, citation AS origin_url, body_len FROM (SELECT url, citation, length(coalesce(body, '')) AS body_len, row_number() OVER (PARTITION BY url ORDER BY length(coalesce(body, '')) DESC, coalesce(citation, '')) AS k FROM terratec_early__listing_1 WHERE url IS NOT NULL) WHERE k = 1")
def collector_longest(spark, d):
    """The longest entry of each address across the captures of a listing, and which one it came from."""
    rows = table(spark, d, "terratec_early__listing_1").filter("url IS NOT NULL").select("url", "citation", flags.size().alias("body_len"), F.coalesce("citation", F.lit("")).alias("c"))
    first = rows.groupBy("url", "body_len").agg(F.min(F.struct("c", "citation")).alias("f"))
    return first.groupBy("url").agg(F.max_by("f.citation", "body_len").alias("origin_url"), F.max("body_len").alias("body_len"))


@query("SELECT CASE WHEN length(coalesce(body, '')) >= 900 THEN 'long' ELSE 'short' END AS part, count(*) AS n FROM releases GROUP BY 1")
def only_short(spark, d):
    return releases(spark, d).groupBy(F.when(flags.size() >= 900, "long").otherwise("short").alias("part")).agg(F.count("*").alias("n"))


@query("SELECT source, min(date) AS first, max(date) AS last FROM releases WHERE date <> '' GROUP BY source ORDER BY first, last, source")
def sort_sources_chrono(spark, d):
    return releases(spark, d).filter("date <> ''").groupBy("source").agg(F.min("date").alias("first"), F.max("date").alias("last")).orderBy("first", "last", "source")


@query("SELECT id, regexp_matches(coalesce(detail_id, ''), '^[0-9]{14}$') AS is_stamp, coalesce(regexp_matches(lower(regexp_extract(url, '^[^?]*')), '\\.(pdf|doc)$'), false) AS is_attachment FROM releases")
def url_predicates(spark, d):
    attachment = F.coalesce(F.lower(F.regexp_extract("url", "^[^?]*", 0)).rlike(r"\.(pdf|doc)$"), F.lit(False))
    return releases(spark, d).select("id", address.is_timestamp(F.coalesce("detail_id", F.lit(""))).alias("is_stamp"), attachment.alias("is_attachment"))


@query("SELECT count(*) AS wrong FROM body_origin WHERE NOT regexp_matches(origin_url, '^https?://[^/]+/web/\\d{14}id_/.')")
def bad_origins(spark, d):
    return origins(spark, d).filter(F.col("origin_url").isNotNull() & ~address.is_capture("origin_url")).agg(F.count("*").alias("wrong"))
