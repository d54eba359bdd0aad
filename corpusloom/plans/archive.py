"""Registered queries over pages, captures, containers and conversions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import address, containers, quality, text
from corpusloom.functions.decode import decode_html
from corpusloom.functions.richtext import text_of
from corpusloom.operators import dedupe
from corpusloom.plans.flows import _BEST
from corpusloom.session import spread, table
from corpusloom.sources import fetch, pages

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


@query(r"""SELECT url, regexp_matches(lower(regexp_extract(url, '^[^?]*')), '\.html?$') AS page, hex(content) LIKE '25504446%' OR hex(content) LIKE 'D0CF11E0%' AS attachment,
 octet_length(content) > 0 AND NOT regexp_matches(hex(content), '^(25504446|D0CF11E0|7B5C727466|504B0304|89504E47|FFD8FF|47494638)') AS html FROM page_cache""")
def page_predicates(spark, d):
    return table(spark, d, "page_cache").select("url", pages.page_url().alias("page"), pages.is_attachment().alias("attachment"), pages.looks_like_html().alias("html"))


_PATH = "regexp_extract(url, '^https?://[^/]*(/[^?#]*)', 1)"


@query(f"SELECT id, CASE WHEN starts_with({_PATH}, '/archiv/') THEN 'archive' WHEN starts_with({_PATH}, '/e/presse/') THEN 'english' WHEN starts_with({_PATH}, '/press/') THEN 'press' END AS site FROM releases")
def site_of(spark, d):
    """The part of a site that each row's address lies in, by the path alone."""
    sites = {"archive": "http://a.example/archiv/", "english": "http://b.example/e/presse/", "press": "http://c.example/press/"}
    return pages.site_of(table(spark, d, "releases").select("id", "url"), sites).select("id", "site")


@query("""WITH m AS (SELECT * FROM (VALUES ('mirror-1.example'), ('mirror-2.example'), ('mirror-3.example')) v(o)), u AS (SELECT DISTINCT url, CASE WHEN contains(url, 'mirror-1.example') THEN 'mirror-1.example' WHEN contains(url, 'mirror-2.example') THEN 'mirror-2.example' WHEN contains(url, 'mirror-3.example') THEN 'mirror-3.example' END AS own FROM page_cache)
 SELECT url, url AS variant FROM u UNION ALL SELECT url, replace(url, own, o) FROM u JOIN m ON o <> own""")
def domain_variants(spark, d):
    rows = table(spark, d, "page_cache").select("url").distinct()
    return pages.domain_variants(rows, ["mirror-1.example", "mirror-2.example", "mirror-3.example"]).select("url", "variant")


@query("SELECT regexp_replace(lower(regexp_extract(url, '^https?://([^/:]*)', 1)), '^www\\.', '') AS site, count(*) AS n FROM releases WHERE url IS NOT NULL GROUP BY 1")
def rows_by_site(spark, d):
    return table(spark, d, "releases").filter("url IS NOT NULL").groupBy(fetch.site(F.col("url")).alias("site")).agg(F.count("*").alias("n"))


@query("SELECT substr(url, strpos(url, 'id_/') + 4) AS page, string_agg(DISTINCT regexp_extract(url, '/web/(\\d{14})id_/', 1), ' ' ORDER BY regexp_extract(url, '/web/(\\d{14})id_/', 1)) AS stamps FROM page_cache WHERE strpos(url, 'id_/') > 0 GROUP BY 1")
def capture_lists(spark, d):
    """The times of all captures of each page, in order."""
    rows = table(spark, d, "page_cache").select(address.page_of("url").alias("page"), address.timestamp_of("url").alias("ts")).filter("page IS NOT NULL")
    return rows.groupBy("page").agg(F.array_join(F.array_sort(F.collect_set("ts")), " ").alias("stamps"))


@query(f"""WITH {_BEST}, f AS (SELECT c.page, c.score AS s0, row_number() OVER (PARTITION BY c.page ORDER BY c.ts, coalesce(c.score, -1) DESC) AS k FROM c)
 SELECT b.page, x.ts AS taken, x.score AS taken_score, b.earliest AS passed, coalesce(f.s0, -1) AS passed_score, CASE WHEN f.s0 IS NULL THEN 'unreachable' WHEN f.s0 <= 0 THEN 'no text' ELSE 'less text' END AS why
 FROM b JOIN x ON b.page = x.page AND x.k = 1 JOIN f ON f.page = b.page AND f.k = 1 WHERE x.ts <> b.earliest""")
def selection_overrides(spark, d):
    """Pages for which another capture than the earliest is taken."""
    rows = table(spark, d, "page_cache").filter(F.instr("url", address.MARK) > 0)
    score = F.when(F.col("fetched_at").isNull(), F.lit(None)).when(pages.kind_of() == "pdf", 0).otherwise(F.floor(F.octet_length("content") / 100))
    rows = rows.select(address.page_of("url").alias("page"), address.timestamp_of("url").alias("ts"), score.cast("long").alias("score"))
    return dedupe.selection_overrides(rows).withColumn("passed_score", F.coalesce("passed_score", F.lit(-1)))


@query("SELECT source, count(*) AS total, count(body_html) AS with_markup FROM releases GROUP BY source")
def confirm_rewrite_counts(spark, d):
    """What a bulk rewrite of each source would touch."""
    return table(spark, d, "releases").groupBy("source").agg(F.count("*").alias("total"), F.count("body_html").alias("with_markup"))


@query(r"""SELECT id, CASE WHEN regexp_matches(title, '(?i)\b(januar|january|februar|february|märz|march|april|mai|may|juni|june|juli|july|august|september|oktober|october|november|dezember|december)\s+\d{4}\)?\s*$') THEN 'dated' ELSE 'plain' END AS kind FROM (SELECT id, title || CASE WHEN id % 3 = 0 THEN ' - März 2003' WHEN id % 3 = 1 THEN ' (May 1999)' ELSE '' END AS title FROM releases WHERE title IS NOT NULL)""")
def month_year_titles(spark, d):
    """Titles that end in a month and a year, which are split off."""
    made = F.concat("title", F.when(F.col("id") % 3 == 0, " - März 2003").when(F.col("id") % 3 == 1, " (May 1999)").otherwise(""))
    rows = table(spark, d, "releases").filter("title IS NOT NULL").select("id", "title", text.month_year(made).alias("m"))
    right = F.when(F.col("id") % 3 == 0, F.col("m.date") == "2003-03").when(F.col("id") % 3 == 1, F.col("m.date") == "1999-05").otherwise(F.lit(True))
    return rows.select("id", F.when(F.col("m.date") != "", F.when(right, "dated").otherwise("wrong")).otherwise("plain").alias("kind"))


@query()
def container_report(spark, d):
    """Where each source's bodies lie in their captures."""
    rows = table(spark, d, "releases").select("url", "source", "body").join(table(spark, d, "body_origin"), "url")
    cache = table(spark, d, "page_cache").filter(pages.kind_of() == "html").select(F.col("url").alias("origin_url"), decode_html().alias("page"))
    found = spread(rows.join(cache, "origin_url")).select("source", containers.locate("page", "body").alias("l")).select("source", "l.shape", "l.path", "l.coverage")
    return containers.report(found)


def _measured(spark, d):
    """The corpus' markup as conversions: the stored body against the text of the markup."""
    rows = spread(table(spark, d, "releases").filter("body_html IS NOT NULL").select("id", F.coalesce("body", F.lit("")).alias("text"), "body_html"))
    return rows.withColumn("body", text_of("body_html")).withColumn("m", quality.measure("text", "body_html", "body"))


@query()
def defect_counts(spark, d):
    return quality.defect_counts(_measured(spark, d))


@query()
def conversion_verdicts(spark, d):
    return _measured(spark, d).groupBy(quality.verdict(F.col("m")).alias("verdict")).agg(F.count("*").alias("n"))


@query()
def conversion_retention(spark, d):
    return quality.retention_histogram(_measured(spark, d))
