"""Registered queries over the flows of ``ingest``: what each strategy makes of the corpus.

Parsed pages come from outside, so the queries take texts that the tables hold in their
stead: arrivals with odd ids are what was found, those with even ids what is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import address, text
from corpusloom.operators import dedupe
from corpusloom.plans import ingest
from corpusloom.session import table
from corpusloom.sources import pages as cache

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def _stored(spark, d) -> DataFrame:
    """The last arrival with an even id of each address."""
    return dedupe.last(table(spark, d, "releases").filter("id % 2 = 0 AND url IS NOT NULL").withColumn("ord", F.col("id")), ["url"]).drop("ord")


def _found(spark, d) -> DataFrame:
    rows = table(spark, d, "releases").filter("id % 2 = 1 AND url IS NOT NULL").withColumn("ord", F.col("id"))
    return rows.select("url", "id", "title", "date", "detail_id", "body", "body_html", "ord")


def _captures(spark, d) -> DataFrame:
    """Captures of the cache, each with a stand-in text of a hundredth of its bytes; one without
    a time of fetching has failed. Listed addresses were asked for and have none."""
    rows = table(spark, d, "page_cache").filter(F.instr("url", address.MARK) > 0)
    size = F.when(cache.kind_of() == "pdf", 0).otherwise(F.floor(F.octet_length("content") / 100))
    none = F.lit(None).cast("string")
    rows = rows.select(address.page_of("url").alias("url"), address.timestamp_of("url").alias("ts"), F.col("fetched_at").isNull().alias("failed"), none.alias("title"), none.alias("date"), F.repeat(F.lit("x"), size.cast("int")).alias("body"), none.alias("body_html"))
    asked = _found(spark, d).filter("id % 3 = 0").select("url", none.alias("ts"), F.lit(False).alias("failed"), *[none.alias(c) for c in ("title", "date", "body", "body_html")])
    return rows.unionByName(asked.distinct())


_STORED = "stored AS (SELECT url, arg_max(grade, id) AS grade FROM releases WHERE id % 2 = 0 AND url IS NOT NULL GROUP BY url)"
_FOUND = "found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS k FROM releases WHERE id % 2 = 1 AND url IS NOT NULL) WHERE k = 1)"
_BEST = r"""c AS (SELECT regexp_extract(url, '/web/(\d{14})id_/', 1) AS ts, substr(url, strpos(url, 'id_/') + 4) AS page, CASE WHEN fetched_at IS NULL THEN NULL WHEN hex(content) LIKE '25504446%' THEN 0 ELSE octet_length(content) // 100 END AS score FROM page_cache WHERE strpos(url, 'id_/') > 0),
 b AS (SELECT page, min(ts) AS earliest, min(CASE WHEN score > 0 THEN ts END) AS t1, count(*) = count(score) AS complete FROM c GROUP BY page),
 s AS (SELECT c.page, min(c.ts) AS t2 FROM c JOIN b ON c.page = b.page WHERE CAST(substr(c.ts, 1, 4) AS INT) >= CAST(substr(t1, 1, 4) AS INT) + 1 GROUP BY c.page),
 n AS (SELECT c.page, max(c.ts) AS t3 FROM c JOIN b ON c.page = b.page LEFT JOIN s ON s.page = c.page WHERE score > 0 AND c.ts > t1 AND c.ts IS DISTINCT FROM t2 GROUP BY c.page),
 x AS (SELECT c.page, c.ts, c.score, row_number() OVER (PARTITION BY c.page ORDER BY score DESC, c.ts) AS k FROM c JOIN b ON c.page = b.page LEFT JOIN s ON s.page = c.page LEFT JOIN n ON n.page = c.page WHERE score > 0 AND (c.ts = t1 OR c.ts = t2 OR c.ts = t3)),
 asked AS (SELECT page FROM b UNION SELECT url FROM releases WHERE id % 2 = 1 AND id % 3 = 0 AND url IS NOT NULL),
 best AS (SELECT a.page AS url, coalesce(x.ts, b.earliest) AS ts, coalesce(x.ts IS NOT NULL OR b.complete, true) AS confirmed, coalesce(x.score, 0) AS size FROM asked a LEFT JOIN b ON a.page = b.page LEFT JOIN x ON x.page = a.page AND x.k = 1)"""


@query(f"""WITH {_STORED}, {_FOUND}, p AS (SELECT url, arg_max(coalesce(body, ''), id) AS body FROM releases WHERE id % 2 = 1 AND id % 5 > 0 AND url IS NOT NULL GROUP BY url),
 o AS (SELECT f.url, f.title, p.body, CASE WHEN s.url IS NOT NULL THEN 'skipped' WHEN p.url IS NULL THEN 'uncertain' WHEN p.body = '' THEN 'dead' ELSE 'added' END AS outcome FROM found f LEFT JOIN stored s ON f.url = s.url LEFT JOIN p ON f.url = p.url)
 SELECT url, outcome, CASE WHEN outcome = 'added' THEN title END AS title, CASE WHEN outcome = 'added' THEN length(body) ELSE 0 END AS body_len FROM o""")
def discovery_items(spark, d):
    """Live listing items; every fifth page was not fetched."""
    found = _found(spark, d)
    fetched = dedupe.last(found.filter("id % 5 > 0"), ["url"]).select("url", F.coalesce("body", F.lit("")).alias("body"), "body_html")
    rows = ingest.from_items(_stored(spark, d), found.select("url", "title", "date", "detail_id", "ord"), fetched)
    return rows.select("url", "outcome", "title", F.coalesce(F.length("body"), F.lit(0)).cast("long").alias("body_len"))


@query(f"WITH {_BEST} SELECT url, ts, confirmed, size FROM best")
def discovery_captures(spark, d):
    """The capture taken for each address, and whether its absence is confirmed."""
    return ingest.best_captures(_captures(spark, d)).select("url", "ts", "confirmed", F.length(F.coalesce("body", F.lit(""))).alias("size"))


@query(f"""WITH {_STORED}, {_FOUND}, {_BEST},
 o AS (SELECT f.url, coalesce(f.title, '') AS title, b.ts, b.size, CASE WHEN s.url IS NOT NULL THEN 'skipped' WHEN b.confirmed IS NOT TRUE THEN 'uncertain' WHEN b.ts IS NULL THEN CASE WHEN coalesce(f.title, '') <> '' OR coalesce(f.date, '') <> '' THEN 'stub' ELSE 'dead' END
  WHEN b.size > 0 THEN 'added' ELSE 'stub' END AS outcome FROM found f LEFT JOIN stored s ON f.url = s.url LEFT JOIN best b ON f.url = b.url)
 SELECT url, outcome, CASE WHEN outcome IN ('added', 'stub') THEN title END AS title, CASE WHEN outcome IN ('added', 'stub') THEN ts END AS detail_id, CASE WHEN outcome IN ('added', 'stub') THEN CASE WHEN size > 0 THEN 'full' ELSE 'stub' END END AS grade,
  CASE WHEN outcome IN ('added', 'stub') AND size > 0 THEN 'https://web.archive.example/web/' || ts || 'id_/' || url END AS origin_url FROM o""")
def discovery_candidates(spark, d):
    """Addresses that a listing names, with the best capture of each."""
    rows = ingest.from_candidates(_stored(spark, d), _found(spark, d).select("url", "title", "date", "ord"), ingest.best_captures(_captures(spark, d)), stub_if_absent=True)
    return rows.select("url", "outcome", "title", "detail_id", "grade", "origin_url")


@query(f"""WITH {_STORED}, {_FOUND}, {_BEST},
 o AS (SELECT f.url, substr(coalesce(f.body, ''), 1, 80) AS teaser, s.grade AS g, b.ts, coalesce(b.size, 0) AS size, coalesce(b.confirmed, false) AS confirmed, s.url IS NOT NULL AS there FROM found f LEFT JOIN stored s ON f.url = s.url LEFT JOIN best b ON f.url = b.url),
 r AS (SELECT *, CASE WHEN there AND g IS DISTINCT FROM 'teaser' THEN 'skipped' WHEN size > 0 THEN CASE WHEN g = 'teaser' THEN 'upgraded' ELSE 'added' END WHEN NOT confirmed THEN 'uncertain' WHEN g = 'teaser' THEN 'skipped' WHEN teaser = '' THEN 'dead' ELSE 'teaser' END AS outcome FROM o)
 SELECT url, outcome, CASE WHEN outcome IN ('added', 'upgraded') THEN 'full' WHEN outcome = 'teaser' THEN 'teaser' END AS grade, CASE WHEN outcome IN ('added', 'upgraded') THEN size WHEN outcome = 'teaser' THEN length(teaser) ELSE 0 END AS body_len FROM r""")
def discovery_teasers(spark, d):
    """Teasers of a listing: upgraded by their own page, or stored as they are."""
    entries = _found(spark, d).select("url", "title", "date", F.substring(F.coalesce("body", F.lit("")), 1, 80).alias("teaser"), F.lit(None).cast("string").alias("teaser_html"), F.lit(None).cast("string").alias("origin_url"), "ord")
    rows = ingest.from_teasers(_stored(spark, d), entries, ingest.best_captures(_captures(spark, d)))
    return rows.select("url", "outcome", "grade", F.coalesce(F.length("body"), F.lit(0)).cast("long").alias("body_len"))


_ROWS = "(SELECT url, max(id) AS id, arg_max(coalesce(title, ''), id) AS title, arg_max(coalesce(body, ''), id) AS body, arg_max(coalesce(detail_id, ''), id) AS detail_id, arg_max(CASE WHEN body_html IS NULL THEN 1 ELSE 0 END, id) = 1 AS bare FROM releases WHERE id % 2 = 0 AND url IS NOT NULL GROUP BY url)"
_FILE = "regexp_matches(lower(regexp_extract({}url, '^[^?]*')), '\\.(pdf|doc)$')"


@query(f"""SELECT r.url, CASE WHEN r.id % 3 = 2 THEN 'dead' WHEN r.id % 3 = 0 AND length(r.body) > 0 THEN 'skipped' ELSE 'upgraded' END AS outcome,
 CASE WHEN r.id % 3 = 1 OR (r.id % 3 = 0 AND length(r.body) = 0) THEN CASE WHEN trim(r.title) = '' THEN 'listed' END END AS title FROM {_ROWS} r WHERE r.bare""")
def catch_up_listings(spark, d):
    """A listing that holds more than a row, less than it, or nothing, by the row's id."""
    stored = _stored(spark, d)
    third = F.col("id") % 3
    body = F.when(third == 0, F.expr("substr(coalesce(body, ''), 1, CAST(floor((length(coalesce(body, '')) - 1) / 2) AS INT))")).otherwise(F.concat(F.coalesce("body", F.lit("")), F.lit(" and more")))
    entries = stored.select("url", F.lit(" listed ").alias("title"), body.alias("body"), F.when(third == 2, "").otherwise("<p>x</p>").alias("body_html"), F.lit("https://web.archive.example/web/20010101000000id_/http://x.example/").alias("origin_url"))
    return ingest.from_listings(stored, entries).select("url", "outcome", "title")


@query(f"""WITH r AS (SELECT r.*, o.origin_url FROM {_ROWS} r LEFT JOIN body_origin o ON r.url = o.url), k AS (SELECT *, CASE WHEN regexp_matches(detail_id, '^[0-9]{{14}}$') THEN 'https://web.archive.example/web/' || detail_id || 'id_/' || url ELSE '' END AS mine FROM r),
 q AS (SELECT *, coalesce(origin_url, mine) AS key FROM k)
 SELECT q.url, CASE WHEN {_FILE.format('q.')} THEN 'skipped' WHEN q.key <> '' AND NOT (q.mine <> '' AND q.key = q.mine) THEN 'skipped' WHEN c.url IS NULL THEN 'skipped' ELSE 'other' END AS outcome FROM q LEFT JOIN page_cache c ON c.url = q.key WHERE q.bare""")
def catch_up_collected(spark, d):
    """Rows of a source with a listing collector: other pages' captures are left to it."""
    stored = _stored(spark, d)
    pages = table(spark, d, "page_cache").select("url", F.lit("").alias("title"), F.lit("").alias("body"), F.lit("").alias("body_html"), F.lit(True).alias("html"))
    rows = ingest.from_cache(stored, table(spark, d, "body_origin"), pages, has_collector=True)
    return rows.select("url", F.when(F.col("outcome") == "skipped", "skipped").otherwise("other").alias("outcome"))


@query(f"""WITH q AS (SELECT r.*, o.origin_url AS key FROM {_ROWS} r JOIN body_origin o ON r.url = o.url WHERE r.bare AND o.origin_url IS NOT NULL)
 SELECT q.url, CASE WHEN {_FILE.format('q.')} THEN 'skipped' WHEN c.url IS NULL THEN 'skipped' WHEN q.id % 5 = 0 THEN 'dead' WHEN q.id % 3 = 0 THEN 'skipped' ELSE 'upgraded' END AS outcome,
  CASE WHEN {_FILE.format('q.')} THEN NULL WHEN c.url IS NULL THEN NULL WHEN q.id % 5 = 0 THEN NULL WHEN q.id % 3 = 0 THEN 'differs' END AS why FROM q LEFT JOIN page_cache c ON c.url = q.key""")
def catch_up_cache(spark, d):
    """Cached pages of rows whose origin is another page than their reference leads to: only the
    very same text may be written. Every fifth page is no HTML, every third has a word more."""
    stored = _stored(spark, d).drop("detail_id").withColumn("detail_id", F.lit(None).cast("string"))
    origins = table(spark, d, "body_origin").filter("origin_url IS NOT NULL")
    held = origins.join(table(spark, d, "page_cache").select(F.col("url").alias("origin_url")), "origin_url", "left_semi").join(stored.select("url", "id", "body"), "url")
    body = F.concat(F.coalesce("body", F.lit("")), F.when(F.col("id") % 3 == 0, " word").otherwise("  "))
    pages = held.select(F.col("origin_url").alias("url"), F.lit("").alias("title"), body.alias("body"), F.lit("<p>x</p>").alias("body_html"), (F.col("id") % 5 != 0).alias("html"))
    rows = ingest.from_cache(stored.join(origins.select("url"), "url", "left_semi"), origins, pages)
    return rows.select("url", "outcome", "why")


@query(f"""SELECT url, CASE WHEN id % 7 = 0 THEN 'uncertain' WHEN id % 3 = 0 THEN 'skipped' ELSE 'upgraded' END AS outcome FROM {_ROWS}""")
def catch_up_live(spark, d):
    """All rows fetched again: every seventh page didn't come, every third is as it was."""
    stored = _stored(spark, d)
    body = F.concat(F.coalesce("body", F.lit("")), F.when(F.col("id") % 3 == 0, "").otherwise(" word"))
    pages = stored.filter("id % 7 <> 0").select("url", F.lit("").alias("title"), body.alias("body"), F.lit("<p>x</p>").alias("body_html"), F.lit(True).alias("html"))
    return ingest.from_live(stored, pages, refetch=True).select("url", "outcome")


@query(f"""WITH {_BEST}, q AS (SELECT *, CASE WHEN regexp_matches(detail_id, '^[0-9]{{14}}$') THEN 'https://web.archive.example/web/' || detail_id || 'id_/' || url ELSE '' END AS key FROM {_ROWS} WHERE bare)
 SELECT q.url, CASE WHEN {_FILE.format('q.')} OR key = '' THEN 'skipped' WHEN coalesce(b.size, 0) > 0 THEN CASE WHEN b.size < length(q.body) THEN 'skipped' ELSE 'upgraded' END WHEN coalesce(b.confirmed, false) THEN 'dead' ELSE 'uncertain' END AS outcome,
  CASE WHEN NOT {_FILE.format('q.')} AND key <> '' AND b.size > 0 AND b.size >= length(q.body) THEN b.ts END AS detail_id FROM q LEFT JOIN best b ON q.url = b.url""")
def catch_up_missing(spark, d):
    """Rows whose own capture is not to be had, with the best one that the index knows."""
    none = table(spark, d, "page_cache").limit(0).select("url", F.lit("").alias("title"), F.lit("").alias("body"), F.lit("").alias("body_html"), F.lit(True).alias("html"))
    found = ingest.best_captures(_captures(spark, d)).withColumn("body_html", F.when(F.col("body") != "", "<p>x</p>"))
    return ingest.retry_missing(_stored(spark, d), none, found).select("url", "outcome", "detail_id")


@query(f"""WITH q AS (SELECT url, 'https://web.archive.example/web/' || detail_id || 'id_/' || url AS capture FROM {_ROWS} WHERE regexp_matches(detail_id, '^[0-9]{{14}}$') AND NOT {_FILE.format('')})
 SELECT q.url, q.capture, CASE WHEN EXISTS (SELECT 1 FROM page_cache c WHERE c.url = q.capture) THEN 'skipped' ELSE 'wanted' END AS outcome FROM q""")
def seed_cache(spark, d):
    return ingest.seed_cache(_stored(spark, d), table(spark, d, "page_cache"), force=True)


@query(r"""WITH k AS (SELECT id, url, source, detail_id, body, lower(trim(regexp_replace(title, '\s+', ' ', 'g'))) AS t, length(coalesce(body, '')) AS s FROM releases WHERE coalesce(date, '') <> ''),
 g AS (SELECT *, first_value(id) OVER w AS twin, first_value(s) OVER w AS best, first_value(detail_id) OVER w AS twin_detail FROM k WHERE t <> '' WINDOW w AS (PARTITION BY source, t ORDER BY s DESC, id))
 SELECT id, twin AS twin_id, best AS body_len, CASE WHEN regexp_matches(twin_detail, '^[0-9]{14}$') THEN twin_detail END AS detail_id, 'full' AS grade FROM g WHERE s < 300 AND id <> twin AND best >= 300 AND best >= 3 * s""")
def twin_fill(spark, d):
    """Twins by source and title among dated rows: what each short row takes from its twin."""
    rows = table(spark, d, "releases").withColumn("date", F.when(F.col("date") != "", "dated"))
    pairs = dedupe.twins(rows, text.title_key("title")).filter("accepted").select("id", "twin_id")
    filled = ingest.twin_fill(rows.withColumn("url", F.col("id").cast("string")), text.title_key("title"))
    return filled.select(F.col("url").cast("long").alias("id"), F.length("body").alias("body_len"), "detail_id", "grade").join(pairs, "id").select("id", "twin_id", "body_len", "detail_id", "grade")


@query()
def catch_up_chain(spark, d):
    """Outcomes of all strategies, each upon what the one before has written."""
    stored, origins = _stored(spark, d), table(spark, d, "body_origin")
    pages = origins.join(stored.select("url", "body"), "url").select(F.col("origin_url").alias("url"), F.lit("").alias("title"), F.concat(F.coalesce("body", F.lit("")), F.lit(" ")).alias("body"), F.lit("<p>x</p>").alias("body_html"), F.lit(True).alias("html"))
    captures = ingest.best_captures(_captures(spark, d)).withColumn("body_html", F.when(F.col("body") != "", "<p>x</p>"))
    return ingest.catch_up(stored, origins, text.title_key("title"), pages=pages.dropDuplicates(["url"]), twins=True, captures=captures)[2]
