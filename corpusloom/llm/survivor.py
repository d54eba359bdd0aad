"""Best representative of each duplicate group (problem 3), by currency reasoning.

Which grade is newer is learned from the rows that do carry a timestamp (the capture they
came from): if all of a group's ``a`` rows end before its ``b`` rows begin, the group votes
for ``a`` before ``b``. The majority over all groups decides; the contract's order decides
where votes are equal. Each group then has a partial order of its own: rows with timestamps
by those, and a row without one after all of the group's timestamped rows whose grade
comes before its own or is the same. The topologically latest value is taken.

The contract names the survivor's order itself, so ``p3_found``, and the survivor of
``p3_record``, follow that. What it leaves open, the title and date of the built record,
is chosen by currency.

Everything that shuffles is pre-aggregated and free of bodies: only ids, ranks and
lengths travel, so a page that holds a third of all rows costs one partial aggregate a
task. Defined results: null urls name no page; null or unknown grades rank lowest; groups
of one row are no group; equal keys are told apart by the highest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import blank, table

#: The contract's own order of grades, oldest first: a stub grows to a teaser, then to the full text.
GRADES = ("stub", "teaser", "full")
def page_key(url):
    """The page a url names: scheme, host's case, leading ``www.`` and default port don't count."""
    url = F.col(url) if isinstance(url, str) else url
    parts = r"(?s)^(?i:(https?))://([^/?#]*)(.*)$"
    scheme, host = F.lower(F.regexp_extract(url, parts, 1)), F.lower(F.regexp_extract(url, parts, 2))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).otherwise(F.regexp_replace(host, ":443$", ""))
    return F.when(scheme == "", url).otherwise(F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_extract(url, parts, 3)))


def learn_precedence(df: DataFrame, group: str, value: str, moment: str, values: tuple[str, ...] = GRADES) -> list[tuple[str, str, int]]:
    """Votes (older value, newer value, groups) from rows with group, value and moment, over a
    closed set of values.

    Each group is first reduced to a row a value, so what is paired is bounded by the
    number of values, never by the number of rows.
    """
    spans = df.filter(F.col(value).isin(*values)).dropna(subset=[group, moment]).groupBy(F.col(group).alias("g"), F.col(value).alias("v")).agg(F.min(moment).alias("lo"), F.max(moment).alias("hi"))
    votes = spans.groupBy("g").agg(F.collect_list(F.struct("v", "lo", "hi")).alias("s")).filter(F.size("s") > 1)
    older = votes.select("s", F.explode("s").alias("a")).select("a", F.explode("s").alias("b")).filter("a.hi < b.lo")
    rows = older.groupBy(F.col("a.v").alias("older"), F.col("b.v").alias("newer")).agg(F.count("*").alias("n")).collect()  # a row a pair of values at most
    return [(r["older"], r["newer"], r["n"]) for r in rows]


def topological_rank(votes: list[tuple[str, str, int]], trusted: tuple[str, ...] = GRADES) -> dict[str, int]:
    """Value → place from 1, oldest first: how many values come before it. The majority of
    votes decides each pair, the trusted order where votes are equal or there are none; the
    values of a cycle share a place."""
    count = {(a, b): n for a, b, n in votes}
    net = lambda a, b: count.get((a, b), 0) - count.get((b, a), 0)
    return {v: 1 + sum(net(u, v) > 0 or (net(u, v) == 0 and trusted.index(u) < trusted.index(v)) for u in trusted if u != v) for v in trusted}


def timed(releases: DataFrame, origin: DataFrame) -> DataFrame:
    """Releases with ``moment``, the 14 digits of the capture their text came from, if any."""
    stamp = F.regexp_extract("origin_url", r"/web/(\d{14})", 1)
    return releases.join(origin.select("url", F.when(stamp != "", stamp).alias("moment")).groupBy("url").agg(F.max("moment").alias("moment")), "url", "left")


def place_of(rank: dict[str, int]) -> Column:
    place = F.lit(0)
    for value, n in rank.items():
        place = F.when(F.col("grade") == value, n).otherwise(place)
    return place


def ranked(releases: DataFrame) -> DataFrame:
    """Rows with their page and their preference ``pref`` by the contract (greatest wins)."""
    place = place_of({g: i for i, g in enumerate(GRADES, 1)})
    size = F.coalesce(F.length(F.regexp_replace("body", r"(?U)^\s+|\s+$", "")), F.lit(0))
    return releases.withColumn("page", page_key("url")).filter("page IS NOT NULL").withColumn("pref", F.struct((~blank("body")).alias("has"), place.alias("place"), size.alias("size"), "id"))


def placed(rows: DataFrame, rank: dict[str, int]) -> DataFrame:
    """Rows (page, grade, moment, id, ...) with ``current``, their place in their group's
    partial order: the own moment, or else the latest one of the grades that come no later
    than the row's own ('' if there is none), then the grade's learned place, then the id.

    A group is reduced to the latest moment of each grade, as many columns as there are
    grades, so nothing is gathered."""
    known = [(g, F.max(F.when(F.col("grade") == g, F.col("moment"))).alias(f"hi_{g}")) for g in rank]
    spans = rows.filter("moment IS NOT NULL").groupBy("page").agg(*[c for _, c in known])
    place = place_of(rank)
    before = F.greatest(F.lit(""), *[F.when(F.lit(n) <= place, F.coalesce(f"hi_{g}", F.lit(""))).otherwise("") for g, n in rank.items()])
    both = rows.join(spans, "page", "left")
    return both.withColumn("current", F.struct(F.coalesce("moment", before).alias("moment"), place.alias("place"), "id")).drop(*[f"hi_{g}" for g in rank])


def best_of_groups(rows: DataFrame, group: str, fields: dict[str, tuple]) -> DataFrame:
    """One row a group of two or more: survivor's id and, field by field, the value and row
    that come first by the field's order among the rows for which its condition holds;
    ``fields``: name → (order, condition)."""
    chosen = [F.max(F.when(where, F.struct(F.col(order), F.col("id").alias("of"), F.col(name).alias("value")))).alias(f"_{name}") for name, (order, where) in fields.items()]
    best = rows.groupBy(group).agg(F.min("id").alias("group_id"), F.count("*").alias("n"), F.max("pref").alias("_best"), *chosen).filter("n > 1")
    return best.select("group_id", F.col("_best.id").alias("survivor_id"), "n", *[c for name in fields for c in (F.col(f"_{name}.value").alias(name), F.coalesce(F.col(f"_{name}.of"), F.lit(0)).cast("long").alias(f"{name}_from"))])


def learned_rank(rows: DataFrame) -> dict[str, int]:
    return topological_rank(learn_precedence(rows, "page", "grade", "moment"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(group_id, survivor_id, detail_from) of each page with two or more releases."""
    releases = table(spark, sf_dir, "releases")
    rows = ranked(releases.select("id", "url", "detail_id", "grade", "body")).select("id", "page", "pref", "detail_id")
    best = best_of_groups(rows, "page", {"detail_id": ("pref", F.col("detail_id") != "")})
    return best.select("group_id", "survivor_id", F.col("detail_id_from").alias("detail_from"))


def p3_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built record of each page: the survivor's text, detail_id by the contract's order,
    and the most current title and date there are. Only the survivors' bodies are joined
    in, by id."""
    releases, origin = table(spark, sf_dir, "releases"), table(spark, sf_dir, "body_origin")
    rows = ranked(timed(releases, origin)).select("id", "page", "pref", "grade", "moment", "detail_id", "title", "date")
    rows = placed(rows, learned_rank(rows))
    best = best_of_groups(rows, "page", {"detail_id": ("pref", F.col("detail_id") != ""), "title": ("current", ~blank("title")), "date": ("current", ~blank("date"))})
    text = releases.select(F.col("id").alias("survivor_id"), "source", "grade", "body")
    return best.join(text, "survivor_id").select("group_id", "survivor_id", "n", "source", "grade", "title", "title_from", "date", "date_from", "detail_id", F.md5(F.coalesce("body", F.lit(""))).alias("body_md5"))


_ROWS = r"""
WITH keyed AS (
  SELECT id, url, detail_id, title, date, grade, body, source,
    CASE WHEN regexp_matches(url, '^[hH][tT][tT][pP][sS]?://') THEN
      regexp_replace(CASE WHEN lower(url) LIKE 'http://%' THEN regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), ':80$', '')
                          ELSE regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), ':443$', '') END, '^www\.', '')
      || regexp_extract(url, '^[a-zA-Z]+://[^/?#]*(.*)$', 1, 's') ELSE url END AS page,
    length(coalesce(regexp_replace(body, '^\s+|\s+$', '', 'g'), '')) AS size,
    CASE grade WHEN 'full' THEN 3 WHEN 'teaser' THEN 2 WHEN 'stub' THEN 1 ELSE 0 END AS place
  FROM releases WHERE url IS NOT NULL),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY page ORDER BY CASE WHEN size > 0 THEN 1 ELSE 0 END DESC, place DESC, size DESC, id DESC) AS rn,
    count(*) OVER (PARTITION BY page) AS n FROM keyed)
"""
SQL = {
    "p3_found": _ROWS + """
SELECT min(id) AS group_id, max(CASE WHEN rn = 1 THEN id END) AS survivor_id,
  CAST(coalesce(arg_min(id, rn) FILTER (WHERE detail_id <> ''), 0) AS BIGINT) AS detail_from
FROM ordered WHERE n > 1 GROUP BY page""",
    "p3_record": _ROWS + r"""
, moments AS (SELECT url, max(nullif(regexp_extract(origin_url, '/web/([0-9]{14})', 1), '')) AS moment FROM body_origin GROUP BY url),
timed AS (SELECT o.*, m.moment FROM ordered o LEFT JOIN moments m ON o.url = m.url),
spans AS (SELECT page, grade AS v, min(moment) AS lo, max(moment) AS hi FROM timed WHERE moment IS NOT NULL AND grade IN ('stub', 'teaser', 'full') GROUP BY page, grade),
votes AS (SELECT a.v AS older, b.v AS newer, count(*) AS c FROM spans a JOIN spans b ON a.page = b.page AND a.hi < b.lo GROUP BY 1, 2),
grades AS (SELECT * FROM (VALUES ('stub', 1), ('teaser', 2), ('full', 3)) g(v, k)),
ranks AS (SELECT y.v, 1 + count(*) FILTER (WHERE net > 0 OR (net = 0 AND xk < y.k)) AS place FROM grades y JOIN
  (SELECT x.v AS xv, x.k AS xk, z.v AS zv, coalesce((SELECT c FROM votes WHERE older = x.v AND newer = z.v), 0) - coalesce((SELECT c FROM votes WHERE older = z.v AND newer = x.v), 0) AS net FROM grades x, grades z WHERE x.v <> z.v) p ON p.zv = y.v GROUP BY y.v),
late AS (SELECT s.page, r.place, max(hi) AS hi FROM spans s JOIN ranks r ON s.v = r.v GROUP BY s.page, r.place),
cur AS (SELECT t.*, coalesce(r.place, 0) AS learned, coalesce(moment, (SELECT max(hi) FROM late WHERE late.page = t.page AND late.place <= coalesce(r.place, 0)), '') AS moved FROM timed t LEFT JOIN ranks r ON t.grade = r.v)
SELECT min(id) AS group_id, max(CASE WHEN rn = 1 THEN id END) AS survivor_id, count(*) AS n,
  max(CASE WHEN rn = 1 THEN source END) AS source, max(CASE WHEN rn = 1 THEN grade END) AS grade,
  arg_max(title, (moved, learned, id)) FILTER (WHERE regexp_matches(title, '\S')) AS title, coalesce(arg_max(id, (moved, learned, id)) FILTER (WHERE regexp_matches(title, '\S')), 0) AS title_from,
  arg_max(date, (moved, learned, id)) FILTER (WHERE regexp_matches(date, '\S')) AS date, coalesce(arg_max(id, (moved, learned, id)) FILTER (WHERE regexp_matches(date, '\S')), 0) AS date_from,
  arg_min(detail_id, rn) FILTER (WHERE detail_id <> '') AS detail_id,
  md5(coalesce(max(CASE WHEN rn = 1 THEN body END), '')) AS body_md5
FROM cur WHERE n > 1 GROUP BY page""",
}
