"""Reading the corpus: list rows, browsing, detail, neighbours, audit, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import address, flags
from corpusloom.session import written

#: Rows of a page at most and by default; code points of an excerpt without a query.
PAGE_MOST, PAGE, EXCERPT = 200, 50, 240


def list_rows(releases: DataFrame, origin: DataFrame) -> DataFrame:
    """List rows: no body, but its length and whether it is damaged; null texts as ''."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = releases.join(origin.select("url", "origin_url"), "url", "left")
    return rows.select("id", text("source"), text("detail_id"), text("title"), text("date"), text("url"), text("grade"), flags.size().alias("body_len"), flags.mojibake().alias("damaged"), "origin_url", F.col("body_html").isNotNull().alias("has_html"))


def where(rows: DataFrame, sources=(), since: str = "", until: str = "", names=()) -> DataFrame:
    """Filters of the search: sources (none: all), bounds on the date's text, flags."""
    condition: Column = flags.all_of(names)
    if sources:
        condition = condition & F.col("source").isin(*sources)
    if since:
        condition = condition & (F.col("date") >= since)
    if until:
        condition = condition & (F.col("date") <= until)
    return rows.filter(condition)


def clamp(limit: int | None) -> int:
    return max(1, min(PAGE_MOST, PAGE if limit is None else limit))


def browse(rows: DataFrame, limit: int | None = None, after: tuple[str, int] | None = None) -> DataFrame:
    """The newest rows, one more than the page holds; ``after`` is the last (date, id) seen."""
    if after:
        date, last = after
        rows = rows.filter((F.col("date") < date) | ((F.col("date") == date) & (F.col("id") < last)))
    return rows.orderBy(F.desc("date"), F.desc("id")).limit(clamp(limit) + 1)


def next_cursor(page: list, limit: int | None = None) -> tuple[list, str | None]:
    """The page's rows, and the cursor of the next page if there is one."""
    n = clamp(limit)
    return (page[:n], f"d:{page[n - 1]['date']}:{page[n - 1]['id']}") if len(page) > n else (page, None)


def parse_cursor(text: str | None) -> tuple[str, tuple[str, int] | int] | None:
    """('d', (date, id)) or ('o', offset); ValueError for anything else."""
    if not text:
        return None
    kind, _, rest = text.partition(":")
    if kind == "o" and rest.isdigit():
        return "o", int(rest)
    date, _, last = rest.rpartition(":")
    if kind == "d" and last.isdigit():
        return "d", (date, int(last))
    raise ValueError(f"no such cursor: {text}")


def neighbours(releases: DataFrame) -> DataFrame:
    """(id, prev_id, next_id) in the order of date and id within a source.

    A source may hold a third of all rows, so no window spans one: rows are cut into ranges
    of (source, date, id), windowed within each, and the ranges' ends are linked through a
    table that has a row a range.
    """
    rows = releases.select("id", "source", F.coalesce("date", F.lit("")).alias("d"))
    rows = written(rows.repartitionByRange("source", "d", "id").withColumn("part", F.spark_partition_id()), "neighbours-ranges")
    within = Window.partitionBy("part").orderBy("source", "d", "id")
    row = F.struct("source", "id")
    ends = rows.groupBy("part").agg(F.min(F.struct("source", "d", "id")).alias("first"), F.max(F.struct("source", "d", "id")).alias("last"))
    along = Window.orderBy("part")  # a row a range
    ends = ends.select("part", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("behind"))
    linked = rows.withColumn("p", F.lag(row).over(within)).withColumn("n", F.lead(row).over(within)).join(ends, "part")
    same = lambda near, far: F.when(F.col(near).isNotNull(), F.when(F.col(f"{near}.source").eqNullSafe(F.col("source")), F.col(f"{near}.id"))).otherwise(F.when(F.col(f"{far}.source").eqNullSafe(F.col("source")), F.col(f"{far}.id")))
    return linked.select("id", same("p", "before").alias("prev_id"), same("n", "behind").alias("next_id"))


def release(releases: DataFrame, origin: DataFrame, release_id: int) -> DataFrame:
    """One row with its text, damage, capture and viewer's address."""
    row = releases.filter(F.col("id") == release_id).join(origin, "url", "left")
    return row.select("*", flags.mojibake().alias("is_damaged"), address.origin_key().alias("capture"), address.viewer_url("origin_url").alias("viewer"))


def count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def quality_counts(releases: DataFrame, origin: DataFrame) -> DataFrame:
    """One row: ten counters over the whole corpus; an empty corpus counts 0."""
    rows = releases.select("url", "grade", "detail_id", "date", "body", "body_html").join(origin.select("url", "origin_url"), "url", "left")
    counters = {
        "teaser": F.col("grade") == "teaser", "stub": F.col("grade") == "stub", "wayback": F.col("origin_url").isNotNull(),
        "platform_id": F.col("origin_url").isNull() & (F.coalesce("detail_id", F.lit("")) != ""), "short": flags.short(), "empty": flags.empty(),
        "nodate": flags.nodate(), "mojibake": flags.mojibake(), "plain": flags.plain(),
    }
    return rows.agg(F.count("*").alias("total"), *[count_if(c).alias(name) for name, c in counters.items()])


def list_sources(releases: DataFrame) -> DataFrame:
    """A row a source: rows, span of the dates there are, gaps; largest first."""
    day = F.when(F.col("date") != "", F.col("date"))
    return releases.groupBy("source").agg(
        F.count("*").alias("n"), F.min(day).alias("first"), F.max(day).alias("last"), count_if(flags.teaser()).alias("teaser"),
        count_if(flags.short()).alias("short"), count_if(flags.nodate()).alias("nodate"), count_if(flags.mojibake()).alias("mojibake"), count_if(flags.plain()).alias("plain"),
    )


def companies(tags: DataFrame) -> dict[str, list[str]]:
    """Company \u2192 its sources in order; the dimension is a fixed table of a few dozen rows."""
    out: dict[str, list[str]] = {}
    for r in tags.filter("slug IS NOT NULL").orderBy("ord", "source").collect():
        out.setdefault(r["slug"], []).append(r["source"])
    return out


def company_of(rows: DataFrame, tags: DataFrame, unknown: str = "other") -> DataFrame:
    """Rows with the slug and label of their source's company; sources without one get ``unknown``."""
    return rows.join(tags.select("source", "slug", "label"), "source", "left").withColumn("slug", F.coalesce("slug", F.lit(unknown))).withColumn("label", F.coalesce("label", F.lit(unknown)))


def roll_up(sources: DataFrame, tags: DataFrame) -> DataFrame:
    """Sources summed up to companies, with the span of all and the sources' names in order."""
    totals = [F.sum(c).alias(c) for c in ("n", "teaser", "short", "nodate", "mojibake", "plain")]
    return company_of(sources, tags).groupBy("slug", "label").agg(*totals, F.min("first").alias("first"), F.max("last").alias("last"), F.array_join(F.array_sort(F.collect_list("source")), ",").alias("sources"))
