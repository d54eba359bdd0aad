"""The search as readers use it: checked parameters in, a page of rows and its cursor out.

Pages are bounded by their limit, so they may be collected; all before that is one plan.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import flags
from corpusloom.operators import corpus, fts

ORDERS = ("rank", "date")


class BadRequest(ValueError):
    """A parameter that can't be meant; silently dropping it would answer another question."""


@dataclass
class Request:
    q: str = ""
    sources: list[str] = field(default_factory=list)
    since: str = ""
    until: str = ""
    flags: list[str] = field(default_factory=list)
    order: str = "rank"
    limit: int = corpus.PAGE
    after: tuple[str, tuple[str, int] | int] | None = None
    empty: bool = False  # no source can match


def checked(params: dict[str, str | list[str]], companies: dict[str, list[str]]) -> Request:
    """The request that parameters make; ``companies``: slug \u2192 its sources. Sources and
    companies together mean their intersection."""
    one = lambda k, default="": (v[-1] if isinstance(v := params.get(k, default), list) else v) or default
    many = lambda k: [x for v in (params.get(k) or []) for x in v.split(",") if x] if isinstance(params.get(k), list) else [x for x in (params.get(k) or "").split(",") if x]
    if unknown := [f for f in many("flags") if f not in flags.FLAGS]:
        raise BadRequest(f"unknown flags: {', '.join(unknown)}; there are {', '.join(flags.FLAGS)}")
    if unknown := [c for c in many("company") if c not in companies]:
        raise BadRequest(f"unknown companies: {', '.join(unknown)}; there are {', '.join(companies)}")
    if (order := one("order", "rank")) not in ORDERS:
        raise BadRequest(f"order is one of {', '.join(ORDERS)}")
    try:
        after, limit = corpus.parse_cursor(one("after")), corpus.clamp(int(one("limit", str(corpus.PAGE))))
    except ValueError as error:
        raise BadRequest(str(error)) from error
    sources, of = many("source"), [s for c in many("company") for s in companies[c]]
    both = ([s for s in sources if s in of] if sources else of) if many("company") else sources
    return Request(one("q").strip(), both, one("from"), one("to"), many("flags"), order, limit, after, bool(many("company")) and not both)


def rows_of(releases: DataFrame, origins: DataFrame, index: fts.Index | None, r: Request) -> tuple[DataFrame, str | None]:
    """(list rows of the page and one more, how the query was read). With a query the order is
    by rank or date, and offsets reach to ``fts.DEEPEST``; without, by date and key."""
    kept = corpus.where(releases, r.sources, r.since, r.until, r.flags)
    kept = kept.filter(F.lit(not r.empty))
    if not r.q:
        after = r.after[1] if r.after and r.after[0] == "d" else None
        page = corpus.browse(kept.withColumn("date", F.coalesce("date", F.lit(""))), r.limit, after)
        return corpus.list_rows(page, origins).join(page.select("id", F.substring(F.coalesce("body", F.lit("")), 1, corpus.EXCERPT).alias("excerpt")), "id").orderBy(F.desc("date"), F.desc("id")), None
    offset = min(r.after[1], fts.DEEPEST) if r.after and r.after[0] == "o" else 0
    tree, mode = fts.read(r.q)
    found = fts.matches(index.postings, tree).join(kept.select("id", "date"), "id") if r.order == "date" else fts.bm25(index, tree).join(kept.select("id", "date"), "id")
    order = [F.desc(F.coalesce("date", F.lit(""))), F.desc("id")] if r.order == "date" else [F.col("score"), F.col("id")]
    page = found.orderBy(*order).offset(offset).limit(r.limit + 1)
    page = fts.with_snippet(page.drop("date").join(releases, "id"), r.q).withColumnRenamed("snippet", "excerpt")
    more = ["excerpt"] if r.order == "date" else ["excerpt", "score"]
    rows = corpus.list_rows(page, origins).join(page.select("id", *more), "id")
    return rows.orderBy(*([F.desc("date"), F.desc("id")] if r.order == "date" else [F.col("score"), F.col("id")])), mode


def page(releases: DataFrame, origins: DataFrame, index: fts.Index | None, r: Request) -> dict:
    """{results, next, truncated, query_mode}: ``truncated`` says that there is more than the
    deepest offset reaches."""
    rows, mode = rows_of(releases, origins, index, r)
    found = [row.asDict() for row in rows.collect()]  # limit + 1 at most
    more = len(found) > r.limit
    found = found[: r.limit]
    if not r.q:
        return {"results": found, "next": f"d:{found[-1]['date']}:{found[-1]['id']}" if more else None, "truncated": False, "query_mode": None}
    offset = (min(r.after[1], fts.DEEPEST) if r.after and r.after[0] == "o" else 0) + r.limit
    onward = f"o:{offset}" if more and offset < fts.DEEPEST else None
    for row in found:
        row["excerpt"] = re.split(f"{fts.OPEN}|{fts.CLOSE}", row["excerpt"] or "")  # every other part is a hit
    return {"results": found, "next": onward, "truncated": more and onward is None, "query_mode": mode}


def as_json(payload: dict) -> str:
    return json.dumps(payload, ensure_ascii=False, default=str)


def as_lines(payload: dict, full: bool = False) -> list[str]:
    """Rows for a terminal; ``full`` adds the excerpt."""
    out = []
    for r in payload["results"]:
        out.append(f"#{r['id']} {r['date'] or 'undated':10} {r['source']}  {r['title']}")
        if full:
            out.append("    " + ("".join(r["excerpt"]) if isinstance(r["excerpt"], list) else r["excerpt"] or ""))
    return out


def detail(releases: DataFrame, origins: DataFrame, release_id: int) -> DataFrame:
    """One row with its text, its capture where that is another page than its own, and its
    neighbours within its source by date and id, each found by a bounded sort."""
    row = corpus.release(releases, origins, release_id)
    here = releases.filter(F.col("id") == release_id).select(F.col("source").alias("s"), F.coalesce("date", F.lit("")).alias("d"), F.lit(True).alias("h"))
    rows = releases.select("id", "source", F.coalesce("date", F.lit("")).alias("date")).join(F.broadcast(here.limit(1)), F.col("source").eqNullSafe(F.col("s")))
    key = F.struct("date", "id")
    place = F.struct(F.col("d").alias("date"), F.lit(release_id).cast("long").alias("id"))
    beside = rows.groupBy("h").agg(F.max(F.when(key < place, key))["id"].alias("prev_id"), F.min(F.when(key > place, key))["id"].alias("next_id"))
    other = F.when(F.col("capture_kind").isNotNull(), F.col("origin_url"))
    from corpusloom.functions import address

    return row.withColumn("capture_kind", address.capture_kind()).withColumn("origin_url", other).withColumn("h", F.lit(True)).join(beside, "h", "left").drop("h")
