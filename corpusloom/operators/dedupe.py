"""Keeping one row of several, always by aggregates that combine within each task.

The order of arrival is explicit everywhere (``ord``), as ties are settled by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep(rows: DataFrame, keys: list[str], best: list[Column], last: bool = False, order: str = "ord") -> DataFrame:
    """The row of each key for which ``best`` is greatest; ties go to the first arrival, or
    the last. Without ``best`` that is the first or last arrival itself."""
    rank = F.struct(*[b.alias(f"b{i}") for i, b in enumerate(best)], (F.col(order) if last else -F.col(order)).alias("o"))
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), rank).alias("kept")).select(*keys, "kept.*")


def longest(rows: DataFrame, keys: list[str], text: str = "body") -> DataFrame:
    return keep(rows, keys, [F.length(F.coalesce(F.col(text), F.lit("")))])


def first(rows: DataFrame, keys: list[str]) -> DataFrame:
    return keep(rows, keys, [])


def last(rows: DataFrame, keys: list[str]) -> DataFrame:
    return keep(rows, keys, [], last=True)


def twins(releases: DataFrame, key: Column, short: int = 300, gain: int = 3) -> DataFrame:
    """(id, twin_id, accepted): short rows beside the longest row of the same source, title
    and date. Undated and untitled rows take no part; accepted if the longest is itself not
    short and at least ``gain`` times as long."""
    rows = releases.select("id", "source", "date", key.alias("title_key"), F.length(F.coalesce("body", F.lit(""))).alias("size")).filter((F.coalesce("date", F.lit("")) != "") & (F.coalesce("title_key", F.lit("")) != ""))
    keys = ["source", "title_key", "date"]
    best = rows.groupBy(*keys).agg(F.max(F.struct("size", (-F.col("id")).alias("o"))).alias("best"), F.count("*").alias("n")).filter("n > 1").select(*keys, F.col("best.size").alias("best_size"), (-F.col("best.o")).alias("twin_id"))
    pairs = rows.filter(F.col("size") < short).join(best, keys).filter("id <> twin_id")
    return pairs.select("id", "twin_id", ((F.col("best_size") >= short) & (F.col("best_size") >= gain * F.col("size"))).alias("accepted"))


def best_capture(captures: DataFrame) -> DataFrame:
    """The capture chosen for each page out of its scored captures (page, ts, score; a null
    score is a failed fetch).

    Candidates are the earliest that holds a text, the first of a later year than that, and
    the newest that holds one (other than those). The highest score wins, equal scores go
    to the earlier. Rows: (page, ts, score, earliest, complete); ``ts`` is null if none
    holds a text.
    """
    good = F.col("score") > 0
    base = captures.groupBy("page").agg(F.min("ts").alias("earliest"), F.min(F.when(good, F.col("ts"))).alias("t1"), (F.count_if(F.col("score").isNull()) == 0).alias("complete"))
    rows = captures.join(base, "page")
    year = lambda c: F.substring(c, 1, 4).cast("int")
    second = rows.filter(year("ts") >= year("t1") + 1).groupBy("page").agg(F.min("ts").alias("t2"))
    rows = rows.join(second, "page", "left")
    third = rows.filter(good & (F.col("ts") > F.col("t1")) & ~F.col("ts").eqNullSafe(F.col("t2"))).groupBy("page").agg(F.max("ts").alias("t3"))
    rows = rows.join(third, "page", "left").filter(good & ((F.col("ts") == F.col("t1")) | (F.col("ts") == F.col("t2")) | (F.col("ts") == F.col("t3"))))
    chosen = rows.groupBy("page").agg(F.max_by(F.struct("ts", "score"), F.struct("score", (-F.col("ts").cast("decimal(14,0)")).alias("o"))).alias("c"))
    return base.join(chosen, "page", "left").select("page", F.col("c.ts").alias("ts"), F.col("c.score").alias("score"), "earliest", "complete")


def selection_overrides(captures: DataFrame) -> DataFrame:
    """(page, taken, taken_score, passed, passed_score, why): pages whose chosen capture is not
    their earliest; ``passed_score`` is null where the earliest could not be fetched."""
    first = captures.groupBy("page").agg(F.min_by("score", F.struct("ts", (-F.coalesce("score", F.lit(-1))).alias("s"))).alias("passed_score"))
    rows = best_capture(captures).filter("ts IS NOT NULL AND ts <> earliest").join(first, "page")
    why = F.when(F.col("passed_score").isNull(), "unreachable").when(F.col("passed_score") <= 0, "no text").otherwise("less text")
    return rows.select("page", F.col("ts").alias("taken"), F.col("score").alias("taken_score"), F.col("earliest").alias("passed"), "passed_score", why.alias("why"))
