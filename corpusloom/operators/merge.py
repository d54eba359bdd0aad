"""Writes as plans: insert or ignore, upgrade by COALESCE, origins. Tables of files know no
MERGE, so each is a join whose result is written as the next version (see sources.versions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.address import is_capture
from corpusloom.functions.decode import repair
from corpusloom.operators.dedupe import first


def insert_or_ignore(stored: DataFrame, incoming: DataFrame, key: str = "url") -> DataFrame:
    """Incoming rows whose key isn't stored yet, the first arrival of each, with new ids.

    ``incoming`` carries ``ord``. Ids follow the arrival: partitions ordered by range count
    their rows, and only those counts are summed up, so no task sees all rows.
    """
    new = first(incoming, [key]).join(stored.select(key), key, "left_anti")
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    parts = new.repartitionByRange("ord").withColumn("part", F.spark_partition_id())
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    offset = sizes.withColumn("offset", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "offset")
    nth = F.row_number().over(Window.partitionBy("part").orderBy("ord"))
    ids = parts.withColumn("nth", nth).join(offset, "part").join(top)
    return ids.withColumn("id", F.col("top") + F.col("offset") + F.col("nth")).drop("part", "nth", "offset", "top", "ord")


def insert_releases(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """``insert_or_ignore`` for releases: titles are repaired, bodies where there is no markup
    that they follow from, and a row without a grade is a full one."""
    new = incoming.withColumn("title", repair("title")["text"]).withColumn("body", F.when(F.col("body_html").isNull(), repair("body")["text"]).otherwise(F.col("body")))
    return insert_or_ignore(stored, new.withColumn("grade", F.coalesce("grade", F.lit("full"))))


def coalesce_upgrade(stored: DataFrame, updates: DataFrame, columns: list[str], key: str = "url") -> DataFrame:
    """Stored rows with the updates' columns laid over: '' overwrites, null keeps."""
    new = updates.select(key, *[F.col(c).alias(f"new_{c}") for c in columns])
    merged = stored.join(new, key, "left")
    return merged.select(*[F.coalesce(f"new_{c}", c).alias(c) if c in columns else F.col(c) for c in stored.columns])


def record_origins(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Origins with the updates', the newest (``ord``) of each url; anything but a capture's
    address is an error."""
    checked = updates.withColumn("origin_url", F.when(is_capture("origin_url"), F.col("origin_url")).otherwise(F.raise_error(F.concat(F.lit("no capture address: "), F.coalesce("origin_url", F.lit("null"))))))
    both = stored.withColumn("ord", F.lit(-1)).unionByName(checked.select("url", "origin_url", F.col("ord").cast("int")))
    return both.groupBy("url").agg(F.max_by("origin_url", "ord").alias("origin_url"))


def clear_origins(stored: DataFrame, urls: DataFrame) -> DataFrame:
    return stored.join(urls.select("url"), "url", "left_anti")
