"""The call log and arriving releases as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.merge import insert_or_ignore
from corpusloom.sources.versions import Writer

#: A report's window, and how late a call may come.
WINDOW, LATE, GAP = "15 minutes", "1 hour", "10 minutes"
CALLS = T.StructType([T.StructField(n, t) for n, t in (("id", T.LongType()), ("ts", T.DoubleType()), ("kind", T.StringType()), ("url", T.StringType()), ("attempt", T.IntegerType()), ("timeout_budget", T.DoubleType()), ("outcome", T.StringType()), ("duration", T.DoubleType()))])


def read_calls(spark: SparkSession, folder: str, files_at_once: int = 1) -> DataFrame:
    """Calls as they are appended to a folder, each id once within the time of lateness."""
    rows = spark.readStream.schema(CALLS).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    return timed(rows).withWatermark("at", LATE).dropDuplicatesWithinWatermark(["id"])


def timed(calls: DataFrame) -> DataFrame:
    return calls.withColumn("at", F.timestamp_seconds("ts"))


def by_window(calls: DataFrame) -> DataFrame:
    """Calls, failures and mean duration of each window, kind and outcome; streams and batches alike."""
    grouped = calls.groupBy(F.window("at", WINDOW).alias("w"), "kind")
    return grouped.agg(F.count("*").alias("n"), F.coalesce(F.count_if(F.col("outcome") != "ok"), F.lit(0)).alias("failed"), F.round(F.avg("duration"), 6).alias("mean")).select(F.col("w.start").alias("start"), "kind", "n", "failed", "mean")


def sessions(calls: DataFrame) -> DataFrame:
    """Bursts of calls: runs of one kind with at most GAP between."""
    return calls.groupBy(F.session_window("at", GAP).alias("w"), "kind").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "kind", "n")


def upsert_stream(rows: DataFrame, writer: Writer, checkpoint: str):
    """Arriving releases (with ``ord``) into the versioned table, an append a batch: only the
    stored keys are read and only new rows written. A batch that is run again finds its
    urls stored and adds nothing."""

    def commit(batch: DataFrame, number: int) -> None:
        keys = writer.table("releases").select("id", "url")
        new = insert_or_ignore(keys, batch.withColumn("ord", F.coalesce("ord", F.monotonically_increasing_id())))
        writer.commit({"releases": new}, append=True)

    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
