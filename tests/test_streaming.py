import json

import pytest

from pyspark.sql import functions as F

from corpusloom.sources.captures import CaptureIndex
from corpusloom.sources.versions import Writer
from corpusloom.streaming import calls


def rows(spark, n=40):
    data = [(i % 30, 1_000_000.0 + 60 * (i % 30), "content", None, 1, 30.0, "ok" if i % 3 else "503", 1.5) for i in range(n)]
    return spark.createDataFrame(data, calls.CALLS)


def test_a_stream_counts_what_a_batch_counts(spark, tmp_path):
    for part in range(2):
        rows(spark).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = calls.by_window(calls.read_calls(spark, f"{tmp_path}/in", 10))
    query = stream.writeStream.outputMode("update").format("memory").queryName("windows").option("checkpointLocation", f"{tmp_path}/cp").start()
    query.processAllAvailable()
    query.stop()
    batch = calls.by_window(calls.timed(rows(spark).dropDuplicates(["id"])))
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, batch.collect()))


def test_sessions_split_at_gaps(spark):
    data = [(1, 0.0), (2, 300.0), (3, 901.0), (4, 1499.0), (5, 3000.0)]
    df = spark.createDataFrame(data, "id long, ts double").withColumn("kind", F.lit("k"))
    assert sorted(r["n"] for r in calls.sessions(calls.timed(df)).collect()) == [1, 2, 2]


def test_upserts_are_idempotent(spark, tmp_path):
    writer = Writer(spark, f"file://{tmp_path}/t")
    writer.commit({"releases": spark.createDataFrame([(1, "a")], "id long, url string")})
    spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "url string, ord long").coalesce(1).write.parquet(f"{tmp_path}/in")
    for k in range(2):
        stream = spark.readStream.schema("url string, ord long").parquet(f"{tmp_path}/in")
        query = calls.upsert_stream(stream, writer, f"{tmp_path}/cp{k}").trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(map(tuple, writer.table("releases").collect())) == [(1, "a"), (2, "b")]


def test_capture_index_reads_a_file(spark, tmp_path):
    with open(tmp_path / "c.jsonl", "w") as out:
        for ts in ("20010101000000", "20020101000000"):
            out.write(json.dumps({"timestamp": ts, "url": "http://x/a", "status": "200"}) + "\n")
    spark.dataSource.register(CaptureIndex)
    reader = spark.read.format("captures").option("fetcher", "corpusloom.sources.captures:from_file").option("file", str(tmp_path / "c.jsonl"))
    assert reader.option("urls", "http://x/a\nhttp://x/b").load().count() == 2
    assert reader.option("urls", "http://x/").option("prefix", "true").load().select(F.max("timestamp")).first()[0] == "20020101000000"
    assert reader.option("urls", "").load().count() == 0


def test_an_answer_that_is_not_whole_is_an_error(spark, tmp_path):
    with open(tmp_path / "c.jsonl", "w") as out:
        for host in ("http://x/a", "https://www.x/A/", "http://x/b"):
            out.write(json.dumps({"timestamp": "20010101000000", "url": host, "status": "200"}) + "\n")
    spark.dataSource.register(CaptureIndex)
    reader = spark.read.format("captures").option("fetcher", "corpusloom.sources.captures:from_file").option("file", str(tmp_path / "c.jsonl")).option("prefix", "true").option("urls", "http")
    assert reader.load().count() == 3 and reader.option("collapse", "true").load().count() == 2
    with pytest.raises(Exception, match="more than 2"):
        reader.option("limit", "2").load().collect()
