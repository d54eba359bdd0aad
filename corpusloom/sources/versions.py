"""Versioned tables in a folder: every commit writes its rows under ``v=N`` and then swaps one
small pointer file, which names the parts that make each table. So readers see all of a
commit or nothing of it, an append writes new rows alone, and what a commit doesn't touch
stays where it is.

A pointer is replaced by an atomic rename on a file system that has one (local, HDFS);
object stores need a conditional put instead.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from corpusloom.schema import TYPES

#: The pointer's name, and parts of a table from which an append rewrites it as one.
POINTER, MOST_PARTS = "_CURRENT", 32


class Reader:
    """Reads the current version; has no way to write."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _state(self) -> dict | None:
        pointer = self._path(f"{self.root}/{POINTER}")
        if not self._fs.exists(pointer):
            return None
        stream = self._fs.open(pointer)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def version(self) -> int | None:
        state = self._state()
        return state and state["version"]

    def table(self, name: str) -> DataFrame:
        if (state := self._state()) is None or name not in state["parts"]:
            raise FileNotFoundError(f"no {name} in {self.root}")
        return self.spark.read.parquet(*[f"{self.root}/{part}" for part in state["parts"][name]])


class Writer(Reader):
    def commit(self, tables: dict[str, DataFrame], partition_by: dict[str, str] | None = None, append: bool = False) -> int:
        """Write the tables as the next version, or with ``append`` their rows beside those that
        are there, then point to it. A failure before the swap leaves the current version
        as it is. Other tables stay as they were."""
        state = self._state() or {"version": 0, "parts": {}}
        number, parts = state["version"] + 1, dict(state["parts"])
        for name, rows in tables.items():
            old = parts.get(name, []) if append else []
            if len(old) >= MOST_PARTS:
                rows, old = self.table(name).unionByName(rows, allowMissingColumns=True), []
            writer = rows.write.mode("overwrite")
            if partition_by and name in partition_by:
                writer = writer.partitionBy(partition_by[name])
            writer.parquet(f"{self.root}/v={number}/{name}")
            parts[name] = [*old, f"v={number}/{name}"]
        fresh = self._path(f"{self.root}/{POINTER}.{number}")
        stream = self._fs.create(fresh, True)
        stream.write(bytearray(json.dumps({"version": number, "parts": parts}).encode("utf-8")))
        stream.close()
        pointer = self._path(f"{self.root}/{POINTER}")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        option = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        context.rename(fresh, pointer, options)
        return number


def init_schema(spark: SparkSession, root: str) -> Writer:
    """A writer over the folder, with empty tables in it if it has none yet."""
    writer = Writer(spark, root)
    if writer.version() is None:
        writer.commit({name: spark.createDataFrame([], types) for name, types in TYPES.items()})
    return writer
