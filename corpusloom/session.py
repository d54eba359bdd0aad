"""Session helpers that hold for every job: table access, spreading, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schema import COLUMNS

#: Whether Spark removes the shuffle files of an execution when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir`` (a file or a folder of parts), with the
    columns the corpus knows; others can't clash with what operators add."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(COLUMNS[name].split()) if name in COLUMNS else rows


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a temporary one is made.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corpusloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Unlike a checkpoint it is columnar, so later scans prune columns and push filters. The
    shuffle files of the job that wrote it are removed at once, as nothing needs them any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give small inputs at least a partition a core before a Python stage.

    Large inputs already have more splits than cores and are left as they are, so no
    shuffle is added where it would cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def blank(col):
    """True where a text is null or holds only white space (Unicode sense)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(~col.rlike(r"(?U)\S"), F.lit(True))


def default_sf_dir() -> str:
    return os.environ.get("CORPUSLOOM_SF_DIR", "/root/testdata/sf0.001")


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made, once nothing reads it any more."""
    spark = df.sparkSession
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
