import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BinaryType()
SCHEMAS = {
    "releases": [("id", L), ("source", S), ("detail_id", S), ("title", S), ("date", S), ("url", S), ("body", S), ("body_html", S), ("grade", S)],
    "page_cache": [("url", S), ("content", B), ("id_content_type", S), ("fw_guessed_charset", S), ("bs4_encoding", S), ("content_sha256", S), ("fetched_at", D)],
    "body_origin": [("url", S), ("origin_url", S)],
    "wayback_calls": [("id", L), ("ts", D), ("kind", S), ("url", S), ("attempt", I), ("timeout_budget", D), ("outcome", S), ("duration", D)],
    "terratec_early__listing_1": [("url", S), ("title", S), ("date", S), ("date_str", S), ("lang", S), ("body", S), ("body_html", S), ("citation", S)],
    "documents": [("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L), ("url", S), ("title", S), ("crawled_at", T.TimestampType())],
    "source_tags": [("source", S), ("slug", S), ("label", S), ("ord", I), ("lang", S), ("tz", S), ("dayfirst", T.BooleanType())],
    "eval_items": [("item_id", L), ("task", S), ("lang", S), ("text", S), ("answer", S)],
}
#: Names that operators use inside, added to every table to show that they don't clash.
CLASHING = ["page", "pref", "cls", "keys", "bits", "sig", "h", "simhash", "masked", "seed", "rel", "rec_key", "norm", "value", "ids", "s_start", "moment", "k", "ord", "other", "n"]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("corpusloom-tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def tables(spark, tmp_path):
    """tables(releases=[{...}], ...) writes all tables, with what is given and else empty."""

    def write(clash: bool = False, **given) -> str:
        for name, fields in SCHEMAS.items():
            schema = T.StructType([T.StructField(n, t) for n, t in fields])
            rows = [tuple(row.get(n) for n, _ in fields) for row in given.get(name, [])]
            df = spark.createDataFrame(rows, schema)
            if clash:
                for extra in CLASHING:
                    if extra not in df.columns:
                        df = df.selectExpr("*", f"'x' AS {extra}")
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
