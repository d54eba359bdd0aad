"""The page cache: bytes, their hash, their kind by the leading bytes, stores of new pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import dedupe


def content_hash(content="content") -> Column:
    return F.sha2(F.col(content), 256)


def magic(content="content") -> Column:
    return F.hex(F.substring(F.col(content), 1, 8))


def kind_of(content="content") -> Column:
    """pdf, doc, rtf, html or unrecognised, from the first eight bytes alone."""
    head = magic(content)
    return F.when(head.startswith("25504446"), "pdf").when(head.startswith("D0CF11E0"), "doc").when(head.startswith("7B5C727466"), "rtf").when(F.ltrim(F.substring(F.col(content), 1, 64).cast("string"), F.lit(" \t\r\n")).startswith("<"), "html").otherwise("unrecognised")


def same_bytes(cache: DataFrame) -> DataFrame:
    """(content_sha256, urls, least url): bytes kept under several addresses, a row each; the
    members are joined back by the hash, so no pairs are listed."""
    return cache.filter("content_sha256 IS NOT NULL").groupBy("content_sha256").agg(F.count("*").alias("urls"), F.min("url").alias("first_url")).filter("urls > 1")


def store(cache: DataFrame, fetched: DataFrame, replace: bool = False, order: str = "fetched_at") -> DataFrame:
    """The cache with fetched pages, each address once: its first copy stays, or with ``replace``
    its last wins. Pages without a time are stamped now."""
    new = fetched.withColumn("content_sha256", content_hash()).withColumn("fetched_at", F.coalesce("fetched_at", F.unix_timestamp().cast("double")) if "fetched_at" in fetched.columns else F.unix_timestamp().cast("double"))
    new = (dedupe.last if replace else dedupe.first)(new.withColumn("ord", F.col(order)), ["url"]).drop("ord")
    if replace:
        return cache.join(new.select("url"), "url", "left_anti").unionByName(new, allowMissingColumns=True)
    return cache.unionByName(new.join(cache.select("url"), "url", "left_anti"), allowMissingColumns=True)


def is_attachment(content="content") -> Column:
    return kind_of(content).isin("pdf", "doc")


def looks_like_html(content="content") -> Column:
    """Not empty, and none of the known binary kinds."""
    return F.coalesce((F.octet_length(content) > 0) & ~magic(content).rlike("^(25504446|D0CF11E0|7B5C727466|504B0304|89504E47|FFD8FF|47494638)"), F.lit(False))


def page_url(url="url") -> Column:
    """Addresses of pages by their ending, the query aside."""
    return F.coalesce(F.lower(F.regexp_extract(url, "^[^?]*", 0)).rlike(r"\.html?$"), F.lit(False))


def under(prefix: Column, url: Column) -> Column:
    """True if an address lies in the folder that another one names, whatever the host's spelling."""
    path = lambda u: F.coalesce(F.parse_url(u, F.lit("PATH")), F.lit(""))
    return F.coalesce(F.startswith(path(url), path(prefix)), F.lit(False))


def site_of(urls: DataFrame, sites: dict[str, str], url: str = "url") -> DataFrame:
    """Addresses with the site (name \u2192 prefix, a handful) whose folder they lie in, or null;
    folders of two sites don't nest."""
    found = F.lit(None).cast("string")
    for name, prefix in sites.items():
        found = F.when(under(F.lit(prefix), F.col(url)), name).otherwise(found)
    return urls.withColumn("site", found)


def domain_variants(urls: DataFrame, domains: list[str], url: str = "url") -> DataFrame:
    """(url, variant, place): an address (place 0) and the same on each of its mirrors' domains;
    one on none of them stands alone."""
    own = F.lit(None).cast("string")
    for d in reversed(domains):
        own = F.when(F.instr(F.col(url), d) > 0, d).otherwise(own)
    others = F.filter(F.array(*map(F.lit, domains)), lambda d: d != F.col("own"))
    variants = F.when(F.col("own").isNull(), F.array(F.col(url))).otherwise(F.concat(F.array(F.col(url)), F.transform(others, lambda d: F.replace(F.col(url), F.col("own"), d))))
    rows = urls.withColumn("own", own).withColumn("variants", variants)
    return rows.select(F.col(url).alias("address"), F.posexplode("variants").alias("place", "variant")).withColumnRenamed("address", "url")


def like_scan(cache: DataFrame, pattern: str) -> DataFrame:
    """Addresses by a case-insensitive LIKE pattern."""
    return cache.filter(F.col("url").ilike(pattern)).select("url")
