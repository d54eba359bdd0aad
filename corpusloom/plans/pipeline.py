"""Multi-step flows over the corpus: scores, verification by extracting again, encoding
reports, catch-up from cached bytes. Each is one plan; nothing loops over rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import address, parsers, text
from corpusloom.functions.decode import decode_html, repair
from corpusloom.functions.flags import damaged, mojibake
from corpusloom.functions.richtext import extract, text_of
from corpusloom.operators import gates
from corpusloom.session import spread
from corpusloom.sources.pages import kind_of


def detail_score(title="title", body="body") -> Column:
    """A page's worth: its text's length, one for a title alone."""
    size = F.length(F.coalesce(F.col(body), F.lit("")))
    return F.when(size > 0, size).when(F.coalesce(F.col(title), F.lit("")) != "", 1).otherwise(0)


def extracted_pages(cache: DataFrame) -> DataFrame:
    """(url, body, body_html) of the HTML pages. Bytes of other kinds never reach the parser:
    the guard is part of its argument, as a filter may be moved behind a UDF."""
    html = F.when(kind_of() == "html", decode_html())
    return spread(cache.select("url", html.alias("source"))).select("url", extract("source").alias("e")).select("url", "e.body", "e.body_html")


def verdicts(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows (key, body, ...) with the best of their verdicts against the candidate bodies of
    their capture (key, body): exact; typography (white space and bullets aside); inside (the
    body is a stretch of the page); holds (the page is a stretch of the body); mismatch."""
    both = rows.join(candidates.select("key", F.col("body").alias("other")), "key", "left")
    a, b = (text.word_characters(F.coalesce(F.col(c), F.lit(""))) for c in ("body", "other"))
    rank = F.when(F.col("other").isNull(), 0).when(F.col("body") == F.col("other"), 5).when(gates.same_text("body", "other"), 4).when((F.length(a) > 0) & F.contains(b, a), 3).when((F.length(b) > 0) & F.contains(a, b), 2).otherwise(1)
    best = both.groupBy("key").agg(F.max(rank).alias("rank"))
    names = F.element_at(F.array(*map(F.lit, ("mismatch", "holds", "inside", "typography", "exact"))), F.greatest("rank", F.lit(1)).cast("int"))
    return rows.join(best, "key").withColumn("verdict", names)


def verify_origins(releases: DataFrame, origins: DataFrame, cache: DataFrame) -> DataFrame:
    """(id, origin_class, verdict): each recorded body against what its source's parser sees in
    its capture; no_bytes and not_html where there is nothing to parse. A page is parsed once
    for each source and address asked of it."""
    rows = origins.join(releases.select("id", "url", "source", "detail_id", "body"), "url").withColumn("origin_class", address.origin_class())
    kinds = cache.select(F.col("url").alias("origin_url"), kind_of().alias("kind"))
    rows = rows.join(kinds, "origin_url", "left").withColumn("key", F.sha1(F.concat_ws("\x00", F.coalesce("source", F.lit("")), "origin_url", "url")))
    asked = rows.filter("kind = 'html'").select("key", "source", F.col("url").alias("wanted"), "origin_url").distinct()
    pages = cache.select(F.col("url").alias("origin_url"), F.when(kind_of() == "html", decode_html()).alias("page"))
    candidates = parsers.candidate_bodies(spread(asked.join(pages, "origin_url").withColumn("url", F.col("wanted"))))
    judged = verdicts(rows.filter("kind = 'html'").select("key", "body").distinct().withColumn("body", F.coalesce("body", F.lit(""))), candidates).select("key", F.col("body").alias("b"), "verdict")
    both = rows.withColumn("b", F.coalesce("body", F.lit(""))).join(judged, ["key", "b"], "left")
    verdict = F.when(F.col("kind").isNull(), "no_bytes").when(F.col("kind") != "html", "not_html").otherwise(F.col("verdict"))
    return both.select("id", "origin_class", verdict.alias("verdict"))


def encoding_report(releases: DataFrame) -> DataFrame:
    """A row a source with damaged bodies: how many, how many the repair mends, by method, how
    many it refuses, and on how many the two detectors differ."""
    rows = releases.filter(damaged() | mojibake()).select("source", "body", damaged().alias("narrow"), mojibake().alias("wide"), repair().alias("r"))
    method = F.col("r.method")
    return rows.groupBy("source").agg(F.count("*").alias("damaged"), F.count_if(method != "").alias("repairable"), F.count_if(method.contains("latin1")).alias("c1"), F.count_if(method.contains("utf8")).alias("mojibake"), F.count_if(F.col("narrow") & (method == "")).alias("refused"), F.count_if(F.col("narrow") != F.col("wide")).alias("differ"))


def capture_words(origins: DataFrame, cache: DataFrame) -> DataFrame:
    """(url, words): the text of each recorded capture without its tags."""
    pages = cache.select(F.col("url").alias("origin_url"), F.when(kind_of() == "html", decode_html()).alias("page")).filter("page IS NOT NULL")
    plain = F.trim(F.regexp_replace(F.regexp_replace("page", r"(?s)<[^>]*>", " "), r"(?U)\s+", " "))
    return origins.join(pages, "origin_url").select("url", plain.alias("words"))


def verify_encoding(releases: DataFrame, origins: DataFrame, cache: DataFrame) -> DataFrame:
    """(id, verdict) of the rows that the narrow detector calls damaged: repairable (the write
    missed it), in_source (the capture itself has the damage) or refused."""
    rows = releases.filter(damaged()).select("id", "url", repair()["method"].alias("method"))
    seen = capture_words(origins, cache).groupBy("url").agg(F.max(F.col("words").rlike("[\\x{80}-\\x{9F}]|[ÃÂĂâ][\\x{80}-\\x{17F}\\x{20AC}]")).alias("there"))
    both = rows.join(seen, "url", "left")
    return both.select("id", F.when(F.col("method") != "", "repairable").when(F.col("there"), "in_source").otherwise("refused").alias("verdict"))


def parsed_pages(cache: DataFrame) -> DataFrame:
    """(url, title, body, body_html, html) of the cache, as the strategies of ``ingest`` take them."""
    kind, page = kind_of(), decode_html()
    rows = spread(cache.select("url", (kind == "html").alias("html"), F.when(kind == "html", page).alias("source")))
    title = F.trim(F.regexp_replace(F.regexp_extract("source", r"(?is)<h1[^>]*>(.*?)</h1", 1), r"<[^>]*>", ""))
    return rows.select("url", title.alias("title"), "html", extract("source").alias("e")).select("url", "title", "e.body", "e.body_html", "html")


def retext(releases: DataFrame) -> DataFrame:
    """(id, body) of the rows whose text doesn't follow from their markup any more."""
    rows = spread(releases.filter("body_html IS NOT NULL").select("id", F.col("body").alias("old"), "body_html")).select("id", "old", text_of("body_html").alias("body"))
    return rows.filter(~F.col("old").eqNullSafe(F.col("body"))).select("id", "body")
