"""Filling the corpus: what becomes of what was found, and of the rows left incomplete.

Every strategy is one plan from tables to a table of outcomes, a row an item: (url, outcome,
and the columns to write, null where nothing is written). Fetching and parsing lie outside:
pages come in as rows that were parsed already, so a strategy never opens a connection. A
page that isn't there was not fetched, which confirms nothing: such an item is
'uncertain', nothing is written for it and a later run takes it up again.

``applied`` merges outcomes into the stored tables; ``catch_up`` runs the strategies for
incomplete rows in order of their cost, each upon what the one before has written, and
commits text, grade and origin together.

Defined results: repeated items are taken at their first arrival (``ord``); null texts count
as empty; empty tables give no outcomes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import address
from corpusloom.operators import dedupe, gates, merge
from corpusloom.session import written
from corpusloom.sources.versions import Writer

#: What a strategy may write, in the order of the columns of releases.
WRITES = ("title", "date", "body", "body_html", "detail_id", "grade", "origin_url")
#: Closed set of outcomes.
OUTCOMES = ("added", "upgraded", "teaser", "stub", "skipped", "dead", "uncertain")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _said(*names: str) -> Column:
    """The first of some columns that says anything, else ''."""
    return F.coalesce(*[F.when(F.col(n) != "", F.col(n)) for n in names], F.lit(""))


def _result(rows: DataFrame, outcome: Column, writes: dict[str, Column], when: Column, *more: str) -> DataFrame:
    rows = rows.withColumn("outcome", outcome)
    return rows.select("url", *more, "outcome", *[F.when(when, writes[c]).cast("string").alias(c) if c in writes else F.lit(None).cast("string").alias(c) for c in WRITES])


def _side(rows: DataFrame, prefix: str, *names: str) -> DataFrame:
    """A table's url and some columns, those renamed so that no two sides clash; one row an url
    is expected, repeated rows count once."""
    return rows.select("url", *[F.col(n).alias(f"{prefix}{n}") for n in names], F.lit(True).alias(f"{prefix}there")).distinct()


# -- discovery ----------------------------------------------------------------------------


def from_items(stored: DataFrame, items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items of live listings (url, title, date, detail_id, ord) with their parsed pages (url,
    body, body_html): added if the page holds a text, dead if it holds none."""
    rows = dedupe.first(items, ["url"]).join(_side(stored, "s_"), "url", "left").join(_side(pages, "p_", "body", "body_html"), "url", "left")
    outcome = F.when(F.col("s_there"), "skipped").when(F.col("p_there").isNull(), "uncertain").when(_text("p_body") == "", "dead").otherwise("added")
    writes = {"title": F.col("title"), "date": F.col("date"), "body": F.col("p_body"), "body_html": F.col("p_body_html"), "detail_id": F.col("detail_id"), "grade": F.lit("full")}
    return _result(rows, outcome, writes, F.col("outcome") == "added")


def best_captures(captures: DataFrame) -> DataFrame:
    """(url, ts, confirmed, title, date, body, body_html) of each address asked for, out of its
    parsed captures (url, ts, failed, title, date, body, body_html): the capture whose text is
    worth most among those that ``dedupe.best_capture`` samples. ``ts`` is null where no
    capture was seen; an address is confirmed if a text was found or no fetch failed."""
    score = F.when(F.col("failed"), F.lit(None)).otherwise(F.greatest(F.length(_text("body")), F.when(_text("title") != "", 1).otherwise(0))).cast("long")
    scored = captures.filter("ts IS NOT NULL").select(F.col("url").alias("page"), "ts", score.alias("score"), "title", "date", "body", "body_html")
    chosen = dedupe.best_capture(scored.select("page", "ts", "score"))
    first = dedupe.keep(scored.withColumn("ord", F.lit(0)), ["page", "ts"], [F.coalesce("score", F.lit(-1))]).select("page", "ts", "title", "date", "body", "body_html")
    texts = chosen.filter("ts IS NOT NULL").select("page", "ts").join(first, ["page", "ts"])
    known = chosen.select("page", "earliest", "complete", F.col("ts").isNotNull().alias("found")).join(texts, "page", "left")
    asked = captures.select(F.col("url").alias("page")).distinct()
    rows = asked.join(known, "page", "left")
    return rows.select(F.col("page").alias("url"), F.coalesce("ts", "earliest").alias("ts"), F.coalesce(F.col("found") | F.col("complete"), F.lit(True)).alias("confirmed"), "title", "date", "body", "body_html")


def from_candidates(stored: DataFrame, candidates: DataFrame, captures: DataFrame, stub_if_absent: bool = False) -> DataFrame:
    """Addresses that a listing named (url, title, date, ord) with their captures as
    ``best_captures`` gives them. A text makes a full row, a capture without one a stub; an
    address without a capture is dead, or a stub if that is asked for and the listing says
    anything of it. Only a text has an origin."""
    rows = dedupe.first(candidates, ["url"]).join(_side(stored, "s_"), "url", "left")
    rows = rows.join(_side(captures, "c_", "ts", "confirmed", "title", "date", "body", "body_html"), "url", "left")
    body, seen = _text("c_body"), F.col("c_ts").isNotNull()
    named = F.lit(stub_if_absent) & ((_text("title") != "") | (_text("date") != ""))
    outcome = F.when(F.col("s_there"), "skipped").when(~F.coalesce("c_confirmed", F.lit(False)), "uncertain").when(~seen, F.when(named, "stub").otherwise("dead")).when(body != "", "added").otherwise("stub")
    writes = {
        "title": _said("c_title", "title"), "date": _said("c_date", "date"), "body": F.when(seen, body), "body_html": F.when(_text("c_body_html") != "", F.col("c_body_html")),
        "detail_id": F.col("c_ts"), "grade": F.when(body != "", "full").otherwise("stub"), "origin_url": F.when(body != "", address.capture_url(F.col("c_ts"), F.col("url"))),
    }
    return _result(rows, outcome, writes, F.col("outcome").isin("added", "stub"))


def from_teasers(stored: DataFrame, entries: DataFrame, details: DataFrame, prefer_parsed: bool = False) -> DataFrame:
    """Entries of a listing (url, title, date, teaser, teaser_html, origin_url, ord) with their
    own pages as ``best_captures`` gives them: the page's text upgrades a stored teaser or
    adds a row; where it is confirmed that there is none, the teaser itself is stored."""
    rows = dedupe.first(entries, ["url"]).join(_side(stored, "s_", "grade"), "url", "left").join(_side(details, "d_", "ts", "confirmed", "title", "date", "body", "body_html"), "url", "left")
    there, teaser, body = F.coalesce("s_there", F.lit(False)), F.coalesce(F.col("s_grade") == "teaser", F.lit(False)), _text("d_body")
    outcome = (
        F.when(there & ~teaser, "skipped").when(body != "", F.when(teaser, "upgraded").otherwise("added")).when(~F.coalesce("d_confirmed", F.lit(False)), "uncertain")
        .when(teaser, "skipped").when(_text("teaser") == "", "dead").otherwise("teaser")
    )
    full = F.col("outcome").isin("added", "upgraded")
    named = lambda c: _said(f"d_{c}", c) if prefer_parsed else F.when(F.col("outcome") != "upgraded", _text(c))
    writes = {
        "title": F.when(full, named("title")).otherwise(_text("title")), "date": F.when(full, named("date")).otherwise(_text("date")), "body": F.when(full, body).otherwise(F.col("teaser")),
        "body_html": F.when(full, F.col("d_body_html")).when(_text("teaser_html") != "", F.col("teaser_html")), "detail_id": F.when(full, F.col("d_ts")), "grade": F.when(full, "full").otherwise("teaser"),
        "origin_url": F.when(full, address.capture_url(F.col("d_ts"), F.col("url"))).otherwise(F.col("origin_url")),
    }
    return _result(rows, outcome, writes, full | (F.col("outcome") == "teaser"))


# -- catching up --------------------------------------------------------------------------


def attachment(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, "^[^?]*", 0)).rlike(r"\.(pdf|doc)$"), F.lit(False))


def pending(releases: DataFrame, source: str | None = None, force: bool = False) -> DataFrame:
    """Rows that still lack their markup, or with ``force`` all rows, of one source or all."""
    rows = releases if source is None else releases.filter(F.col("source") == source)
    return rows if force else rows.filter("body_html IS NULL")


def _gated(own: Column) -> Column:
    """Why a new text is refused, or null: never a shorter one; from the row's own page none
    that loses words, from another page only the very same text."""
    strict = F.when(~gates.same_text("body", "p_body"), "differs")
    return F.when(~gates.not_shorter("body", "p_body"), "shorter").otherwise(F.when(own, F.when(gates.safe_to_write("body", "p_body") == "lost", "lost")).otherwise(strict))


def _upgrade(rows: DataFrame, before: Column, own: Column, key: Column, detail: Column | None = None) -> DataFrame:
    """Outcomes of rows with their parsed page beside them; ``before`` is an outcome that is
    settled already, or null."""
    settled = before.isNotNull()
    empty = _text("p_body_html") == ""
    rows = rows.withColumn("why", F.when(~settled & ~empty, _gated(own)))
    outcome = F.when(settled, before).when(empty, "dead").when(F.col("why").isNotNull(), "skipped").otherwise("upgraded")
    fill = F.when((F.trim(_text("title")) == "") & (F.trim(_text("p_title")) != ""), F.trim(_text("p_title")))
    writes = {"title": fill, "body": F.col("p_body"), "body_html": F.col("p_body_html"), "grade": F.lit("full"), "origin_url": key}
    return _result(rows, outcome, writes | ({"detail_id": detail} if detail is not None else {}), F.col("outcome") == "upgraded", "why")


_PAGE = ("title", "body", "body_html", "html")


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("url").alias("key"), *[F.col(c).alias(f"p_{c}") for c in _PAGE], F.lit(True).alias("p_there"))


def from_cache(releases: DataFrame, origins: DataFrame, pages: DataFrame, source: str | None = None, has_collector: bool = False, force: bool = False) -> DataFrame:
    """Rows with the parsed page that the cache has under their origin; ``pages`` are (url of
    the cache, title, body, body_html, html: whether the bytes are a page at all)."""
    rows = pending(releases, source, force).join(origins.select("url", "origin_url"), "url", "left")
    rows = rows.withColumn("key", address.origin_key()).withColumn("own", F.coalesce(address.own_page(), F.lit(False))).drop("origin_url").join(_pages(pages), "key", "left")
    elsewhere = F.lit(has_collector) & (F.col("key") != "") & ~F.col("own")
    before = F.when(attachment(), "skipped").when(elsewhere, "skipped").when(F.col("p_there").isNull(), "skipped").when(~F.coalesce("p_html", F.lit(False)), "dead")
    return _upgrade(rows, before, F.col("own"), F.col("key"))


def from_listings(releases: DataFrame, entries: DataFrame, source: str | None = None, force: bool = False) -> DataFrame:
    """Rows with the entry that a listing has for them (url, title, body, body_html, origin_url):
    the longest of each; entries that no row waits for are dropped."""
    longest = dedupe.longest(entries.withColumn("ord", F.lit(0)) if "ord" not in entries.columns else entries, ["url"])
    rows = pending(releases, source, force).join(longest.select("url", *[F.col(c).alias(f"p_{c}") for c in ("title", "body", "body_html", "origin_url")]), "url")
    return _upgrade(rows, F.lit(None).cast("string"), F.lit(True), F.col("p_origin_url"))


def from_live(releases: DataFrame, pages: DataFrame, source: str | None = None, force: bool = False, refetch: bool = False, offline: bool = False) -> DataFrame:
    """Rows with the parsed page of their own living address; no origin is recorded. With
    ``refetch`` all rows take part and an unchanged text is skipped; without a page a row is
    uncertain, or skipped where nothing may be fetched (``offline``)."""
    rows = pending(releases, source, force or refetch).withColumn("key", F.col("url")).join(_pages(pages), "key", "left")
    same = F.lit(refetch) & (_text("p_body") == _text("body")) & (_text("p_body_html") != "")
    before = F.when(F.col("p_there").isNull(), "skipped" if offline else "uncertain").when(same, "skipped")
    return _upgrade(rows, before, F.lit(True), F.lit(None).cast("string"))


def retry_missing(releases: DataFrame, pages: DataFrame, captures: DataFrame, source: str | None = None) -> DataFrame:
    """Rows whose reference is a timestamp, with the capture it names (``pages``), else with the
    best of the captures that the index has (as ``best_captures`` gives them), whose
    timestamp then becomes their reference. A longer text is all that is asked for."""
    rows = pending(releases, source).withColumn("key", address.capture_key()).join(_pages(pages), "key", "left")
    rows = rows.join(_side(captures, "c_", "ts", "confirmed", "title", "body", "body_html"), "url", "left")
    own = F.col("p_there") & F.coalesce("p_html", F.lit(False))
    other = ~F.coalesce(own, F.lit(False)) & (_text("c_body") != "")
    for c in ("title", "body", "body_html"):
        rows = rows.withColumn(f"p_{c}", F.when(other, F.col(f"c_{c}")).otherwise(F.col(f"p_{c}")))
    before = (
        F.when(attachment() | (F.col("key") == ""), "skipped").when(own, None).when(other, None)
        .when(F.coalesce("c_confirmed", F.lit(False)), "dead").otherwise("uncertain")
    )
    rows = rows.withColumn("before", before).withColumn("other", other).withColumn("why", F.when(F.col("before").isNull() & ~gates.not_shorter("body", "p_body"), "shorter"))
    outcome = F.coalesce("before", F.when(_text("p_body_html") == "", "dead").when(F.col("why").isNotNull(), "skipped").otherwise("upgraded"))
    fill = F.when((F.trim(_text("title")) == "") & (F.trim(_text("p_title")) != ""), F.trim(_text("p_title")))
    key = F.when(F.col("other"), address.capture_url(F.col("c_ts"), F.col("url"))).otherwise(F.col("key"))
    writes = {"title": fill, "body": F.col("p_body"), "body_html": F.col("p_body_html"), "grade": F.lit("full"), "origin_url": key, "detail_id": F.when(F.col("other"), F.col("c_ts"))}
    return _result(rows, outcome, writes, F.col("outcome") == "upgraded", "why")


def seed_cache(releases: DataFrame, cache: DataFrame, source: str | None = None, force: bool = False) -> DataFrame:
    """(url, capture, outcome): the captures that rows name; 'skipped' if the cache has them,
    else 'wanted', for ``sources.fetch``. Nothing is written to the corpus."""
    rows = pending(releases, source, force).select("url", address.capture_key().alias("capture")).filter((F.col("capture") != "") & ~attachment())
    rows = rows.join(cache.select(F.col("url").alias("capture"), F.lit(True).alias("there")).distinct(), "capture", "left")
    return rows.select("url", "capture", F.when(F.col("there"), "skipped").otherwise("wanted").alias("outcome"))


def twin_fill(releases: DataFrame, key: Column, source: str | None = None) -> DataFrame:
    """Short rows that take the text of their twin, a row of the same source, title and date;
    the reference follows the text if it is a timestamp. Their origins are to be cleared."""
    rows = releases if source is None else releases.filter(F.col("source") == source)
    pairs = dedupe.twins(rows, key).filter("accepted").select("id", "twin_id")
    texts = rows.select(F.col("id").alias("twin_id"), F.col("body").alias("t_body"), F.col("detail_id").alias("t_detail"))
    both = rows.select("id", "url").join(pairs, "id").join(texts, "twin_id")
    writes = {"body": F.col("t_body"), "detail_id": F.when(address.is_timestamp("t_detail"), F.col("t_detail")), "grade": F.lit("full")}
    return _result(both, F.lit("upgraded"), writes, F.lit(True))


def retext(releases: DataFrame, derived: DataFrame, source: str | None = None) -> DataFrame:
    """Rows whose text, derived again from their markup (url, body), is another one. The grade
    stays, as nothing arrives that the row did not hold."""
    rows = (releases if source is None else releases.filter(F.col("source") == source)).filter("body_html IS NOT NULL")
    both = rows.select("url", F.col("body").alias("old")).join(derived.select("url", F.col("body").alias("new")), "url")
    outcome = F.when(_text("old") == _text("new"), "skipped").otherwise("upgraded")
    return _result(both, outcome, {"body": F.col("new")}, F.col("outcome") == "upgraded")


# -- attachments ----------------------------------------------------------------------------


def attachment_score(kind: Column, body: Column) -> Column:
    """What a capture of an attachment is worth: its text's length, nothing if it is no attachment."""
    return F.when(kind.isin("pdf", "doc"), F.length(F.coalesce(body, F.lit("")))).otherwise(0)


def article_score(title: Column, body: Column) -> Column:
    """What a capture of an article is worth: nothing without a title, else its text's length or one."""
    return F.when(F.coalesce(title, F.lit("")) == "", 0).otherwise(F.greatest(F.length(F.coalesce(body, F.lit(""))), F.lit(1)))


def recover_article(first: DataFrame, second: DataFrame) -> DataFrame:
    """Best captures of articles' own addresses, and where those hold no text of their print
    views, both as ``best_captures`` gives them under the article's address. An absence is
    confirmed if both are."""
    a = first.select("url", *[F.col(c).alias(f"a_{c}") for c in first.columns if c != "url"])
    b = second.select("url", *[F.col(c).alias(f"b_{c}") for c in second.columns if c != "url"])
    both = a.join(b, "url", "full")
    use = _text("a_body") != ""
    sure = F.coalesce("a_confirmed", F.lit(False)) & F.coalesce("b_confirmed", F.lit(False))
    confirmed = F.when(use | (_text("b_body") != ""), True).otherwise(sure)
    return both.select("url", *[F.when(use, F.col(f"a_{c}")).otherwise(F.coalesce(f"b_{c}", f"a_{c}")).alias(c) if c != "confirmed" else confirmed.alias(c) for c in first.columns if c != "url"])


def attachment_rows(releases: DataFrame, origins: DataFrame, cache: DataFrame) -> DataFrame:
    """Attachments without markup whose bytes the cache has: (id, url, source, body, origin_url, content, kind)."""
    from corpusloom.sources.pages import kind_of

    rows = releases.filter("body_html IS NULL").filter(attachment()).select("id", "url", "source", "body")
    held = cache.select(F.col("url").alias("origin_url"), "content", kind_of().alias("kind"))
    return rows.join(origins, "url").join(held, "origin_url")


def reextract_attachments(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Attachments with the plain text that the extractor gives of their bytes now (origin_url,
    text): written where nothing but white space differs. The grade stays as it is."""
    both = rows.join(texts, "origin_url", "left")
    outcome = F.when(_text("text") == "", "dead").when((_text("text") == _text("body")) | ~gates.same_text("body", "text"), "skipped").otherwise("upgraded")
    return _result(both, outcome, {"body": F.col("text"), "origin_url": F.col("origin_url")}, F.col("outcome") == "upgraded")


def write_richtext(rows: DataFrame, converted: DataFrame) -> DataFrame:
    """PDF attachments with their structured form (origin_url, text, new_body, new_html): written
    if it holds the same words as the plain text; other kinds are left to the text route."""
    both = rows.join(converted, "origin_url", "left")
    same = gates.same_words(_text("text"), _text("new_body"))
    outcome = F.when(F.col("kind") != "pdf", "skipped").when(_text("new_html") == "", "dead").when(~same, "skipped").otherwise("upgraded")
    why = F.when((F.col("kind") == "pdf") & (_text("new_html") == ""), "empty").when((F.col("kind") == "pdf") & ~same, "words")
    writes = {"body": F.col("new_body"), "body_html": F.col("new_html"), "grade": F.lit("full"), "origin_url": F.col("origin_url")}
    return _result(both.withColumn("why", why), outcome, writes, F.col("outcome") == "upgraded", "why")


def from_mirrors(releases: DataFrame, variants: DataFrame, fetched: DataFrame) -> DataFrame:
    """Rows with the first of their mirrors, in order, whose attachment was had: ``variants`` are
    (url, place, variant), ``fetched`` (url of the variant, text, origin_url, failed). A
    longer text upgrades; no mirror with a text is dead, or uncertain if a fetch failed."""
    seen = variants.join(fetched.select(F.col("url").alias("variant"), "text", F.col("origin_url").alias("found_at"), "failed"), "variant", "left")
    good = F.col("text") != ""
    best = seen.groupBy("url").agg(F.min(F.when(good, F.struct("place", "text", "found_at"))).alias("b"), F.max(F.coalesce("failed", F.lit(True))).alias("failed"))
    rows = pending(releases).join(best, "url")
    outcome = F.when(F.col("b").isNull(), F.when(F.col("failed"), "uncertain").otherwise("dead")).when(F.length("b.text") > F.length(_text("body")), "upgraded").otherwise("skipped")
    return _result(rows, outcome, {"body": F.col("b.text"), "grade": F.lit("full"), "origin_url": F.col("b.found_at")}, F.col("outcome") == "upgraded")


# -- writing ------------------------------------------------------------------------------


def applied(releases: DataFrame, origins: DataFrame, result: DataFrame, source: str | None = None, clear: bool = False) -> tuple[DataFrame, DataFrame]:
    """(releases, origins) with what a strategy writes: new rows get the next ids, in the
    order of a hash of their addresses, stored ones take what isn't null, and origins are recorded, or cleared
    where the text came from another row. Titles and bodies are repaired as they are stored."""
    from corpusloom.functions.decode import repair

    written_ = result.filter(F.col("outcome").isin("added", "upgraded", "teaser", "stub"))
    written_ = written_.withColumn("title", repair("title")["text"]).withColumn("body", F.when(F.col("body_html").isNull(), repair("body")["text"]).otherwise(F.col("body")))
    known = releases.select("url", F.lit(True).alias("known")).distinct()
    rows = written_.join(known, "url", "left")
    columns = [c for c in WRITES if c != "origin_url"]
    kept = merge.coalesce_upgrade(releases, rows.filter("known").select("url", *columns), columns)
    new = rows.filter("known IS NULL").select("url", F.lit(source).alias("source"), *columns)
    ids = merge.insert_releases(releases.select("id", "url"), new.withColumn("ord", F.xxhash64("url")))
    after = kept.unionByName(ids.select(*[F.col(c).cast(releases.schema[c].dataType) for c in releases.columns if c in ids.columns]), allowMissingColumns=True)
    if clear:
        return after, merge.clear_origins(origins, written_.select("url"))
    return after, merge.record_origins(origins, written_.filter("origin_url IS NOT NULL").select("url", "origin_url", F.lit(1).alias("ord")))


def catch_up(releases: DataFrame, origins: DataFrame, key: Column, pages: DataFrame | None = None, entries: DataFrame | None = None, twins: bool = False, live: DataFrame | None = None, captures: DataFrame | None = None, source: str | None = None, force: bool = False, offline: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(releases, origins, outcomes by strategy): the strategies that the inputs allow, cheapest
    first: cached pages, listings, twins, then what was fetched. Each reads what the one
    before has written; a step is cut by written tables, so lost executors cost a step."""
    report = []

    def step(name: str, result: DataFrame, clear: bool = False) -> None:
        nonlocal releases, origins
        result = written(result, f"catch-up-{name}")
        report.append(result.groupBy("outcome").agg(F.count("*").alias("n")).select(F.lit(name).alias("strategy"), "outcome", "n"))
        after, recorded = applied(releases, origins, result, source, clear)
        releases, origins = written(after, "catch-up-releases"), written(recorded, "catch-up-origins")

    if pages is not None:
        step("cache", from_cache(releases, origins, pages, source, entries is not None, force))
    if entries is not None:
        step("listings", from_listings(releases, entries, source, force))
    if twins:
        step("twins", twin_fill(releases, key, source), clear=True)
    if live is not None:
        step("live", from_live(releases, live, source, force, offline=offline))
    if captures is not None and not offline:
        step("missing", retry_missing(releases, pages if pages is not None else live, captures, source))
    empty = releases.sparkSession.createDataFrame([], "strategy string, outcome string, n long")
    return releases, origins, reduce(DataFrame.unionByName, report, empty)


def commit(writer: Writer, releases: DataFrame, origins: DataFrame) -> int:
    """Text, grade and provenance become visible together."""
    return writer.commit({"releases": releases, "body_origin": origins})
