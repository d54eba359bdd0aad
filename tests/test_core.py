import re
import sqlite3

import pytest
from pyspark.sql import functions as F
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.functions import containers, decode, layout, quality, richtext
from corpusloom.functions import text as text_functions
from corpusloom.operators import corpus, dedupe, fts, gates, merge, search
from corpusloom.plans import ingest
from corpusloom.registry import QUERIES, SQL
from corpusloom.sources import fetch, pages, versions
from corpusloom.sources.versions import Reader, Writer


def test_every_query_runs_on_empty_tables(spark, tables):
    d = tables()
    for name, query in QUERIES.items():
        query(spark, d).collect()


def test_every_query_runs_with_nulls_and_clashing_columns(spark, tables):
    blank = [{"id": i} for i in (1, 2, 2)]
    d = tables(clash=True, releases=[*blank, {"id": 3, "title": "t", "body": "x " * 50_000, "source": "s", "url": "u", "date": ""}], page_cache=[{"url": None}, {"url": "u", "content": b""}], body_origin=[{"url": "u", "origin_url": None}], wayback_calls=[{"id": 1}, {"id": 1}], terratec_early__listing_1=[{}, {}], source_tags=[{"source": "s"}])
    for name, query in QUERIES.items():
        query(spark, d).collect()


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


# full text against a second engine

TEXTS = ["the noise gate opens", "a gate for noise, the gate", "Zürich: garantía de por vida", "noise", "gate gate gate noise", "nymo nyro other words here", "the the the", "X-Audio ships"]
EXPRESSIONS = ["gate", "noise gate", '"noise gate"', "noise AND gate", "noise OR garantia", "gate NOT opens", "ny*", "zurich", "body:gate", "the NOT noise", "(noise OR words) AND gate", "^noise", "noise + gate", "NEAR(noise gate, 1)", "{title body}: gate", "X-Audio", "a AND", '"', "-a", "gate AND noise NOT opens", "title:gate"]


@pytest.fixture(scope="module")
def engines(spark):
    other = sqlite3.connect(":memory:")
    other.execute("CREATE VIRTUAL TABLE f USING fts5(title, body)")
    rows = [(i + 1, t.split()[0], t) for i, t in enumerate(TEXTS)]
    other.executemany("INSERT INTO f(rowid, title, body) VALUES (?, ?, ?)", rows)
    mine = spark.createDataFrame(rows, "id long, title string, body string")
    return other, mine, fts.index_of(mine)


@pytest.mark.parametrize("expression", EXPRESSIONS)
def test_search_agrees_with_another_engine(engines, expression):
    other, _, index = engines
    tree, mode = fts.read(expression)
    try:
        expected = dict(other.execute("SELECT rowid, bm25(f) FROM f WHERE f MATCH ?", (expression,)).fetchall())
        assert mode == "raw"
    except sqlite3.OperationalError:
        assert mode == "literal"
        literal = '"' + expression.replace('"', '""') + '"'
        expected = dict(other.execute("SELECT rowid, bm25(f) FROM f WHERE f MATCH ?", (literal,)).fetchall())
    if not any(p.terms for p in fts.phrases(tree)):
        return
    got = {r["id"]: r["score"] for r in fts.bm25(index, tree).collect()}
    assert got.keys() == expected.keys()
    if "NEAR" not in expression and ":" not in expression and "^" not in expression:
        assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_snippets_mark_the_hits(engines):
    tree, _ = fts.read("noise gate")
    text = "word " * 50 + "the noise and the gate " + "word " * 50
    got = fts.snippet_of(text, tree)
    assert ">>>noise<<<" in got and ">>>gate<<<" in got and len(got.split()) <= fts.SNIPPET + 2
    assert fts.snippet_of(None, tree) == ""


# windows and merges

ROWS = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["", "2001-01-01", "2002"]), st.text("xyz ", max_size=8)), max_size=25)


def test_neighbours_link_all_rows_of_a_source(spark):
    rows = [(i, "ab"[i % 3 == 0], ["", "2001", "2002"][i % 5 % 3], None) for i in range(60)]
    got = {r["id"]: (r["prev_id"], r["next_id"]) for r in corpus.neighbours(spark.createDataFrame(rows, "id long, source string, date string, url string")).collect()}
    assert len(got) == 60
    for s in "ab":
        line = [r[0] for r in sorted((r for r in rows if r[1] == s), key=lambda r: (r[2], r[0]))]
        for before, here, after in zip([None, *line], line, [*line[1:], None]):
            assert got[here] == (before, after)


def test_dedupe_keeps_first_on_ties(spark):
    rows = spark.createDataFrame([("k", 1, "aa"), ("k", 2, "bb"), ("k", 3, "c"), (None, 4, None)], "key string, ord long, body string")
    assert sorted((r["key"] or "", r["ord"]) for r in dedupe.longest(rows, ["key"]).collect()) == [("", 4), ("k", 1)]
    assert [r["ord"] for r in dedupe.last(rows.filter("key = 'k'"), ["key"]).collect()] == [3]


def test_best_capture_samples(spark):
    caps = [("p", "20010101000000", 0), ("p", "20020101000000", 5), ("p", "20020601000000", 50), ("p", "20030101000000", 5), ("p", "20050101000000", 5), ("q", "20010101000000", None), ("r", "20010101000000", 3)]
    got = {r["page"]: r for r in dedupe.best_capture(spark.createDataFrame(caps, "page string, ts string, score long")).collect()}
    assert got["p"]["ts"] == "20020101000000"  # equal scores: the earlier of the samples; 50 was never sampled
    assert got["q"]["ts"] is None and got["q"]["earliest"] == "20010101000000" and not got["q"]["complete"]
    assert got["r"]["ts"] == "20010101000000"


def test_insert_or_ignore_numbers_in_order_of_arrival(spark):
    stored = spark.createDataFrame([(7, "a")], "id long, url string")
    incoming = spark.createDataFrame([("a", 1), ("b", 5), ("c", 2), ("b", 3)], "url string, ord long")
    assert {r["url"]: r["id"] for r in merge.insert_or_ignore(stored, incoming).collect()} == {"c": 8, "b": 9}


def test_upgrade_keeps_on_null_and_takes_empty(spark):
    stored = spark.createDataFrame([("a", "old", "t"), ("b", "old", "t")], "url string, body string, title string")
    new = spark.createDataFrame([("a", "", None), ("z", "x", "x")], "url string, body string, title string")
    assert sorted(map(tuple, merge.coalesce_upgrade(stored, new, ["body", "title"]).collect())) == [("a", "", "t"), ("b", "old", "t")]


def test_origins_must_be_captures(spark):
    stored = spark.createDataFrame([("a", "https://web.archive.example/web/20010101000000id_/http://x/")], "url string, origin_url string")
    good = stored.selectExpr("'b' AS url", "origin_url", "1 AS ord")
    assert merge.record_origins(stored, good).count() == 2
    with pytest.raises(Exception, match="no capture address"):
        merge.record_origins(stored, stored.selectExpr("'b' AS url", "'http://x/' AS origin_url", "1 AS ord")).collect()


def test_versions_show_whole_commits(spark, tmp_path):
    writer = Writer(spark, f"file://{tmp_path}/v")
    one = spark.createDataFrame([(1,)], "id long")
    assert writer.version() is None
    writer.commit({"t": one, "u": one})
    with pytest.raises(Exception):
        writer.commit({"t": one.union(one), "u": one.selectExpr("raise_error('no') AS id")})
    reader = Reader(spark, f"file://{tmp_path}/v")
    assert reader.version() == 1 and reader.table("t").count() == 1 and not hasattr(reader, "commit")
    writer.commit({"t": one.union(one), "u": one})
    assert reader.table("t").count() == 2


def test_appends_write_new_rows_alone(spark, tmp_path, monkeypatch):
    one = lambda i: spark.createDataFrame([(i,)], "id long")
    writer = versions.init_schema(spark, f"file://{tmp_path}/v")
    assert versions.init_schema(spark, f"file://{tmp_path}/v").version() == 1 and writer.table("releases").count() == 0 and writer.table("page_cache").columns[0] == "url"
    writer.commit({"t": one(1)})
    for i in (2, 3):
        writer.commit({"t": one(i)}, append=True)
    assert sorted(r["id"] for r in writer.table("t").collect()) == [1, 2, 3] and len(writer._state()["parts"]["t"]) == 3
    monkeypatch.setattr(versions, "MOST_PARTS", 3)
    writer.commit({"t": one(4)}, append=True)
    assert sorted(r["id"] for r in writer.table("t").collect()) == [1, 2, 3, 4] and len(writer._state()["parts"]["t"]) == 1
    assert writer.table("releases").count() == 0


def test_stores_keep_an_address_once(spark):
    cache = spark.createDataFrame([("a", b"old", 1.0, "x")], "url string, content binary, fetched_at double, content_sha256 string")
    new = spark.createDataFrame([("a", b"n1", 2.0), ("b", b"b1", 3.0), ("b", b"b2", 4.0)], "url string, content binary, fetched_at double")
    kept = lambda df: sorted((r["url"], bytes(r["content"])) for r in df.collect())
    assert kept(pages.store(cache, new)) == [("a", b"old"), ("b", b"b1")]
    assert kept(pages.store(cache, new, replace=True)) == [("a", b"n1"), ("b", b"b2")]


def fake_fetcher(url, timeout):
    """For ``sources.fetch``: by the address's last letter."""
    if url.endswith("t"):
        raise TimeoutError
    if url.endswith("c"):
        raise ConnectionError
    return b"<p>" + url.encode(), "text/html; charset=UTF-8", {"r": 503}.get(url[-1], 200)


def test_fetching_through_the_cache(spark, tmp_path):
    cache = spark.createDataFrame([("http://x/a", b"cached", "text/html")], "url string, content binary, id_content_type string")
    urls = spark.createDataFrame([(f"http://{h}/{x}",) for h, x in (("x", "a"), ("x", "b"), ("www.x", "t"), ("y", "c"), ("y", "r"), ("y", "r"))], "url string")
    there, new = fetch.fetch_cached(cache, urls, "tests.test_core:fake_fetcher", pause=0.0, backoff=0.0, cooldown=0.01)
    new = new.cache()
    assert sorted((r["url"], bytes(r["content"])) for r in there.collect()) == [("http://x/a", b"cached"), ("http://x/b", b"<p>http://x/b")]
    assert {r["url"]: (r["outcome"], len(r["calls"])) for r in new.collect()} == {"http://x/b": ("ok", 1), "http://www.x/t": ("timeout", 3), "http://y/c": ("connection_error", 3), "http://y/r": ("503", 3)}
    assert fetch.append_calls(fetch.call_rows(new), f"{tmp_path}/calls") and spark.read.parquet(f"{tmp_path}/calls").count() == 10
    assert not fetch.append_calls(fetch.call_rows(new), "odd-scheme://nowhere/at/all")
    assert [(r["fw_guessed_charset"], len(r["content_sha256"])) for r in fetch.cache_rows(new).collect()] == [("utf-8", 64)]


PAGE_OF = '<html><body><table width="600"><tr><td class="nav">Menu</td><td width="400"><p>{}</p><b>Infos bei:</b> us</td></tr></table></body></html>'


def test_containers_and_cuts():
    body = "The article goes on for quite some length here. " * 5
    shape, path, coverage = containers.located(PAGE_OF.format(body), body)
    assert (shape, path) == ("p", 'td[width="400"] < tr < table[width="600"]') and 0.9 < coverage <= 1.1
    assert containers.located(PAGE_OF.format("other"), body) is None and containers.located(None, body) is None and containers.located("<p>x", "short") is None
    root = containers.tree(PAGE_OF.format(body))
    assert containers.shape(containers.densest(root, "td")) == 'td[width="400"]' and containers.densest(root, "ul") is None
    assert containers.shape(containers.densest(root, "td", {"class": "^n"})) == 'td[class="nav"]'
    assert containers.cut_from(root, re.compile("Infos bei:")) and "us" not in containers.words_in(root).split() and not containers.cut_from(root, re.compile("nowhere"))


def test_conversion_measures(spark):
    markup = "<p>Press</p><h3>Head</h3><p>one two - three</p><p>Press</p>"
    assert quality.first_heading(markup) == 1 and quality.furniture(markup) == 1 and len(quality.top_blocks(markup)) == 4
    assert quality.artefacts("the gate the gate cost 129.99.x and mixerDesk") == (1, 1, 1) and quality.retention("a b c d", "a b c") == 0.75
    rows = spark.createDataFrame([("a b c d", markup, "a b c"), ("x\n" * 12, "<p>x</p>", "x " * 12), ("a b", "<p>a b</p><p>c</p>", "a b"), (None, None, None)], "text string, body_html string, body string")
    measured = rows.withColumn("m", quality.measure("text", "body_html", "body"))
    assert [r[0] for r in measured.select(quality.verdict(F.col("m"))).collect()] == ["refused", "degenerate", "passed", "refused"]
    assert quality.defect_counts(measured).first()["no_heading"] == 3 and quality.defect_counts(measured.limit(0)).first()["furniture"] == 0
    cards = quality.review_cards(measured.select(F.lit("n<").alias("name"), F.lit("v").alias("verdict"), "m.retention", "text", "body", "body_html"))
    assert all("n&lt;" in r[0] and "\n" not in r[0] for r in cards.collect())


def test_names_with_a_month(spark):
    names = [("news_0304", "2003-04"), ("roundup-2003-04.htm", "2003-04"), ("april2003", "2003-04"), ("x9912", "1999-12"), ("none", ""), (None, "")]
    df = spark.createDataFrame(names, "n string, want string")
    assert all(r["got"] == r["want"] for r in df.select(text_functions.month_range_date(F.coalesce("n", F.lit(""))).alias("got"), "want").collect())


def test_cursors():
    assert corpus.parse_cursor("d:2001-01-01:5") == ("d", ("2001-01-01", 5)) and corpus.parse_cursor("o:20") == ("o", 20) and corpus.parse_cursor("") is None
    with pytest.raises(ValueError):
        corpus.parse_cursor("x:1")
    rows = [{"date": "2", "id": i} for i in range(3)]
    assert corpus.next_cursor(rows, 2) == (rows[:2], "d:2:1") and corpus.next_cursor(rows, 5) == (rows, None)


def test_index_segments(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(x, "id long, title string, body string")
    path = f"file://{tmp_path}/fts"
    fts.write_index(rows((1, "a", "noise gate"), (2, None, "noise"), (3, "b", None)), path)
    fts.update_index(spark, path, rows((2, "c", "gate now"), (4, "d", "noise")), rows((1, None, None)))
    fts.update_index(spark, path, rows((4, "d", "gate gate")))
    index = fts.open_index(spark, path)
    found = lambda i, q: sorted(r["id"] for r in fts.matches(i.postings, fts.read(q)[0]).collect())
    assert found(index, "noise") == [] and found(index, "gate") == [2, 4] and found(index, "b") == [3]
    assert sorted(map(tuple, index.sizes.collect())) == [(2, 3), (3, 1), (4, 3)] and index.totals.first()["n"] == 3
    fts.compacted(spark, path, f"{path}-2")
    again = fts.open_index(spark, f"{path}-2")
    assert found(again, "gate") == [2, 4] and sorted(map(tuple, fts.bm25(again, fts.read("gate")[0]).collect())) == sorted(map(tuple, fts.bm25(index, fts.read("gate")[0]).collect()))


# search

COMPANIES = {"one": ["a", "b"], "two": ["c"]}


@pytest.mark.parametrize("params", [{"flags": "odd"}, {"company": "three"}, {"order": "size"}, {"after": "x:1"}, {"limit": "many"}])
def test_parameters_that_cannot_be_meant(params):
    with pytest.raises(search.BadRequest):
        search.checked(params, COMPANIES)


def test_sources_and_companies_intersect():
    assert search.checked({"source": "a,c", "company": "one"}, COMPANIES).sources == ["a"]
    assert search.checked({"source": "c", "company": "one"}, COMPANIES).empty
    assert search.checked({"company": ["one", "two"]}, COMPANIES).sources == ["a", "b", "c"]
    assert search.checked({"limit": "999", "after": "o:40"}, {}).limit == corpus.PAGE_MOST


def test_pages_of_a_search(spark, monkeypatch):
    monkeypatch.setattr(fts, "DEEPEST", 4)
    rows = spark.createDataFrame([(i, "ab"[i % 2], None, f"t{i}", f"200{i}", f"u{i}", "noise " * i, None, "full") for i in range(1, 8)], "id long, source string, detail_id string, title string, date string, url string, body string, body_html string, grade string")
    origins, index = spark.createDataFrame([], "url string, origin_url string"), fts.index_of(rows)
    first = search.page(rows, origins, index, search.checked({"q": "noise", "limit": "2", "order": "date"}, {}))
    assert [r["id"] for r in first["results"]] == [7, 6] and first["next"] == "o:2" and not first["truncated"]
    last = search.page(rows, origins, index, search.checked({"q": "noise", "limit": "2", "order": "date", "after": "o:2"}, {}))
    assert last["next"] is None and last["truncated"] and "noise" in last["results"][0]["excerpt"]
    browsed = search.page(rows, origins, None, search.checked({"limit": "3"}, {}))
    assert browsed["next"] == "d:2005:5" and browsed["query_mode"] is None and len(search.as_lines(browsed, full=True)) == 6
    onward = search.page(rows, origins, None, search.checked({"limit": "9", "after": browsed["next"]}, {}))
    assert [r["id"] for r in onward["results"]] == [4, 3, 2, 1] and onward["next"] is None and '"t4"' in search.as_json(onward)
    assert search.page(rows, origins, index, search.Request(empty=True))["results"] == []


# flows

ROWS = "id long, source string, detail_id string, title string, date string, url string, body string, body_html string, grade string"
PAGE = "url string, title string, body string, body_html string, html boolean"


def test_catch_up_writes_text_grade_and_origin_together(spark, tmp_path):
    at = "https://web.archive.example/web/20010101000000id_/"
    rows = spark.createDataFrame([(1, "s", "20010101000000", "", "2001", "http://x/a", "old", None, "teaser"), (2, "s", None, "T", "2001", "http://x/b", "same text", None, "teaser"), (3, "s", None, "T", "2002", "http://x/c", "x" * 20, None, "stub"), (4, "s", "20030303000000", "t ", "2002", "http://x/d", "long " * 100, "<p>", "full"), (5, "s", None, "T", "2002", "http://x/e.PDF?q", "", None, "full")], ROWS)
    origins = spark.createDataFrame([("http://x/b", at + "http://x/list"), ("http://x/c", at + "http://x/list")], "url string, origin_url string")
    pages = spark.createDataFrame([(at + "http://x/a", " New ", "old and new", "<p>old and new</p>", True), (at + "http://x/list", "", "other text", "<p>other text</p>", True)], PAGE)
    key = F.lower("title")
    after, recorded, report = ingest.catch_up(rows, origins, F.trim(key), pages=pages, twins=True)
    got = {r["id"]: r for r in after.collect()}
    assert (got[1]["body"], got[1]["title"], got[1]["grade"], got[1]["body_html"]) == ("old and new", "New", "full", "<p>old and new</p>")
    assert got[2]["body"] == "same text" and got[2]["grade"] == "teaser"  # another page's text differs
    assert got[3]["body"] == "long " * 100 and got[3]["detail_id"] == "20030303000000"  # its twin's
    assert dict(map(tuple, recorded.collect())) == {"http://x/a": at + "http://x/a", "http://x/b": at + "http://x/list"}
    assert {tuple(r) for r in report.collect()} == {("cache", "upgraded", 1), ("cache", "skipped", 3), ("twins", "upgraded", 2)}
    writer = Writer(spark, f"file://{tmp_path}/v")
    ingest.commit(writer, after, recorded)
    assert Reader(spark, f"file://{tmp_path}/v").table("releases").count() == 5
    again = ingest.catch_up(after, recorded, F.trim(key), twins=True)[2]
    assert again.count() == 0  # nothing is left to fill


def test_found_items_are_stored_once_with_new_ids(spark):
    rows = spark.createDataFrame([(7, "s", None, "T", "2001", "http://x/a", "b", None, "full")], ROWS)
    none = spark.createDataFrame([], "url string, origin_url string")
    items = spark.createDataFrame([("http://x/a", "t", "", None, 1), ("http://x/n", "FÃ¼r", "", None, 2), ("http://x/n", "later", "", None, 3), ("http://x/m", "t", "", None, 4)], "url string, title string, date string, detail_id string, ord int")
    result = ingest.from_items(rows, items, spark.createDataFrame([("http://x/n", "text", None)], "url string, body string, body_html string"))
    assert {r["url"]: r["outcome"] for r in result.collect()} == {"http://x/a": "skipped", "http://x/n": "added", "http://x/m": "uncertain"}
    after = ingest.applied(rows, none, result, "s")[0]
    assert {(r["id"], r["title"], r["grade"]) for r in after.collect()} == {(7, "T", "full"), (8, "Für", "full")}


# texts

def test_decoding_mixes():
    assert decode.decode_mixed("é".encode() + b"\xe9 \x81") == "éé �" and decode.decode_mixed(None) is None


@given(st.text("aöüßéłñ –“”", max_size=40), st.sampled_from(["cp1252", "latin-1"]))
def test_repair_is_idempotent(text, charset):
    once = decode.repaired(text.encode().decode(charset, "replace"))[0]
    assert decode.repaired(once)[0] == once
    assert decode.repaired(text)[0] == text


MARKUP = [
    ("<div>one<br><br>two <b>bold</b></div>", "one\n\ntwo bold"),
    ("<p>a<p>b<ul><li>x<li>y</ul>", "a\n\nb\n\n• x\n• y"),
    ("<script>no</script><!-- no --><p>yes</p>", "yes"),
    ("<ol><li>x</li><li>y</li></ol>", "1. x\n2. y"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\tb\nc"),
    ("", ""),
    ("<p> </p><p><br></p>", ""),
    ("<table><tr><td><h1>t</h1>x</td></tr></table><hr>y", "t\n\nx\n\ny"),
    ("<html><head><title>no</title></head><body><font>a</font><form>no</form>b</body>", "ab"),
    ("<table><tbody><tr><th>a<td>b<tr><td><img src=x>", "a\tb"),
]


@pytest.mark.parametrize(("source", "text"), MARKUP)
def test_text_follows_from_markup(source, text):
    markup = richtext.clean(source)
    assert richtext.to_text(markup) == text
    assert richtext.clean(markup) == markup


@given(st.text("<>/pbrlidv &;'\"=\nx", max_size=60))
def test_cleaning_never_fails_and_settles(source):
    once = richtext.clean(source)
    assert richtext.to_text(richtext.clean(once)) == richtext.to_text(once)


def test_unsafe_addresses_go():
    assert richtext.clean('<a href="java\nscript:x">t</a><a href="/y" onclick="z">u</a>') == '<p>t<a href="/y">u</a></p>'


def test_layout_joins_words_lines_and_lists():
    word = '<word xMin="{}" yMin="{}" xMax="{}" yMax="{}">{}</word>'
    xml = "<doc><page>" + word.format(10, 10, 90, 40, "Head") + word.format(10, 60, 30, 70, "one") + word.format(35, 61, 50, 71, "two") + word.format(10, 73, 40, 83, "three") + word.format(10, 110, 14, 120, "•") + word.format(20, 110, 50, 120, "item") + "</page></doc>"
    assert layout.to_markup(xml) == "<h3>Head</h3>\n<p>one two three</p>\n<ul><li>item</li></ul>"
    assert layout.to_markup("<doc/>") == ""


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_subsequence_laws(a, b):
    assert gates.subsequence(a, a + b) and gates.subsequence(b, a + b)
    assert gates.subsequence("", a)
    if len(a) > len(b):
        assert not gates.subsequence(a, b)


def test_gates(spark):
    rows = [("x" * 500 + " end", "x" * 500), ("short", "a much longer text than before"), ("one two " * 100, "three four " * 100), ("ab " * 200, "ab " * 200 + "c"), (None, None)]
    df = spark.createDataFrame(rows, "old string, new string")
    assert [r[0] for r in df.select(gates.safe_to_write("old", "new")).collect()] == ["edges", "grown", "lost", "kept", "edges"]
    assert gates.same_characters("a b c", "• a\n• b c1") and not gates.same_characters("a b", "a x")
