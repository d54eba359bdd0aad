import pytest
from pyspark.sql import functions as F

from corpusloom.functions import layout, parsers
from corpusloom.functions.parsers import Spec
from corpusloom.plans import ingest, pipeline

TEXT = "The new mixer has twelve channels. It ships in spring."
LISTINGS = {
    "heading": f"<html><body><div><h2>One</h2><p>May 3, 2001 {TEXT}</p><h2>Two</h2><a href='/two'>more</a><p>4. Juni 2002 text</p><h2> </h2></div></body></html>",
    "anchor": f"<body><a name='1'></a><b>One</b><p>3.5.2001 {TEXT}<a name='2'></a><b>Two</b><p>2002-06-04 text</body>",
    "rule": f"<body><p>One</p><p>3 May 2001 {TEXT}</p><hr><p>Two</p><p>June 4, 2002 text</p></body>",
    "row": f"<body><table><tr><td>May 3, 2001</td><td><a href='a.htm'>One</a> {TEXT}</td></tr><tr><td>June 4, 2002</td><td><a href='b.htm'>Two</a></td></tr><tr><td></td></tr></table></body>",
}


@pytest.mark.parametrize("split", LISTINGS)
def test_listings_fall_into_entries(split, monkeypatch):
    monkeypatch.setitem(parsers.REGISTRY, "s", (Spec(split=split, dated=True, title=("h2", "b", "a", "p")),))
    found = parsers.entries("s", LISTINGS[split], "http://x.example/list.htm")
    assert [e["date"] for e in found] == ["2001-05-03", "2002-06-04"] and TEXT in found[0]["body"]
    urls = {"heading": ["http://x.example/list.htm", "http://x.example/two"], "anchor": ["http://x.example/list.htm#1", "http://x.example/list.htm#2"], "rule": ["http://x.example/list.htm"] * 2, "row": ["http://x.example/a.htm", "http://x.example/b.htm"]}
    assert [e["url"] for e in found] == urls[split]


def test_whole_pages(monkeypatch):
    page = f"<html><head><title>no</title></head><body><h1>Mixer, May 3, 2001</h1><td width=300>menu</td><td width=600><p>{TEXT}</p>Infos bei: us</td></body></html>"
    monkeypatch.setitem(parsers.REGISTRY, "s", (Spec(("td", (("width", "^9"),))), Spec(("td", (("width", "^6"),)), until="Infos bei", dateline=True)))
    assert parsers.entries("s", page, "u") == [{"url": "u", "title": "Mixer", "date": "2001-05-03", "body": TEXT, "body_html": f"<p>{TEXT}</p>"}]
    assert parsers.entries("unknown", page, "u")[0]["title"] == "Mixer, May 3, 2001"
    assert parsers.entries("s", None, "u") == parsers.entries("s", "", "u") == [] and parsers.entries("s", "<td width=600></td>", "u") == []


def test_dates_in_text():
    assert parsers.date_in("am 3. März 2001 und 2002-01-01") == ("2001-03-03", 3) and parsers.date_in("in May 1999") == ("1999-05", 3)
    assert parsers.date_in("on 45.13.2001") == ("", -1) and parsers.date_in("") == ("", -1)


def test_parsing_within_sql(spark):
    spark.udtf.register("parse", parsers.Parse)
    rows = spark.createDataFrame([("x", f"<article><h1>T</h1><p>{TEXT}</p></article>", "u"), ("x", None, "v")], "source string, page string, url string")
    rows.createOrReplaceTempView("parser_pages")
    got = spark.sql("SELECT p.url AS asked, e.* FROM parser_pages p, LATERAL parse(p.source, p.page, p.url) e").collect()
    assert [(r["asked"], r["title"], r["ord"]) for r in got] == [("u", "T", 0)]
    batch = parsers.parsed(rows.withColumn("key", F.col("url"))).collect()
    assert [(r["key"], r["title"], r["body"]) for r in batch] == [("u", "T", f"T\n\n{TEXT}")]


def test_verdicts_of_recorded_bodies(spark):
    at = "https://web.archive.example/web/20010101000000id_/"
    body = f"T\n\n{TEXT}"
    releases = spark.createDataFrame([(1, "u1", "s", None, body), (2, "u2", "s", None, body.replace(" ", "  ")), (3, "u3", "s", None, "twelve channels"), (4, "u4", "s", None, body + " And more."), (5, "u5", "s", None, "other"), (6, "u6", "s", None, body), (7, "u7", "s", None, None), (8, "u8", "s", None, body)], "id long, url string, source string, detail_id string, body string")
    origins = spark.createDataFrame([(f"u{i}", at + ("p" if i < 8 and i != 6 else "none" if i == 6 else "f")) for i in range(1, 9)], "url string, origin_url string")
    cache = spark.createDataFrame([(at + "p", f"<html><article><h1>T</h1><p>{TEXT}</p></article>".encode()), (at + "f", b"%PDF-1.4")], "url string, content binary")
    got = {r["id"]: r["verdict"] for r in pipeline.verify_origins(releases, origins, cache).collect()}
    assert got == {1: "exact", 2: "typography", 3: "inside", 4: "holds", 5: "mismatch", 6: "no_bytes", 7: "mismatch", 8: "not_html"}


# attachments

ROWS = "id long, url string, source string, body string, origin_url string, content binary, kind string"


def test_attachments_are_rewritten_behind_their_gates(spark):
    rows = spark.createDataFrame([(i, f"u{i}.pdf", "s", b, f"o{i}", b"", k) for i, b, k in ((1, "one two", "pdf"), (2, "one two", "pdf"), (3, "one", "doc"), (4, None, "pdf"))], ROWS)
    texts = spark.createDataFrame([("o1", "one\ntwo"), ("o2", "one three"), ("o3", "one")], "origin_url string, text string")
    assert {r["url"]: (r["outcome"], r["grade"]) for r in ingest.reextract_attachments(rows, texts).collect()} == {"u1.pdf": ("upgraded", None), "u2.pdf": ("skipped", None), "u3.pdf": ("skipped", None), "u4.pdf": ("dead", None)}
    forms = spark.createDataFrame([("o1", "one two", "one two", "<p>one two</p>"), ("o2", "one two", "one", "<p>one</p>")], "origin_url string, text string, new_body string, new_html string")
    assert {r["url"]: (r["outcome"], r["why"]) for r in ingest.write_richtext(rows, forms).collect()} == {"u1.pdf": ("upgraded", None), "u2.pdf": ("skipped", "words"), "u3.pdf": ("skipped", None), "u4.pdf": ("dead", "empty")}


def test_mirrors_are_tried_in_order(spark):
    releases = spark.createDataFrame([(1, "a", "old", None), (2, "b", "a long old text", None), (3, "c", "", None), (4, "d", "", None)], "id long, url string, body string, body_html string")
    variants = spark.createDataFrame([(u, k, f"{u}{k}") for u in "abcd" for k in (0, 1)], "url string, place int, variant string")
    fetched = spark.createDataFrame([("a0", "", None, False), ("a1", "a new text", "o1", False), ("b0", "short", "o2", False), ("b1", "x", None, False), ("c0", "", None, False), ("c1", "", None, True), ("d0", "", None, False), ("d1", None, None, False)], "url string, text string, origin_url string, failed boolean")
    got = {r["url"]: (r["outcome"], r["body"]) for r in ingest.from_mirrors(releases, variants, fetched).collect()}
    assert got == {"a": ("upgraded", "a new text"), "b": ("skipped", None), "c": ("uncertain", None), "d": ("dead", None)}


def test_articles_are_recovered_from_print_views(spark):
    columns = "url string, ts string, confirmed boolean, title string, date string, body string, body_html string"
    a = spark.createDataFrame([("u", "1", True, "T", "", "text", None), ("v", None, True, None, None, None, None), ("w", None, False, None, None, None, None)], columns)
    b = spark.createDataFrame([("u", "2", True, "P", "", "print", None), ("v", "3", True, "P", "", "print", None), ("w", None, True, None, None, None, None)], columns)
    got = {r["url"]: (r["ts"], r["body"], r["confirmed"]) for r in ingest.recover_article(a, b).collect()}
    assert got == {"u": ("1", "text", True), "v": ("3", "print", True), "w": (None, None, False)}


WORD = '<word xMin="{}" yMin="{}" xMax="{}" yMax="{}">{}</word>'


def page(*words):
    return '<page width="600" height="800">' + "".join(WORD.format(*w) for w in words) + "</page>"


def test_layouts_leave_out_margins_and_turned_words_and_nest_lists(spark):
    words = [(50, 10, 200, 20, "Running"), (50, 100, 200, 140, "Headline"), (580, 200, 590, 420, "turned"), (50, 300, 90, 310, "plain")]
    words += [(50, 330, 54, 340, "•"), (60, 330, 90, 340, "one"), (80, 345, 84, 355, "•"), (90, 345, 120, 355, "inner"), (50, 360, 54, 370, "•"), (60, 360, 90, 370, "two")]
    xml = "<doc>" + page(*words) + page((50, 10, 200, 20, "Running"), (50, 300, 90, 310, "more")) + "</doc>"
    markup = layout.to_markup(xml)
    assert markup == "<h3>Headline</h3>\n<p>plain</p>\n<ul><li>one<ul><li>inner</li></ul></li><li>two</li></ul>\n<p>more</p>"
    df = spark.createDataFrame([(xml,), (None,), ("<broken",)], "xml string")
    assert [tuple(r[0]) if r[0] else None for r in df.select(layout.converted("xml")).collect()] == [("Headline\n\nplain\n\n• one\n\n• inner\n\n• two\n\nmore", markup, "turned"), (None, None, None), ("", "", "")]
