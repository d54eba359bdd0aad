import re
import unicodedata
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import boilerplate, charset, language, leaks, neardup, residue, sentences, survivor, tokens
from corpusloom.llm.registry import QUERIES, SQL

ARTICLE = "The new mixer has twelve channels and a large display. It will ship in spring, and every owner of the old model can upgrade free of charge. "


def test_every_query_runs_on_empty_tables(spark, tables):
    d = tables()
    for query in QUERIES.values():
        assert query(spark, d).count() == 0


def test_every_query_runs_with_edge_rows(spark, tables):
    long = ARTICLE * 3000
    releases = [{"id": 1}, {"id": 2, "body": ""}, {"id": 3, "body": " \n"}, {"id": 4, "body": long, "title": None, "url": "http://x/a", "grade": "full"}, {"id": 5, "body": long, "url": "https://WWW.x:443/a", "grade": "odd"}, {"id": 6, "url": "no address", "body": "\x00\x01", "date": ""}]
    pages = [{"url": None, "content": b"<p>x"}, {"url": "a"}, {"url": "b", "content": b""}, {"url": "c", "content": b"%PDF-1.4"}, {"url": "d", "content": b"<!DOCTYPE html><p>\xff\xfe", "fw_guessed_charset": "no-such"}, {"url": "e", "content": (b"<div>" * 3000) + b"text\n" * 9, "fw_guessed_charset": "utf-8"}, {"url": "f", "content": b"<![CDATA[<!x", "id_content_type": "text/html"}]
    documents = [{"doc_id": 1}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": " \r\n "}, {"doc_id": 4, "text": long, "lang": "en"}, {"doc_id": 5, "text": long, "lang": "en"}]
    d = tables(clash=True, releases=releases, page_cache=pages, documents=documents, eval_items=[{"item_id": 1}, {"item_id": 2, "text": ""}, {"item_id": 3, "text": ARTICLE, "lang": "en"}], source_tags=[{"source": None}])
    got = {name: [tuple(r) for r in query(spark, d).collect()] for name, query in QUERIES.items()}
    assert got["p3_found"] == [(4, 4, 0)]
    assert got["p7_found"] == [(4, 5)]
    assert sorted(got["p9_found"]) == [(4, 3), (5, 3)]
    ids = dict(got["p8_ids"])
    assert ids[1] == ids[2] == [] and ids[4] == ids[5] and len(ids[4]) > 10_000
    assert {k for k, *_ in got["p10_found"]} == {4, 5}


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


# 1


@pytest.mark.parametrize("text", ["Price: {{price}} only", "for ${amount} each", "<<name>> said", "by __AUTHOR__", "on XX.XX.XXXX", "[Insert quote of managing director]", "<?php echo $city; ?>", "the %(unit)s model", "%%TITLE%%"])
def test_placeholders_in_use(text):
    assert residue.placeholder(text)


@pytest.mark.parametrize("text", ["a pattern such as {{bank}} loads it", "lädt ein Muster wie {{bank}} die Nummer", "costs $12 {or less}", "see [1] and [DE]"])
def test_talk_about_placeholders_is_none(text):
    assert not residue.placeholder(text)


@pytest.mark.parametrize("text", ["HTTP 502 - Internal server error. Try later.", "Fehler 404: Die angeforderte Seite fehlt", "Lorem ipsum dolor sit amet quis", "Augue porta feugiat tempus magna sodales", "Headline goes here", "ERR_CONNECTION_118: x refused"])
def test_trusted_residue(text):
    assert residue.trusted(text) and residue.trusted(text.upper())


@pytest.mark.parametrize("text", ["The limited edition is called Error 404 and was not found in any shop.", "JavaScript must be enabled only for the web panel of the mixer, not for the gate.", "The access point ships today.", ARTICLE])
def test_sentences_are_no_residue(text):
    assert not residue.trusted(text)


@given(st.text("aB 1/.\"'(){[Xéüorem ipsumdl\u0661", max_size=40))
def test_passages_are_judged_alike_in_one_go(text):
    assert residue.judged(text) == (residue.trusted(text), residue.placeholder(text), residue.masked(text))


def test_filler_after_a_real_lead(spark, tables):
    lead = "Our new mixer with twelve channels ships in spring for owners of older models"
    latin = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore. " * 7
    assert residue.trusted(f"{lead} {latin}") and not residue.trusted(f"{lead} {lead} {lead} {latin}")
    d = tables(releases=[{"id": 1, "body": f"{lead} {latin}"}, {"id": 2, "body": ARTICLE}])
    assert [r["rec_key"] for r in residue.p1_found(spark, d).collect()] == ["1"]


def test_labels_spread_along_similar_passages(spark, tables):
    seed = "Service temporarily unavailable: the server is down for planned work today and will be back again after the night shift ends in the morning hours of the next day"
    near = seed.replace("Service temporarily", "Our service is temporarily")
    assert residue.trusted(seed) and not residue.trusted(near) and residue.similar(residue.masked(seed), residue.masked(near))
    d = tables(releases=[{"id": 1, "body": seed}, {"id": 2, "body": near}, {"id": 3, "body": ARTICLE}])
    assert {r["rec_key"] for r in residue.p1_found(spark, d).collect()} == {"1", "2"}


def test_labels_come_from_pages_and_spread_alone_finds_the_rest(spark, tables, monkeypatch):
    """A bare page and a noscript notice are trusted; no rule knows their words."""
    notice, wait = "Включите JavaScript, чтобы увидеть эту страницу.", "One moment, we are looking at your browser before opening {}.example. Ray {}"
    page = lambda body, head="<title>T</title>": f"<html><head>{head}</head><body>{body}</body></html>".encode()
    pages = [
        {"url": "bare", "content": page(f"<h1>{wait.format('abc', '8334a151')}</h1>", "<title>One moment, we are looking</title>"), "id_content_type": "text/html"},
        {"url": "beside", "content": page(f"<noscript>{notice}</noscript><p>{ARTICLE}</p>"), "id_content_type": "text/html"},
        {"url": "shown", "content": page(f"<div><p>{notice}</p></div>"), "id_content_type": "text/html"},
    ]
    releases = [{"id": 1, "body": wait.format("xyz", "ff01a2b3") + " (1a2b3c4d)"}, {"id": 2, "body": ARTICLE}, {"id": 3, "body": notice}]
    assert not any(residue.trusted(x) for x in (notice, wait))
    d = tables(page_cache=pages, releases=releases)
    assert {tuple(r) for r in residue.p1_reasons(spark, d).collect()} == {("page_cache", "bare", "trusted"), ("page_cache", "shown", "spread"), ("releases", "1", "spread"), ("releases", "3", "spread")}
    monkeypatch.setattr(residue, "spread_labels", lambda passage, seeds: seeds.select("h").limit(0))
    assert {tuple(r) for r in residue.p1_found(spark, d).collect()} == {("page_cache", "bare")}


# 2

CLEAN = ["Für Käthe Müller aus Zürich gibt es schöne Größen.", "Près de Nîmes, l’été a été très sec – déjà vu.", "Señor Almeñar llegó mañana a Málaga.", "Łódź i Gdańsk są piękne, że aż miło.", "Компания представила новую модель сегодня."]


@pytest.fixture(scope="module")
def plausible():
    counts: dict[str, int] = {}
    for text in CLEAN:
        for word in charset._words(text):
            for before, c, after in charset._contexts(word):
                key = charset._kind(before) + c + charset._kind(after)
                counts[key] = counts.get(key, 0) + 40
    return charset.Plausibility(counts)


@pytest.mark.parametrize("text", CLEAN)
@pytest.mark.parametrize("taken_for", ["cp1252", "cp1250", "mac-roman", "cp437"])
def test_round_trips_through_wrong_charsets(plausible, text, taken_for):
    assert plausible.mend(text) == (text, False)
    garbled = charset._table(taken_for)[2](text.encode("utf-8"))
    assert plausible.mend(garbled) == (text, True)


def test_bytes_are_read_by_the_cheapest_charset(plausible):
    for text, name in ((CLEAN[0], "cp1252"), (CLEAN[3], "cp1250"), (CLEAN[4], "koi8-r"), (CLEAN[4], "cp1251")):
        assert plausible.read(text.encode(name))[0] == text
    assert charset.garbled_page(plausible, CLEAN[0].encode(), None) == (CLEAN[0], False)
    assert charset.garbled_page(plausible, CLEAN[0].encode(), "cp1250")[1]


def test_deep_chains_are_followed(plausible):
    text = "Größen schöne Käthe Müller"
    deep = text
    for _ in range(4):  # four times UTF-8 read as cp1252
        deep = charset._table("cp1252")[2](deep.encode("utf-8"))
    assert plausible.mend(deep) == (text, True)


def test_bytes_of_ideographs_are_read():
    counts = {k: 50 for w in charset._words(CLEAN[0]) for k in (charset._kind(b) + c + charset._kind(a) for b, c, a in charset._contexts(w))}
    model = charset.Plausibility(counts | {"\0" + c: 40 for c in "保証期間は五か月で発売来年二予定す的产品将在明上市価格未测试中达到最高分"})
    for text, name in (("保証期間は五か月です", "shift_jis"), ("発売は来年の二月です", "euc-jp"), ("产品将在明年上市", "gb18030"), ("für Käthe", "cp1252"), ("Größe", "utf-16")):
        assert model.read(f"<p>{text}</p>".encode(name))[0].lstrip("\ufeff") == f"<p>{text}</p>"


def test_lost_characters_mark_a_text(plausible):
    assert plausible.mend("a� b") == ("a� b", True)
    assert plausible.mend(None) == (None, False)


# 3


def test_pages_are_named_by_their_address(spark):
    same = ["http://x.example/A#f", "https://www.X.example:443/A#f", "HTTP://WWW.x.EXAMPLE:80/A#f"]
    other = ["http://x.example:443/A#f", "http://x.example/a#f", "http://x.example/A"]
    keys = [r[0] for r in spark.createDataFrame([(u,) for u in same + other], "url string").select(survivor.page_key("url")).collect()]
    assert len(set(keys[:3])) == 1 and len(set(keys)) == 4


def test_precedence_is_learned_from_timestamps(spark):
    rows = [(g, v, t) for g in range(5) for v, t in (("full", "1"), ("draft", "2"), ("stub", "3"))] + [(9, "stub", "1"), (9, "full", "2")]
    votes = survivor.learn_precedence(spark.createDataFrame(rows, "g long, v string, t string"), "g", "v", "t")
    assert sorted(votes) == [("full", "stub", 5), ("stub", "full", 1)]
    assert survivor.topological_rank(votes) == {"stub": 2, "teaser": 2, "full": 2}  # a cycle with the contract's order
    assert survivor.topological_rank([*votes, ("full", "teaser", 1), ("teaser", "stub", 1)]) == {"full": 1, "teaser": 2, "stub": 3}
    assert survivor.topological_rank([]) == {"stub": 1, "teaser": 2, "full": 3}


def test_the_learned_order_decides_where_timestamps_are_missing(spark, tables):
    """In three groups full texts are older than their teasers; a fourth has no timestamp for its teaser."""
    stamp = lambda u, t: {"url": u, "origin_url": f"https://web.archive.example/web/{t}id_/{u}"}
    releases, origin = [], []
    for k in range(3):
        u, v = f"http://x.example/{k}", f"https://x.example/{k}"
        releases += [{"id": 10 * k + 1, "url": u, "grade": "full", "body": "text", "title": "old"}, {"id": 10 * k + 2, "url": v, "grade": "teaser", "body": "text", "title": "new"}]
        origin += [stamp(u, "20010101000000"), stamp(v, "20020101000000")]
    u, v = "http://x.example/z", "https://x.example/z"
    releases += [{"id": 92, "url": u, "grade": "full", "body": "text", "title": "timed"}, {"id": 91, "url": v, "grade": "teaser", "body": "text", "title": "untimed"}]
    origin.append(stamp(u, "20030101000000"))
    titles = {r["group_id"]: (r["title"], r["survivor_id"]) for r in survivor.p3_record(spark, tables(releases=releases, body_origin=origin)).collect()}
    assert titles == {1: ("new", 1), 11: ("new", 11), 21: ("new", 21), 91: ("untimed", 92)}
    titles = {r["group_id"]: r["title"] for r in survivor.p3_record(spark, tables(releases=releases[-2:], body_origin=origin[-1:])).collect()}
    assert titles == {91: "timed"}  # without votes the contract's order places the teaser before the full text


# 4

PAGE = """<html><head><title>Forum</title></head><body>
<nav>
<a href="/a">About us</a>
<a href="/b">Contact</a>
</nav>
<main>
<h1>New mixer ships</h1>
<p>{0}</p>
<p>• a phantom supply</p>
<!-- hidden text -->
<script>var x = "text";</script>
<aside>
Most read: something
</aside>
</main>
<footer>
© 2001 Someone. All rights reserved.
</footer></body></html>"""


def test_only_the_article_stays():
    pages = [PAGE.format(ARTICLE)] * 5
    words = boilerplate.learn_words(pages, [f"About us\n{ARTICLE}\n{ARTICLE}"] * 5)
    out, inside = boilerplate.page_lines(words, pages[0])
    lines = pages[0].split("\n")
    assert [lines[i] for i in out] == ['<a href="/a">About us</a>', '<a href="/b">Contact</a>', "Most read: something", "© 2001 Someone. All rights reserved."]
    assert len(inside) == 3
    unmarked = re.sub("</?(nav|main|aside|footer)", lambda m: m.group().replace(m[1], "div"), PAGE).format(ARTICLE).replace("<div>", '<div class="x">')
    assert boilerplate.page_lines(words, unmarked)[0] == out
    assert boilerplate.body_lines(words, f"About us\n{ARTICLE}\n© 2001 Someone. All rights reserved.")[0] == [0, 2]


BOXES = """<html><body>
<div class="a"><a href="/1">Zu</a> <a href="/2">Ve</a> <a href="/3">Ka</a>
<a href="/4">Lo</a> <a href="/5">Mi</a></div>
<div class="b">
<p>{0}</p>
<p>{0}</p>
</div></body></html>"""


def test_the_ratio_decides_where_words_are_unknown(monkeypatch):
    """No tag names, no known words: text against tags alone, for pages and bodies."""
    words = boilerplate.learn_words([])
    page = BOXES.format(ARTICLE)
    assert not words.known and boilerplate.page_lines(words, page) == ([1, 2], [4, 5])
    assert boilerplate.body_lines(words, f"Zu Ve Ka\n{ARTICLE}\n{ARTICLE}\nLo Mi")[0] == [0, 3]
    for weight in ("BY_REGION", "BY_LINE", "BY_SIZE"):
        monkeypatch.setattr(boilerplate, weight, 0.0)
    monkeypatch.setattr(boilerplate, "CLEAR", 99.0)
    assert boilerplate.page_lines(words, page) == ([1, 2, 4, 5], [])  # nothing else tells them apart


def test_smoothing_joins_a_short_line_to_its_neighbours(monkeypatch):
    words = boilerplate.learn_words([])
    body = f"{ARTICLE}\nIt costs 300 euros and ships with a case, a cable and a bag.\n{ARTICLE}"
    assert boilerplate.body_lines(words, body)[0] == []
    monkeypatch.setattr(boilerplate, "_smoothed", lambda values: values)
    assert boilerplate.body_lines(words, body)[0] == [1]


def test_thresholds_are_clustered():
    assert boilerplate.valley({}, 3.0) == boilerplate.valley({"1.0": 4}, 3.0) == 3.0
    assert boilerplate.valley({"1.0": 10, "1.2": 10, "4.8": 1, "5.0": 1}, 0.0) == pytest.approx(3.0)


def test_the_models_are_fitted_on_all_pages_and_bodies(spark, tables, monkeypatch):
    monkeypatch.setattr(boilerplate, "SAMPLE", 5, raising=False)
    seen, plain = [], boilerplate.words_of
    monkeypatch.setattr(boilerplate, "words_of", lambda counts: seen.append(counts) or plain(counts))
    pages = [{"url": f"http://x/{i}", "content": PAGE.format(ARTICLE).encode(), "id_content_type": "text/html"} for i in range(40)]
    d = tables(page_cache=pages, releases=[{"id": i, "body": f"{ARTICLE}\n{ARTICLE}"} for i in range(30)])
    found = boilerplate.p4_found(spark, d).collect()
    assert seen[0]["pages"] == {"main": 40, "other": 40} and seen[0]["main"]["mixer"] == 40 and sum(seen[0]["size"].values()) == 60
    assert len({r["rec_key"] for r in found}) == 40


def test_long_lines_are_judged_as_the_model_was_fitted():
    words = boilerplate.learn_words([PAGE.format(ARTICLE)] * 5)
    notice = f"{ARTICLE * 3}We use cookies on your device."
    assert words.score(notice) == -9.0
    line = "The display, the owner. " * 8
    assert len(line) > 160 and words.score(line) == max(-9.0, min(9.0, sum(words.odds.get(f, 0.0) for f in boilerplate.features(line)) * 0.6))


# 5

SAMPLES = {
    "en": "the quick fox and the dog were in the house with all of their friends when it rained",
    "de": "der schnelle fuchs und der hund waren mit allen ihren freunden im haus als es regnete",
    "fr": "le renard rapide et le chien étaient dans la maison avec tous leurs amis quand il pleuvait",
}


def test_languages_of_mixed_texts():
    model = language.Centroids([(k, f"{t} {i}") for k, t in SAMPLES.items() for i in range(5)] + [("de", SAMPLES["en"])])
    text = f"{SAMPLES['en']}. Der {SAMPLES['de'][4:]}.\n{SAMPLES['fr']}."
    found = language.segments(model, text)
    assert [x[2] for x in found] == ["en", "de", "fr"] and all(0 < x[3] <= 1 for x in found)
    assert "".join(text[a:b] for a, b, *_ in found).replace(" ", "") == text.replace("\n", "").replace(" ", "")
    assert language.segments(model, "") == [] and language.segments(model, "123 !?") == []
    assert language.segments(language.Centroids([]), text) == []


OTHERS = {
    "it": "la società ha annunciato oggi un nuovo mixer compatto con dodici canali, che sarà disponibile nei negozi a partire dalla prossima primavera e il prezzo consigliato è di duecento euro",
    "nl": "het bedrijf heeft vandaag een nieuwe compacte mixer met twaalf kanalen aangekondigd, die vanaf het volgende voorjaar in de winkels verkrijgbaar zal zijn voor tweehonderd euro",
    "fi": "yritys julkisti tänään uuden pienikokoisen mikserin, jossa on kaksitoista kanavaa ja joka tulee kauppoihin ensi keväänä ja maksaa kaksisataa euroa laukun kanssa",
}


def test_other_languages_are_rejected():
    texts = {
        "en": "the firm said on monday that its newest desk would reach shops next spring and that owners of earlier models could trade them in at a reduced price for the rest of the year",
        "de": "das unternehmen teilte am montag mit, dass das neueste pult im nächsten frühjahr in die läden kommt und dass besitzer früherer modelle es günstig eintauschen können",
        "fr": "la société a indiqué lundi que sa nouvelle console arriverait en magasin au printemps prochain et que les possesseurs des modèles précédents pourraient les échanger",
    }
    rng = np.random.default_rng(1)
    model = language.Centroids([(k, " ".join(rng.permutation(f"{t} {SAMPLES[k]}".split()))) for k, t in texts.items() for _ in range(6)])
    for k, t in texts.items():
        assert [x[2] for x in language.segments(model, t)] == [k]
    for t in OTHERS.values():
        assert {x[2] for x in language.segments(model, t)} == {language.UNKNOWN}


# 7

WORDS = st.lists(st.sampled_from("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()), min_size=70, max_size=110)


def test_pairs_agree_with_brute_force(spark, tables):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    bodies = [" ".join(rng.choice(vocabulary, 120)) for _ in range(40)]
    for k in range(40):  # small edits, insertions, moved parts, exact copies
        w = bodies[k].split()
        if k % 4 == 0:
            for i in rng.integers(0, 120, 6):
                w[i] = "edit"
        elif k % 4 == 1:
            w[30:30] = ["more"] * 12
        elif k % 4 == 2:
            w = w[60:] + w[:60]
        bodies.append(" ".join(w))
    rows = [{"id": i + 1, "title": None if i % 2 else "a title", "body": b} for i, b in enumerate(bodies)] + [{"id": 900, "body": "short text"}, {"id": 901, "body": None}]
    sets = {}
    for r in rows:
        if r["body"] and len(r["body"].split()) >= 60:
            w = re.findall(r"[^\W_]+", f"{r['title'] or ''} {r['body']}".lower())
            sets[r["id"]] = set(zip(w, w[1:], w[2:]))
    expected = {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    d = tables(releases=rows)
    assert {tuple(r) for r in neardup.p7_found(spark, d).collect()} == expected
    groups = {r["id"]: r["group_id"] for r in neardup.p7_groups(spark, d).collect()}
    assert groups.keys() == sets.keys() and all(groups[a] == groups[b] for a, b in expected)


def test_a_hot_bucket_is_split_not_capped(spark, tables, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 2)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(12):
        w = list(base)
        for i in rng.integers(0, 100, 2):
            w[i] = f"e{k}{i}"
        rows.append({"id": k + 1, "body": " ".join(w)})
    assert neardup.p7_found(spark, tables(releases=rows)).count() == 66


def test_hot_buckets_lose_no_pair(spark, tables, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 2)
    rng = np.random.default_rng(8)
    rows, sets = [], {}
    for k in range(30):  # four edits each, every other one with its halves swapped
        w = [f"w{i}" for i in range(110)]
        for i in rng.choice(27, 4, replace=False):
            w[i * 4 + 2] = f"e{k}n{i}"
        w = w[55:] + w[:55] if k % 2 else w
        sets[k + 1] = set(zip(w, w[1:], w[2:]))
        rows.append({"id": k + 1, "body": " ".join(w)})
    shares = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in combinations(sets, 2)}
    assert sum(0.6 <= s <= 0.65 for s in shares.values()) > 100
    assert {tuple(r) for r in neardup.p7_found(spark, tables(releases=rows)).collect()} == {p for p, s in shares.items() if s >= 0.6}


def test_repeats_lose_no_pair(spark, tables):
    rng = np.random.default_rng(9)
    rows, expected = [], set()
    for k in range(40):
        w = [f"b{k}w{i}" for i in range(100)]
        again = list(w)
        for i in rng.choice(24, k % 5, replace=False):
            again[i * 4 + 2] = f"e{i}"
        x, y = ({*zip(v, v[1:], v[2:])} for v in (w, again * 4))
        rows += [{"id": 2 * k, "body": " ".join(w)}, {"id": 2 * k + 1, "body": " ".join(again * 4)}]
        if len(x & y) >= 0.6 * len(x | y):
            expected.add((2 * k, 2 * k + 1))
    assert len(expected) >= 32
    assert {tuple(r) for r in neardup.p7_found(spark, tables(releases=rows)).collect()} == expected


def test_prefixes_meet_in_passes_and_lose_no_pair(spark, tables, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 2)
    monkeypatch.setattr(neardup, "PASS_ROWS", 1_000, raising=False)
    parts, plain = [], neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, name: parts.append((name, plain(df, name))) or parts[-1][1])
    rng = np.random.default_rng(6)
    rows, sets = [], {}
    for k in range(80):  # fifteen of sixty phrases, so that all share some and few are alike
        w = [f"p{p}w{i}" for p in rng.choice(60, 15, replace=False) for i in range(8)]
        w = rows[-1]["body"].split()[:-4] + ["e"] * 4 if k % 8 == 7 else w
        rows.append({"id": k, "body": " ".join(w)})
        sets[k] = set(zip(w, w[1:], w[2:]))
    expected = {(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    found = {tuple(r) for r in neardup.p7_found(spark, tables(releases=rows)).collect()}
    passes = [df.count() for name, df in parts if name == "near-by-prefix"]
    assert len(expected) >= 10 and found == expected
    assert len(passes) > 1 and sum(passes) < 0.2 * 80 * 79 / 2


def test_runs_are_counted_over_all_releases(spark, tables, monkeypatch):
    monkeypatch.setattr(neardup, "SAMPLE", 5, raising=False)
    bodies = [" ".join([f"set{i}" for i in range(30)] + [f"r{k}w{i}" for i in range(40)]) for k in range(50)]
    d = tables(releases=[{"id": k, "body": b} for k, b in enumerate(bodies)] + [{"id": 90, "body": "short text"}, {"id": 91}])
    times = neardup.run_counts(spark.read.parquet(f"{d}/releases.parquet"))
    runs = neardup.kmers(None, bodies[7])
    assert len(runs) == 68 and times[runs[:28] % np.uint64(neardup.SLOTS)].min() >= 50 and times.sum() == 50 * 68
    assert set(neardup.prefix(runs, times)[1].tolist()) <= set(runs[28:].astype(np.uint32).view(np.int32).tolist())


def test_the_alignment_keeps_and_drops_pairs(spark, tables):
    rng = np.random.default_rng(4)
    w = [f"w{i}" for i in range(120)]
    moved = w[80:] + w[:80]
    scattered = [x for i in rng.permutation(30) for x in [*w[i * 4 : i * 4 + 3], f"s{i}"]]
    runs = {n: neardup.kmers(None, " ".join(x)) for n, x in (("w", w), ("moved", moved), ("scattered", scattered))}
    assert neardup.chains(runs["w"], runs["moved"]) == ([78, 38], 236) and neardup.aligned(runs["w"], runs["moved"]) == (True, 116 / 120)
    assert sum(neardup.chains(runs["w"], runs["scattered"])[0]) == len(np.intersect1d(runs["w"], runs["scattered"]))
    lone = [x for i in rng.permutation(30) for x in [*w[i * 4 : i * 4 + 3], *(f"s{i}x{k}" for k in range(90))]]
    assert neardup.aligned(runs["w"], neardup.kmers(None, " ".join(lone))) == (False, 0.0)
    d = tables(releases=[{"id": 1, "body": " ".join(w)}, {"id": 2, "body": " ".join(moved)}, {"id": 3, "body": " ".join(w[:90] + [f"z{i}" for i in range(60)])}])
    assert [tuple(r) for r in neardup.p7_found(spark, d).collect()] == [(1, 2)]


def test_a_class_of_copies_is_split(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    members = spark.createDataFrame([(i, 1) for i in range(1, 21)] + [(30, 30)], "id long, rep long")
    assert sorted(map(tuple, neardup.copy_pairs(members).collect())) == [*combinations(range(1, 21), 2)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40) if i != 20], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 42)], "node long")
    got = dict(map(tuple, neardup.components(edges, nodes).collect()))
    assert got == {i: 1 if i <= 20 else 21 if i <= 40 else 41 for i in range(1, 42)}


# 8


@pytest.fixture(scope="module")
def encoder():
    return tokens.TextEncoder(tokens.read_ranks())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_ids_agree_with_the_publishers_library(encoder, text):
    tiktoken = pytest.importorskip("tiktoken")
    other = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=encoder.encoder.ranks, special_tokens={})
    assert encoder.encode(text) == other.encode_ordinary(text)
    assert encoder.encode(None) == []


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=12), st.integers(0, 40), st.integers(0, 40))
def test_appends_and_edits_are_exact(encoder, data, new, a, b):
    e = encoder.encoder
    last = e.last_tokens(data)
    assert e.appended(last, data, new) == e.last_tokens(data + new)
    start, end = sorted((min(a, len(data)), min(b, len(data))))
    changed, again = e.edited(last, data, start, end, new)
    assert changed == data[:start] + new + data[end:] and again == e.last_tokens(changed)


@settings(max_examples=300, deadline=None)
@given(st.text("ab1 '\n\tsl!é", max_size=30), st.text("a1 'sl\n!", max_size=8), st.integers(0, 30), st.integers(0, 30))
def test_edits_of_texts_are_exact(encoder, text, new, a, b):
    start, end = sorted((min(a, len(text)), min(b, len(text))))
    pieces = encoder.edited(encoder.pieces(text), start, end, new)
    changed = text[:start] + new + text[end:]
    assert pieces == encoder.pieces(changed) and encoder.ids(pieces) == encoder.encode(changed)


def test_titles_and_texts_are_appended(spark, tables, encoder):
    d = tables(documents=[{"doc_id": 1, "title": "It", "text": "'s 2 it."}, {"doc_id": 2, "text": "  x"}, {"doc_id": 3, "title": "T"}, {"doc_id": 4}])
    assert dict(map(tuple, tokens.p8_titled(spark, d).collect())) == {1: encoder.encode("It\n\n's 2 it."), 2: encoder.encode("\n\n  x"), 3: encoder.encode("T\n\n"), 4: encoder.encode("\n\n")}


# 9


def test_leaks_agree_with_brute_force(spark, tables):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    w = item.split()
    ja = "保証期間は五か月で、従来の製品より長くなります。発売は来年の二月を予定しており、価格は未定です。"
    documents = [
        {"doc_id": 1, "text": "before " + ", ".join(w[2:15]).upper() + " after"}, {"doc_id": 2, "text": " ".join(w[:12])}, {"doc_id": 3, "text": " ".join([*w[:6], "edit", *w[7:]])},
        {"doc_id": 4, "text": "前" + ja[5:35] + "後"}, {"doc_id": 5, "text": ja[5:34]}, {"doc_id": 6, "text": None}, {"doc_id": 7, "text": " ".join(w[3:16]) + " x " + " ".join(w)},
    ]
    d = tables(documents=documents, eval_items=[{"item_id": 10, "lang": "en", "text": item}, {"item_id": 11, "lang": "ja", "text": ja}, {"item_id": 12, "lang": "en", "text": "too short"}])
    assert sorted(map(tuple, leaks.p9_found(spark, d).collect())) == [(1, 10), (4, 11), (7, 10)]
    assert {(r["doc_id"], r["item_id"]) for r in leaks.p9_leaks(spark, d).collect()} >= {(1, 10), (3, 10), (7, 10)}


def test_an_edited_copy_alone_leaks(spark, tables):
    w = [f"word{i}" for i in range(26)]
    copy = [*w[:6], "edit", *w[7:18], "edit", *w[19:]]
    d = tables(documents=[{"doc_id": 1, "text": " ".join(copy)}, {"doc_id": 2, "text": ARTICLE}], eval_items=[{"item_id": 5, "lang": "en", "text": " ".join(w)}])
    assert [(r["doc_id"], r["item_id"], r["exact"]) for r in leaks.p9_leaks(spark, d).collect()] == [(1, 5, False)]
    assert leaks.p9_found(spark, d).count() == 0


@pytest.mark.parametrize("every", [6, 8, 12])
def test_most_edited_copies_are_found(spark, tables, every):
    rng = np.random.default_rng(every)
    items, documents = [], []
    for k in range(40):
        w = [f"i{k}w{n}" for n in range(60)]
        items.append({"item_id": k, "lang": "en", "text": " ".join(w)})
        w = w[15:45] if k % 4 == 0 else w  # half items
        copy = list(w)
        for n in range(every - 1, len(copy), every):  # replaced, dropped, put in
            copy[n] = ["", f"x{n}", f"{copy[n]} y{n}"][int(rng.integers(3))]
        documents.append({"doc_id": k, "text": " ".join(["before"] * 30 + copy + ["after"] * 30)})
        if k % 2:  # a verbatim copy elsewhere changes what is rare
            documents.append({"doc_id": 100 + k, "text": " ".join(w)})
    d = tables(documents=documents, eval_items=items)
    got = {(r["doc_id"], r["item_id"]) for r in leaks.p9_leaks(spark, d).collect()}
    assert sum((k, k) in got for k in range(40)) >= 36 and all(a % 100 == b for a, b in got)


def test_items_come_in_blocks(spark, tables, monkeypatch):
    monkeypatch.setattr(leaks, "MOST_ITEMS", 3)
    items = [{"item_id": k, "lang": "en", "text": " ".join(f"i{k}w{n}" for n in range(20))} for k in range(11)]
    d = tables(documents=[{"doc_id": k, "text": items[k]["text"]} for k in range(11)], eval_items=items)
    assert sorted(map(tuple, leaks.p9_found(spark, d).collect())) == [(k, k) for k in range(11)]


def slow_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (leaks.MATCH if x == y else leaks.MISMATCH), h[i - 1][j] + leaks.GAP, h[i][j - 1] + leaks.GAP)
    return max(map(max, h))


@given(st.lists(st.sampled_from([1, 2, 3]), max_size=12), st.lists(st.sampled_from([1, 2, 3]), max_size=12))
def test_alignment_agrees_with_the_plain_recurrence(a, b):
    task = (np.array(a, np.int32), np.array(b, np.int32), 0)
    score, first, last = leaks.align_many([task, task], band=12)[1]
    assert score == slow_alignment(a, b)
    assert slow_alignment(a[first:last], b) == score


# 10


def cut(text):
    return [text[a:b] for a, b in sentences.sentences(text)]


@pytest.mark.parametrize(
    "parts",
    [
        ["Dr. A. Smith paid approx. 5.20 in the U.S. office, e.g. for stands, bags, etc.", "The rest came later."],
        ["“Does it run?", "It does,” she said at 6 p.m. Central European Time."], ["The “Louder!” by Kim and “hum?” tests are ... fine.", "Next."],
        ["Laut Abb. 4 (vgl. Nr. 7) gibt es z. B. am 21. November 2011 u. a. drei.", "Das Gerät kostet 5 €.", "Warum?", "Darum!"],
        ["L’ensemble, c.-à-d. env. 3, coûte 5 €.", "« Est-ce bon ?", "Oui », répond M. Dupont."], ["¿Funciona?", "Sí, p. ej. hoy."],
        ["Гарантия 5 мес. вместо 6 мес. для города, и т. п., а также ок. 7.", "Почему?"], ["保証は「長いですか？", "もちろんです。」と述べました。", "次です！"],
        ["负责人表示：“它支持吗？", "当然支持。”", "在测试中，达到了！"], ["डॉ. Rao ने कहा कि यह नया है।", "क्या यह चलता है?"], ["(It was shown.)", "Then it ended."],
        ["Owned by Big Corp.", "The end.", "Klang Co. KG wächst."],
    ],
)
def test_boundaries(parts):
    spaced = not re.search("[぀-ヿ一-鿿]", parts[0])
    assert cut((" " if spaced else "").join(parts)) == parts


def test_cuts_depend_on_one_another():
    """By the sign of each mark alone all of these would be cuts."""
    line = "A first one. B. The rest (of it. And more) goes on."
    nodes = [(12, 12, 1.0), (15, 15, 1.2), (32, 32, 2.0), (51, 51, 9.0)]
    assert sentences.best_path(line, nodes) == [15, 51]
    assert sentences.best_path(line, [(12, 12, 1.0), (15, 15, 4.0), (32, 32, 3.0), (51, 51, 9.0)]) == [15, 32, 51]
    assert sentences.best_path(line, [(12, 12, 3.0), (15, 15, 4.0), (51, 51, -1.0)]) == [12, 15]


@pytest.mark.parametrize("text", ["ကျွန်တော်သွားသည်။ သူလာသည်။", "ខ្ញុំទៅ។ គាត់មក។", "እሱ ሄደ። እሷ መጣች።", "Նա գնաց։ Նա եկավ։"])
def test_terminals_of_other_scripts(text):
    assert cut(text) == [x + text[-1] for x in re.split(r"(?<=.)" + text[-1] + " ?", text) if x]


def test_opening_words_are_learned():
    """ただし opens lines of the corpus and then a sentence behind a quotation; と carries on."""
    lines = ["ただし価格は未定です。", "価格は未定です。", "発売は来年です。", "ただし発売は来年です。"] * 30 + ["価格と発売は来年です。"] * 60
    counts = sentences.Counter()
    for line in lines:
        sentences.count_line(line, counts)
    words = sentences.Words(counts)
    assert words.segment("ただし価格")[0] == "ただし" and words.first["ただし"] >= sentences.OPENS
    before, behind = "彼は「未定です。」", "ただし価格は来年です。"
    parts = lambda text, w: [text[a:b] for a, b in sentences.line_sentences(text, False, w)]
    assert parts(before + behind, words) == [before, behind]
    assert parts(before + behind, sentences.NOTHING) == [before + behind]
    assert parts(before + "と述べました。", words) == [before + "と述べました。"]
    assert words.last["です"] > 0.5 > words.last.get("価格", 0.0)


def test_lines_thai_and_blanks():
    assert cut("Head\r\n\r\n* item\n1. first thing") == ["Head", "* item", "1. first thing"]
    assert cut("บริษัทเปิดตัว สินค้าใหม่ ราคา 102 บาท") == ["บริษัทเปิดตัว", "สินค้าใหม่", "ราคา 102 บาท"]
    assert cut("") == cut(" \n ") == sentences.sentences(None) == []


@settings(deadline=None)
@given(st.text("aB.!? \n“”(1。」กข", max_size=60))
def test_sentences_cover_the_text(text):
    spans = sentences.sentences(text)
    assert "".join(text[a:b] for a, b in spans).translate({ord(c): None for c in " \n"}) == text.translate({ord(c): None for c in " \n"})
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert unicodedata.normalize("NFC", text) is not None
