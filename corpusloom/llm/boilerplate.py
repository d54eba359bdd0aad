"""Page boilerplate mixed with main content (problem 4).

Pages stream through the standard library's parser. Each source line gets its visible
text, its tags and the region (box, cell, navigation, footer ...) it lies in. The ratio of
text to tags decides first: that of the region against a threshold, which clusters the
regions of the corpus into poor and rich ones, and that of the line, smoothed by a Gaussian
over its neighbours, against the spread of the page's ratios. Regions far below the
threshold are boilerplate by that alone. What the ratio leaves open, such as headlines, list
items and legal lines, is settled by words: a naive Bayes model of lines whose labels come
from pages that mark their parts (``main`` and ``article`` against ``nav``, ``aside``,
``footer``) and, on other pages, from regions whose ratio is clear. Bodies of releases have
no tags left but line breaks, so there the ratio is a line's length, smoothed alike.

Threshold and words are fitted on all pages and bodies. Each page is read and parsed once;
what its lines hold is kept, counted, and judged once the counts of all are there. The tasks
count features, and only the counts of those that LEAST_SHARE of all show come to the driver.

Defined results: null and empty texts have no lines; lines without a letter or digit
outside markup are no cases, whatever they lie in; without pages to fit on the words say
nothing and the ratio decides alone, by fixed thresholds.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import charset
from corpusloom.llm.residue import residue_records
from corpusloom.session import spread, written

SIGMA = 1.0
#: A word, pair or shape seen on fewer pages says nothing (names of single products).
LEAST_PAGES = 3
#: Nor does one of a smaller share of the pages' parts, which bounds the model at any size.
LEAST_SHARE = 2e-4
#: Thresholds of the regions' log ratio and of lines' log length where there is nothing to
#: fit them on; a region is clear from CLEAR off.
RATIO_AT, SIZE_AT, CLEAR = 3.3, 4.4, 0.9
#: How much the ratio of the region, that of the line, and the length of a body's line weigh.
BY_REGION, BY_LINE, BY_SIZE = 12.0, 3.0, 6.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(("head", "script", "style", "noscript", "template", "title"))
_OTHER = frozenset(("nav", "aside", "footer", "form"))
_MAIN = frozenset(("main", "article"))
_BOXES = frozenset(("div", "td", "th", "section", "header", "center", "blockquote", "ul", "ol", "table", "tr", "dl", "body")) | _OTHER | _MAIN | _HIDDEN
#: Notices on cookies, in the words of any language: what they say of the reader's device or visit.
_COOKIES = re.compile(r"(?i)cookies?\b|témoins de connexion|\bкуки\b")
_CONSENT = re.compile(r"(?i)\b(?:accept|agree|policy|device|services|your|partners?|zustimm|stimmen|gerät|besuch|dienste|akzept|zaakcept|acept|mejorar|visita|equipo|socios|améliorer|visite|accepter|partenaires|wizyt|urządzeni|partner|устройств|посещени|соглас|приня|улучш)")
_MARKS_MAIN, _MARKS_OTHER = re.compile(r"(?i)<(?:main|article)\b"), re.compile(r"(?i)<(?:nav|aside|footer)\b")
_PAGE, _TAG = re.compile(r"(?i)<(?:body|p|div|td)\b"), re.compile(r"<\w+[^>]*>")
_WORD = re.compile(r"[^\W\d_]+|\d+|©|®|[|>»•]")


class Lines(HTMLParser):
    """Text, number of tags, text in links and region of each source line of a page."""

    def __init__(self, source: str) -> None:
        super().__init__(convert_charrefs=True)
        n = source.count("\n") + 1
        self.text, self.tags, self.linked, self.region = [""] * n, [0] * n, [0] * n, [0] * n
        self.kind = [""]  # of each region: main, other or nothing known
        self._open: list[tuple[str, int]] = []  # tag and the region it lies in
        self._hidden, self._link = 0, 0
        self.feed(source)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags[self.lineno - 1] += 1
        if tag == "a":
            self._link = 1
        if tag in _HIDDEN:
            self._hidden += 1
        if tag == "body":  # what was left open in the head ends here
            self._hidden, self._open = 0, []
        if tag in _BOXES:
            region = self._open[-1][1] if self._open else 0
            if tag in _OTHER or tag in _MAIN or tag in ("td", "center", "blockquote") or (attrs and tag not in ("ul", "ol", "tr", "table", "body")):
                self.kind.append("other" if tag in _OTHER else "main" if tag in _MAIN else "")
                region = len(self.kind) - 1
            self._open.append((tag, region))

    def handle_endtag(self, tag: str) -> None:
        self.tags[self.lineno - 1] += 1
        if tag == "a":
            self._link = 0
        if tag in _BOXES and any(t == tag for t, _ in self._open):
            while self._open:
                t, _ = self._open.pop()
                if t in _HIDDEN and self._hidden:
                    self._hidden -= 1
                if t == tag:
                    break

    def handle_data(self, data: str) -> None:
        if self._hidden or not data.strip():
            return
        first, region = self.lineno - 1, self._open[-1][1] if self._open else 0
        for i, part in enumerate(data.split("\n")):
            if part.strip() and first + i < len(self.text):
                if not self.text[first + i]:
                    self.region[first + i] = region
                self.text[first + i] += part
                self.linked[first + i] += self._link * len(part)


class Kept:
    """The lines of a page as ``packed`` keeps them."""

    def __init__(self, kept: str) -> None:
        self.text, self.tags, self.linked, self.region, self.kind, self.marked, self.fits, self.source = json.loads(kept)


def packed(source: str) -> str:
    """What is judged of a page: its lines, whether it marks its parts, whether models are fitted
    on it, and its source lines if it has no tag."""
    page, marked = Lines(source), marks_itself(source)
    return json.dumps([page.text, page.tags, page.linked, page.region, page.kind, marked, marked or bool(_PAGE.search(source)), None if _TAG.search(source) else source.split("\n")], separators=(",", ":"))


def shown(text: str) -> bool:
    return any(c.isalnum() for c in text)


def features(text: str) -> list[str]:
    """Words, pairs of words and the shape of a line; numbers count as one word."""
    words = ["0" if w.isdigit() else w.lower() for w in _WORD.findall(text)]
    end = text.rstrip()[-1:] or " "
    n = len(words)
    shape = [f"#n{min(n, 3) if n < 4 else 4 if n < 7 else 7 if n < 12 else 12}", "#end" + (end if end in ".!?:…”“»)" else "a" if end.isalnum() else "-")]
    return [*{*words, *map(" ".join, zip(words, words[1:]))}, "^" + " ".join(words[:1]), "^^" + " ".join(words[:2]), *shape]


class Words:
    """Log odds for main content of a line's features, from the pages that show each."""

    def __init__(self, main: Counter[str], other: Counter[str], pages: tuple[int, int], ratio_at: float = RATIO_AT, size_at: float = SIZE_AT) -> None:
        self.ratio_at, self.size_at = ratio_at, size_at
        a, b = pages[0] + 2, pages[1] + 2
        self.odds = {}
        for f in main.keys() | other.keys():
            if main[f] + other[f] >= LEAST_PAGES:
                odds = math.log((main[f] + 0.3) / a) - math.log((other[f] + 0.3) / b)
                self.odds[f] = max(-5.0, min(1.0, odds))  # phrases of boilerplate are set, those of articles free
        self.known = min(pages) > 0
        self._scores: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_scores": {}}

    def score(self, text: str) -> float:
        if not self.known:
            return 0.0
        if (score := self._scores.get(text)) is None:
            odds = self.odds.get
            if _COOKIES.search(text) and _CONSENT.search(text):
                score = -9.0
            else:
                score = max(-9.0, min(9.0, sum([odds(f, 0.0) for f in features(text)]) * 0.6))
            if len(text) < 80:  # the longer ones hardly come again
                if len(self._scores) > 50_000:
                    self._scores.clear()
                self._scores[text] = score
        return score


def marks_itself(source: str) -> bool:
    return bool(_MARKS_MAIN.search(source) and _MARKS_OTHER.search(source))


def count_page(page: Lines | Kept, marked: bool, counts: dict[str, Counter[str]]) -> None:
    """Add a page's regions to the histogram of ratios, and the features of its lines, once a
    page, to those of the part that the page's marks or a clear ratio put them in."""
    ratios, smooth, numbers = page_ratios(page)
    shown_in = Counter(page.region[i] for i in numbers)
    for r, ratio in ratios.items():
        counts["ratio"][f"{ratio:.1f}"] += shown_in[r]
    found: dict[str, set[str]] = defaultdict(set)
    for i in numbers:
        r = page.region[i]
        if marked:
            kind = page.kind[r]
        else:
            clear = ratios[r] - RATIO_AT
            kind = "main" if clear >= CLEAR / 1.5 and smooth[i] > 0 else "other" if clear <= -CLEAR / 1.5 and smooth[i] < 0 else ""
        if kind:
            found[kind].update(features(page.text[i]))
    for kind, features_ in found.items():
        counts[kind].update(features_)
        counts["pages"][kind] += 1


def count_body(body: str, counts: dict[str, Counter[str]]) -> None:
    counts["size"].update(f"{x:.1f}" for x in body_sizes(body.split("\n"))[1])


def valley(histogram: dict[str, int], otherwise: float) -> float:
    """The middle between the two clusters of a histogram's values (2-means in one dimension)."""
    values = np.array([float(x) for x in histogram])
    if len(values) < 2:
        return otherwise
    weights = np.array([*histogram.values()], float)
    low, high = values.min(), values.max()
    for _ in range(50):
        near = values <= (low + high) / 2
        new = np.average(values[near], weights=weights[near]), np.average(values[~near], weights=weights[~near])
        if new == (low, high):
            break
        low, high = new
    return float((low + high) / 2)


def words_of(counts: dict[str, Counter[str]]) -> Words:
    return Words(counts["main"], counts["other"], (counts["pages"]["main"], counts["pages"]["other"]), valley(counts["ratio"], RATIO_AT), valley(counts["size"], SIZE_AT))


def learn_words(pages: list[str], bodies: list[str] = ()) -> Words:
    """The models of some pages and bodies at hand."""
    counts: dict[str, Counter[str]] = defaultdict(Counter)
    for source in pages:
        count_page(Lines(source), marks_itself(source), counts)
    for body in bodies:
        count_body(body, counts)
    return words_of(counts)


def fit(rows: DataFrame) -> Words:
    """The models of the corpus, of (rel, other): its bodies, and its pages as ``packed`` keeps them."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter[str]] = defaultdict(Counter)

        def flush() -> pd.DataFrame:
            made = pd.DataFrame([(kind, feature, n) for kind, of in counts.items() for feature, n in of.items()], columns=["kind", "feature", "n"])
            counts.clear()
            return made

        for batch in batches:
            for rel, other in zip(batch["rel"], batch["other"]):
                if rel != "page_cache":
                    count_body(other, counts)
                elif (page := Kept(other)).fits:
                    count_page(page, page.marked, counts)
                if len(counts["main"]) + len(counts["other"]) > 300_000:
                    yield flush()
        if any(counts.values()):
            yield flush()

    counted = spread(rows.select("rel", "other")).mapInPandas(work, "kind string, feature string, n long").groupBy("kind", "feature").agg(F.sum("n").alias("n"))
    counted = written(counted, "page-words")
    parts = counted.filter("kind = 'pages'").agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_PAGES, math.ceil(parts * LEAST_SHARE))
    seen = F.sum(F.when(F.col("kind").isin("main", "other"), F.col("n")).otherwise(least)).over(Window.partitionBy("feature"))
    counts: dict[str, Counter[str]] = defaultdict(Counter)
    for r in counted.withColumn("seen", seen).filter(F.col("seen") >= least).collect():
        counts[r["kind"]][r["feature"]] = r["n"]
    return words_of(counts)


def _smoothed(values: np.ndarray) -> np.ndarray:
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    framed = np.concatenate((np.full(reach, values[0]), values, np.full(reach, values[-1])))
    return np.convolve(framed, kernel / kernel.sum(), mode="valid")


def page_ratios(page: Lines | Kept) -> tuple[dict[int, float], list[float], list[int]]:
    """(log ratio of text to tags of each region, how far each line's smoothed log ratio lies
    above the spread of the page's, numbers of the shown lines)."""
    numbers = [i for i, t in enumerate(page.text) if t and shown(t)]
    if not numbers:
        return {}, [], []
    size = [len(t.strip()) for t in page.text]
    ratio = np.array(size, float) / np.maximum(1, page.tags)
    smooth = np.log1p(_smoothed(ratio)) - math.log1p(max(1.0, float(ratio.std())))
    text, tags = defaultdict(int), defaultdict(int)
    for i in numbers:
        text[page.region[i]] += size[i]
        tags[page.region[i]] += max(1, page.tags[i])
    return {r: math.log1p(n / tags[r]) for r, n in text.items()}, smooth.tolist(), numbers


def page_lines(words: Words, source: str | Kept) -> tuple[list[int], list[int]]:
    """Numbers of the shown lines outside and inside the article of a page."""
    page = Lines(source) if isinstance(source, str) else source
    ratios, smooth, numbers = page_ratios(page)
    out, inside, open_ = [], [], []
    for i in numbers:  # a clear ratio decides alone
        clear, kind = ratios[page.region[i]] - words.ratio_at, page.kind[page.region[i]]
        (out if clear < -CLEAR and smooth[i] < 0 and kind != "main" else inside if clear > CLEAR and smooth[i] > 0 and kind != "other" else open_).append(i)
    said = {i: words.score(page.text[i]) for i in open_}
    together: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for i in open_:
        weight = 1 + min(len(page.text[i]), 300) // 60
        together[page.region[i]][0] += weight * said[i]
        together[page.region[i]][1] += weight
    for i in open_:
        r = page.region[i]
        kind = page.kind[r]
        by_ratio = BY_REGION * math.tanh(2.5 * (ratios[r] - words.ratio_at)) + BY_LINE * math.tanh(2 * smooth[i])
        by_words = 0.8 * said[i] + max(-4.8, min(4.8, 0.8 * together[r][0] / together[r][1]))
        linked = page.linked[i] > 0.55 * len(page.text[i])
        own = by_ratio + by_words - 3.0 * linked + (-15 if kind == "other" else 5 if kind == "main" else 0)
        (inside if own > 0 else out).append(i)
    return sorted(out), sorted(inside)


def body_sizes(lines: list[str]) -> tuple[list[int], list[float]]:
    """Numbers of a body's shown lines, and the middle of each one's log length and smoothed log length."""
    numbers = [i for i, t in enumerate(lines) if shown(t)]
    if not numbers:
        return [], []
    size = np.array([float(len(lines[i].strip())) for i in numbers])
    return numbers, ((np.log1p(_smoothed(size)) + np.log1p(size)) / 2).tolist()


def body_lines(words: Words, body: str) -> tuple[list[int], list[int]]:
    """The same for a body, whose lines have no tags."""
    lines = body.split("\n")
    numbers, sizes = body_sizes(lines)
    clear = [x > words.size_at + CLEAR for x in sizes]
    said = [0.0 if sure else words.score(lines[i]) for i, sure in zip(numbers, clear)]
    out, inside = [], []
    for k, i in enumerate(numbers):
        if clear[k]:  # a clear length decides alone
            inside.append(i)
            continue
        beside = [said[j] for j in (k - 1, k + 1) if 0 <= j < len(said)]
        own = BY_SIZE * math.tanh(1.5 * (sizes[k] - words.size_at)) + said[k] + (sum(beside) / len(beside) / 4 if beside else 0.0) + (1.0 if lines[i].lstrip()[:1] in "•*-–" else 0.0) + 0.5
        (inside if own > 0 else out).append(i)
    return out, inside


def _lines(spark: SparkSession, sf_dir: str, make) -> DataFrame:
    """(rel, rec_key, other) of the records that are no residue; ``make`` gets the record's body
    or kept page and its lines outside and inside the article. Mending replaces words only, so
    the lines keep their numbers."""
    model = spark.sparkContext.broadcast(charset.learn(spark, sf_dir))
    residue, rows = residue_records(spark, sf_dir, model, lambda rel, text: packed(text) if rel == "page_cache" else text)
    words = spark.sparkContext.broadcast(fit(rows))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for rel, key, other in zip(batch["rel"], batch["rec_key"], batch["other"]):
                record = Kept(other) if rel == "page_cache" else other
                if (x := make(record, *(page_lines if rel == "page_cache" else body_lines)(words.value, record))) is not None:
                    made.append((rel, key, x))
            if made:
                yield pd.DataFrame(made, columns=["rel", "rec_key", "other"])

    judged = spread(rows.select("rel", "rec_key", "other")).mapInPandas(work, "rel string, rec_key string, other string")
    return judged.join(residue, ["rel", "rec_key"], "left_anti")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key, line_no) of the shown lines that are not part of the article."""
    rows = _lines(spark, sf_dir, lambda record, out, inside: ",".join(map(str, out)) or None)
    return rows.select("rel", "rec_key", F.explode(F.split("other", ",").cast("array<int>")).alias("line_no")).distinct()


def p4_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key, article): the source lines of the article alone, as plain text."""

    def make(record: str | Kept, out: list[int], inside: list[int]) -> str:
        if isinstance(record, str):
            lines = Lines(record).text if _TAG.search(record) else record.split("\n")
        else:
            lines = record.source or record.text
        return "\n".join(lines[i].strip() for i in inside if i < len(lines))

    return _lines(spark, sf_dir, make).select("rel", "rec_key", F.col("other").alias("article")).dropDuplicates(["rel", "rec_key"])
