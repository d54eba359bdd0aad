"""Positioned words of a page (the XML that PDF extractors give) to markup in the subset.

Words join to lines where their heights overlap, lines to paragraphs where they follow
closely; large lines are headings, bulleted ones items of lists, which nest by their
indent. Words that stand on their side, and lines in the margins that come on several pages,
are left out. The extractor itself is outside: its XML comes in as data.

Defined results: null stays null; XML that can't be read gives empty texts.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from statistics import median
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.richtext import to_text

# Share of overlap that makes one line, blank widths within a word, sizes of
# headings and distances of paragraphs against the median, and the indent of a list.
OVERLAP, TOUCH, HEADING, PARAGRAPH, INDENT = 0.6, 0.15, 1.6, 1.6, 12.0
# Height from which a narrow word is turned, and its greatest width against that; share of a
# page's height that is margin.
TURNED, NARROW, EDGE = 40.0, 0.25, 0.06
_BULLET = re.compile(r"^\s*([•·▪◦*–-]|\d{1,2}[.)])\s+")


Word = tuple[float, float, float, float, str]


def page_words(xml: str) -> list[tuple[float, list[Word], list[Word]]]:
    """(height, upright words, turned ones) of each page; a word is (left, top, right, bottom, text)."""
    root = ElementTree.fromstring(re.sub(r"\sxmlns=\"[^\"]+\"", "", xml, count=1))
    pages = []
    for page in root.iter("page"):
        words = [(float(w.get("xMin")), float(w.get("yMin")), float(w.get("xMax")), float(w.get("yMax")), w.text or "") for w in page.iter("word")]
        turned = [w for w in words if w[3] - w[1] > TURNED and w[2] - w[0] < NARROW * (w[3] - w[1])]
        pages.append((float(page.get("height") or 0), [w for w in words if w not in turned], turned))
    return pages


def body_lines(pages: list[tuple[float, list[Word], list[Word]]]) -> list[tuple[float, float, float, str]]:
    """The lines of all pages but for those that stand in a margin on several of them."""
    found = [(height, line) for height, words, _ in pages for line in lines(words)]
    edge = lambda height, line: height > 0 and (line[1] < EDGE * height or line[1] + line[2] > (1 - EDGE) * height)
    shape = lambda text: re.sub(r"\d+", "0", text)
    often = Counter(shape(line[3]) for height, line in found if edge(height, line))
    return [line for height, line in found if not (edge(height, line) and often[shape(line[3])] > 1)]


def lines(words: list[tuple[float, float, float, float, str]]) -> list[tuple[float, float, float, str]]:
    """(left, top, height, text) of the lines, from top to bottom."""
    rows: list[list] = []
    for w in sorted(words, key=lambda w: (w[1], w[0])):
        for row in reversed(rows[-6:]):
            top, bottom = min(x[1] for x in row), max(x[3] for x in row)
            shared = min(bottom, w[3]) - max(top, w[1])
            if shared >= OVERLAP * min(bottom - top, w[3] - w[1]):
                row.append(w)
                break
        else:
            rows.append([w])
    out = []
    for row in rows:
        row.sort()
        height = median(x[3] - x[1] for x in row)
        text = row[0][4]
        for a, b in zip(row, row[1:]):
            text += ("" if b[0] - a[2] < TOUCH * height else " ") + b[4]
        out.append((row[0][0], min(x[1] for x in row), height, text))
    return sorted(out, key=lambda x: x[1])


def to_markup(xml: str) -> str:
    """The document's headings, lists and paragraphs."""
    every = body_lines(page_words(xml))
    if not every:
        return ""
    usual = median(x[2] for x in every)
    steps = [b[1] - a[1] for a, b in zip(every, every[1:]) if 0 < b[1] - a[1] < 6 * usual]
    leading = median(steps) if steps else usual
    out: list[tuple[str, str, float]] = []
    before = None
    for left, top, height, text in every:
        far = before is None or top - before > PARAGRAPH * leading or top < before
        if height > HEADING * usual:
            out.append(("h3", text, left))
        elif m := _BULLET.match(text):
            out.append(("ol" if m[1][0].isdigit() else "ul", text[m.end() :], left))
        elif not far and out and out[-1][0] != "h3" and (out[-1][0] == "p" or left >= out[-1][2] + INDENT / 2):
            kind, so_far, at = out[-1]
            out[-1] = (kind, so_far[:-1] + text if so_far.endswith("-") and text[:1].islower() else f"{so_far} {text}", at)
        else:
            out.append(("p", text, left))
        before = top
    parts, i = [], 0
    while i < len(out):
        kind = out[i][0]
        if kind in ("ul", "ol"):
            j = i
            while j < len(out) and out[j][0] in ("ul", "ol"):
                j += 1
            parts += _lists(out[i:j])
            i = j
        else:
            parts.append(f"<{kind}>{html.escape(out[i][1], quote=False)}</{kind}>")
            i += 1
    return "\n".join(parts)


def _lists(items: list[tuple[str, str, float]]) -> list[str]:
    """Items (kind, text, left) as lists; one that is indented further lies within the item before."""
    made: list[str] = []
    i = 0
    while i < len(items):
        kind, _, left = items[i]
        rows = []
        while i < len(items) and items[i][0] == kind and items[i][2] < left + INDENT:
            text, j = html.escape(items[i][1], quote=False), i + 1
            while j < len(items) and items[j][2] >= left + INDENT:
                j += 1
            rows.append(f"<li>{text}{''.join(_lists(items[i + 1 : j]))}</li>")
            i = j
        made.append(f"<{kind}>{''.join(rows)}</{kind}>")
    return made


_CONVERTED = T.StructType([T.StructField(n, T.StringType()) for n in ("body", "body_html", "turned")])


@F.pandas_udf(_CONVERTED)
def converted(documents: pd.Series) -> pd.DataFrame:
    """struct(body, body_html, turned) of layouts: text, markup, and the words left out as turned."""
    rows = []
    for xml in documents:
        try:
            markup = to_markup(xml) if isinstance(xml, str) else None
            turned = " ".join(w[4] for _, _, words in page_words(xml) for w in words) if isinstance(xml, str) else None
        except (ElementTree.ParseError, TypeError, ValueError):
            markup = turned = ""
        rows.append((None if markup is None else to_text(markup), markup, turned))
    return pd.DataFrame(rows, columns=["body", "body_html", "turned"])
