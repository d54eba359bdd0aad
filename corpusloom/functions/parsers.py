"""Page parsers by source, as data: where the article is, where it ends, how its title and date
are written, and how a listing splits into entries.

A site's templates differ in these few things only, so a parser is a ``Spec`` and a source
has one or several, tried in order. ``parse`` is the table function over them; a source
without one is read by GENERAL. Parsers take bytes' text and never fetch.

Defined results: null and empty pages give no entry; a page in which no spec finds a text gives
none either; an entry without an address of its own has the page's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from corpusloom.functions.containers import cut_from, elements, tree, words_in
from corpusloom.functions.decode import repaired
from corpusloom.functions.richtext import Element, _markup, _subset, to_text
from corpusloom.functions.text import MONTH_NUMBERS

_MONTHS = "|".join(sorted(MONTH_NUMBERS, key=len, reverse=True))
#: Forms of dates in running text: ISO, day first with points, day and month in words, month first.
DATES = (
    (r"\b((?:19|20)\d{2})-(\d{2})-(\d{2})\b", (1, 2, 3)), (r"\b(\d{1,2})\.\s?(\d{1,2})\.\s?((?:19|20)\d{2})\b", (3, 2, 1)),
    (rf"\b(\d{{1,2}})(?:\.|st|nd|rd|th)?\s+({_MONTHS})\s+((?:19|20)\d{{2}})\b", (3, 2, 1)), (rf"\b({_MONTHS})\s+(\d{{1,2}}),?\s+((?:19|20)\d{{2}})\b", (3, 1, 2)),
    (rf"\b({_MONTHS})\s+((?:19|20)\d{{2}})\b", (2, 1, 0)),
)
ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "title", "date", "body", "body_html")] + [T.StructField("ord", T.IntegerType())])


@dataclass(frozen=True)
class Spec:
    """``container``: (tag, ((attribute, pattern), ...)), the densest such element is the article;
    ``title``: tags whose first one within it, or else on the page, is the title; ``until``: a
    pattern from which on the text is left out; ``split``: how a listing's container falls
    into entries: '' (no listing), 'heading', 'anchor', 'rule' or 'row'; ``dated``: only
    entries with a date count; ``dateline``: a title that runs into its date is cut there."""

    container: tuple[str, tuple[tuple[str, str], ...]] = ("body", ())
    title: tuple[str, ...] = ("h1", "h2", "h3")
    until: str = ""
    split: str = ""
    dated: bool = False
    dateline: bool = False


#: The article of self-marking pages, then the densest cell or box, then the page.
GENERAL = (Spec(("article", ())), Spec(("main", ())), Spec(("td", ())), Spec(("div", ())), Spec())
#: Source → its specs.
REGISTRY: dict[str, tuple[Spec, ...]] = {}


def register(source: str, *specs: Spec) -> None:
    REGISTRY[source] = specs


def date_in(text: str) -> tuple[str, int]:
    """(ISO date, or month, that comes first in a text; where), or ('', -1)."""
    low, best = text.lower(), ("", -1)
    for pattern, (y, m, d) in DATES:
        if (found := re.search(pattern, low)) and (best[1] < 0 or found.start() < best[1]):
            month = found[m] if found[m].isdigit() else str(MONTH_NUMBERS[found[m]])
            day = found[d] if d else ""
            if 1 <= int(month) <= 12 and (not d or 1 <= int(day) <= 31):
                best = ("-".join([found[y], month.zfill(2), *([day.zfill(2)] if d else [])]), found.start())
    return best


def _text_of(nodes: list) -> tuple[str, str]:
    """(body, body_html) of an article's nodes, as ``richtext.extracted`` makes them of a page."""
    markup = _markup(_subset(nodes))
    fixed, _ = repaired(markup)
    return to_text(fixed), fixed


_OPENS = {"heading": lambda n: n.tag in ("h1", "h2", "h3", "h4"), "anchor": lambda n: n.tag == "a" and n.attrs.get("name"), "rule": lambda n: n.tag == "hr"}


def _split(nodes: list, opens) -> list[list]:
    """Nodes cut before each element that opens an entry, wherever it lies; what encloses a cut
    is on either side of it."""
    out: list[list] = [[]]
    for n in nodes:
        if isinstance(n, Element) and opens(n):
            out.append([n])
        elif isinstance(n, Element) and len(inner := _split(n.children, opens)) > 1:
            for k, children in enumerate(inner):
                part = Element(n.tag, n.attrs)
                part.children = children
                if k:
                    out.append([])
                out[-1].append(part)
        else:
            out[-1].append(n)
    return out


def _pieces(container: Element, split: str) -> list[list]:
    """A listing's nodes by entry; of a table's rows the cells stand apart."""
    if split == "row":
        return [[x for cell in row.children if isinstance(cell, Element) for x in (*cell.children, Element("br"))] for row in elements(container, "tr")]
    return _split(container.children, _OPENS[split])


def _first(nodes: list, tags: tuple[str, ...]) -> str:
    holder = Element("div")
    holder.children = nodes
    for tag in tags:
        for e in elements(holder, tag):
            if text := words_in(e):
                return text
    return ""


def _entry(nodes: list, page: list, url: str, spec: Spec) -> dict | None:
    body, markup = _text_of(nodes)
    if not body:
        return None
    title = _first(nodes, spec.title) or (_first(page, spec.title) if not spec.split else "")
    date, _ = date_in(body)
    if spec.dateline and (cut := date_in(title))[1] > 0:
        title, date = title[: cut[1]].rstrip(" ,–-("), date or cut[0]
    if spec.dated and not date:
        return None
    own = url
    if spec.split:
        holder = Element("div")
        holder.children = nodes
        links = [e.attrs for e in elements(holder, "a")]
        if name := next((a["name"] for a in links if a.get("name")), ""):
            own = f"{url}#{name}"
        elif href := next((a["href"] for a in links if a.get("href")), ""):
            own = urljoin(url, href)
    return {"url": own, "title": title, "date": date, "body": body, "body_html": markup}


def entries(source: str | None, page: str | None, url: str) -> list[dict]:
    """The releases that a page holds, by the first of the source's specs that finds any."""
    if not page:
        return []
    for spec in REGISTRY.get(source or "", GENERAL):
        root = tree(page)
        found = elements(root, spec.container[0], dict(spec.container[1])) or ([root] if spec.container[0] == "body" else [])
        if not found:
            continue
        container = max(found, key=lambda e: len(words_in(e)))
        if spec.until:
            cut_from(container, re.compile(spec.until))
        pieces = _pieces(container, spec.split) if spec.split else [container.children]
        if made := [e for nodes in pieces if (e := _entry(nodes, root.children, url, spec))]:
            return made
    return []


@udtf(returnType=ENTRY)
class Parse:
    """``parse(source, page, url)``: a row an entry, for SQL and lateral joins."""

    def eval(self, source: str, page: str, url: str) -> Iterator[tuple]:
        for i, e in enumerate(entries(source, page, url)):
            yield e["url"], e["title"], e["date"], e["body"], e["body_html"], i


def parsed(pages: DataFrame, batch_key: str = "key") -> DataFrame:
    """(key, url, title, date, body, body_html, ord) of pages (key, source, page, url): the same in
    Arrow batches, for whole tables."""
    schema = f"{batch_key} string, " + ENTRY.simpleString()[7:-1].replace(":", " ")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *(e[c] for c in ("url", "title", "date", "body", "body_html")), i) for k, s, p, u in zip(batch[batch_key], batch["source"], batch["page"], batch["url"]) for i, e in enumerate(entries(s, p if isinstance(p, str) else None, u or ""))]
            if rows:
                yield pd.DataFrame(rows, columns=[batch_key, "url", "title", "date", "body", "body_html", "ord"])

    return pages.select(F.col(batch_key).cast("string").alias(batch_key), "source", "page", "url").mapInPandas(work, schema)


def candidate_bodies(pages: DataFrame) -> DataFrame:
    """(key, body, mine): every text that a source's parser sees in a page asked for a row's
    address (key, source, page, url, wanted); ``mine`` is the entry of that address, and the
    others count only where there is none."""
    found = parsed(pages)
    wanted = pages.select(F.col("key").cast("string").alias("key"), "wanted")
    rows = found.join(wanted, "key").select("key", "body", (F.col("url") == F.col("wanted")).alias("mine"))
    any_mine = rows.groupBy("key").agg(F.max("mine").alias("any_mine"))
    return rows.join(any_mine, "key").filter(F.col("mine") | ~F.col("any_mine")).select("key", "body", "mine")
