"""What can go wrong in a conversion, counted: interleaved copies in the text, structure lost in
the markup, words lost between the two, and the verdict that follows.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.containers import words_in
from corpusloom.functions.richtext import Element, _Tree

# Traces of interleaved copies (a pair of words twice, prices run together, a
# capital within a word) and of words rejoined with their blank; length under which a
# repeated text is furniture; retention a conversion needs, and that below which it is looked at;
# lines of a text from which a single block is degenerate; last place of a first heading.
TWICE, MERGED = re.compile(r"\b(\w+ \w+) \1\b", re.IGNORECASE), re.compile(r"\d{2,}\.\d{2}\.\w|\d{3,}\.\d{2}\.")
CAPITAL, REJOINED = re.compile(r"[a-z]{3}[A-Z][a-z]{2}"), re.compile(r"\w- (?!and\b|or\b|to\b|through\b)\w")
FURNITURE, RETAINED, LOOKED_AT, LINES, HEADING = 60, 0.90, 0.95, 10, 3


def artefacts(text: str) -> tuple[int, int, int]:
    words = text.split()
    return len(TWICE.findall(" ".join(words))), len(MERGED.findall(text)), sum(bool(CAPITAL.search(w)) for w in words)


def top_blocks(markup: str) -> list[Element]:
    return [c for c in _Tree(markup).root.children if isinstance(c, Element)]


def first_heading(markup: str) -> int:
    """Place of the first heading among the top blocks, or -1."""
    return next((i for i, b in enumerate(top_blocks(markup)) if b.tag == "h3"), -1)


def furniture(markup: str) -> int:
    """Surplus copies of short paragraphs and headings, as running headers leave them."""
    found: Counter[str] = Counter()
    todo = list(top_blocks(markup))
    while todo:
        n = todo.pop()
        if n.tag in ("p", "h3") and 0 < len(t := words_in(n)) < FURNITURE:
            found[t] += 1
        todo += [c for c in n.children if isinstance(c, Element)]
    return sum(n - 1 for n in found.values())


def retention(text: str, body: str) -> float:
    """Share of the text's words, with repeats, that the body has."""
    a, b = (Counter(re.findall(r"\w+", t.lower())) for t in (text, body))
    return sum((a & b).values()) / max(1, sum(a.values()))


_MEASURES = T.StructType(
    [T.StructField(n, T.DoubleType() if n == "retention" else T.IntegerType()) for n in ("retention", "blocks", "heading", "furniture", "rejoined", "twice", "merged", "capitals", "text_lines")]
)


@F.pandas_udf(_MEASURES)
def measure(texts: pd.Series, markups: pd.Series, bodies: pd.Series) -> pd.DataFrame:
    """All measures of a conversion: its plain text against its markup and the body of that."""
    rows = []
    for text, markup, body in zip(texts, markups, bodies):
        text, markup, body = (x if isinstance(x, str) else "" for x in (text, markup, body))
        rows.append((retention(text, body), len(top_blocks(markup)), first_heading(markup), furniture(markup), len(REJOINED.findall(body)), *artefacts(body), text.count("\n") + 1))
    return pd.DataFrame(rows, columns=_MEASURES.names)


def verdict(m: Column) -> Column:
    """passed; look (words missing, but few); degenerate (one block for many lines); refused."""
    return F.when((m["blocks"] <= 1) & (m["text_lines"] >= LINES), "degenerate").when(m["retention"] < RETAINED, "refused").when(m["retention"] < LOOKED_AT, "look").otherwise("passed")


def defect_counts(measured: DataFrame, column: str = "m") -> DataFrame:
    """One row: documents by defect."""
    m = F.col(column)
    sums = {"late_heading": F.count_if(m["heading"] > HEADING), "no_heading": F.count_if(m["heading"] < 0), "furniture": F.sum(m["furniture"]), "rejoined": F.sum(m["rejoined"]), "twice": F.sum(m["twice"]), "merged": F.sum(m["merged"]), "capitals": F.sum(m["capitals"])}
    return measured.agg(F.count("*").alias("documents"), *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in sums.items()])


def retention_histogram(measured: DataFrame, column: str = "m") -> DataFrame:
    """Documents by how many of their words the structured text kept."""
    r = F.col(column)["retention"]
    bucket = F.when(r < 0.5, "0.00").when(r < 0.9, "0.50").when(r < 0.95, "0.90").when(r < 0.99, "0.95").when(r < 1, "0.99").otherwise("1.00")
    return measured.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


_CARD = """<article><h2>{name}</h2><p class="verdict">{verdict} {retention:.1%}</p><section><pre>{text}</pre></section><section><pre>{body}</pre></section><section>{markup}</section></article>"""


def review_cards(rows: DataFrame) -> DataFrame:
    """(card): a document's plain text, the structured one and the markup side by side, for the
    eye; rows of (name, verdict, retention, text, body, body_html). Written as a text file."""
    import html

    @F.pandas_udf(T.StringType())
    def card(name: pd.Series, verdict: pd.Series, kept: pd.Series, text: pd.Series, body: pd.Series, markup: pd.Series) -> pd.Series:
        plain = lambda x: html.escape(x if isinstance(x, str) else "")
        return pd.Series([_CARD.format(name=plain(n), verdict=plain(v), retention=k or 0.0, text=plain(t), body=plain(b), markup=m or "").replace("\n", "&#10;") for n, v, k, t, b, m in zip(name, verdict, kept, text, body, markup)], dtype=object)

    return rows.select(card("name", "verdict", "retention", "text", "body", "body_html").alias("card"))
