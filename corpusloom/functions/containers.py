"""Where an article is in a page: the element whose text covers a stored body, a shape that a
selector could name it by, the densest element of a kind, and cuts at a marker.

Works on the tree of ``richtext``. Defined results: no page, no body or a body under forty
characters is located nowhere.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.richtext import Element, _Tree

#: Attributes that a shape names; characters of a body that anchor it; share of
#: a body that its element must hold.
NAMED, ANCHOR, LEAST = ("id", "class", "valign", "width", "align", "border"), 40, 0.75


def tree(source: str) -> Element:
    return _Tree(source).root


def shape(element: Element) -> str:
    """An element's tag with the attributes that tell it apart."""
    marks = [f'{a}="{" ".join(element.attrs[a].split())}"' for a in NAMED if element.attrs.get(a)]
    return f"{element.tag}[{' '.join(marks)}]" if marks else element.tag


def path(ancestors: list[Element], depth: int = 3) -> str:
    """The shapes of the nearest ancestors, nearest first; ``ancestors`` from the root down."""
    return " < ".join(shape(a) for a in ancestors[::-1][:depth])


def words_in(node) -> str:
    """A node's text, runs of white space as single blanks."""
    parts: list[str] = []
    todo = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            parts.append(n)
        else:
            todo += reversed(n.children)
    return " ".join(" ".join(parts).split())


def located(source: str | None, body: str | None) -> tuple[str, str, float] | None:
    """(shape, path, coverage) of the smallest element that holds the middle of a body and at
    least LEAST of its length, else of the largest that holds its middle."""
    flat = " ".join((body or "").split())
    middle = len(flat) // 2
    anchor = flat[max(0, middle - ANCHOR) : middle + ANCHOR]
    if len(anchor) < ANCHOR or not source:
        return None
    best = widest = None
    todo: list[tuple[Element, list[Element]]] = [(c, []) for c in tree(source).children if isinstance(c, Element)]
    while todo:
        element, above = todo.pop()
        text = words_in(element)
        if anchor not in text:
            continue  # nor can anything inside hold it
        found = (len(text), element, above)
        widest = found if widest is None or found[0] > widest[0] else widest
        if len(text) >= LEAST * len(flat) and (best is None or len(text) < best[0]):
            best = found
        todo += [(c, [*above, element]) for c in element.children if isinstance(c, Element)]
    if (taken := best or widest) is None:
        return None
    return shape(taken[1]), path(taken[2]), taken[0] / len(flat)


def elements(root: Element, tag: str, attrs: dict[str, str] | None = None) -> list[Element]:
    """Elements of a kind in the order of the page; ``attrs``: patterns their attributes hold."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag == tag and all(re.search(p, n.attrs.get(a) or "") for a, p in (attrs or {}).items()):
            out.append(n)
        todo += [c for c in reversed(n.children) if isinstance(c, Element)]
    return out


def densest(root: Element, tag: str, attrs: dict[str, str] | None = None) -> Element | None:
    """The element of a kind with most text; the first of equals."""
    return max(elements(root, tag, attrs), key=lambda e: len(words_in(e)), default=None)


def cut_from(root: Element, pattern: re.Pattern) -> bool:
    """Drop all from the first place where a text node matches; True if there was one."""
    for i, child in enumerate(root.children):
        if isinstance(child, str):
            if m := pattern.search(child):
                root.children[i:] = [child[: m.start()]]
                return True
        elif cut_from(child, pattern):
            del root.children[i + 1 :]
            return True
    return False


_LOCATED = T.StructType([T.StructField("shape", T.StringType()), T.StructField("path", T.StringType()), T.StructField("coverage", T.DoubleType())])


@F.pandas_udf(_LOCATED)
def locate(sources: pd.Series, bodies: pd.Series) -> pd.DataFrame:
    rows = [located(s, b) or (None, None, None) for s, b in zip(sources, bodies)]
    return pd.DataFrame(rows, columns=["shape", "path", "coverage"])


def report(found: DataFrame, top: int = 4) -> DataFrame:
    """A row a source of (source, shape, path, coverage): captures, those located, the commonest
    shapes and path, and the least, upper median and greatest coverage."""
    sums = found.groupBy("source").agg(
        F.count("*").alias("captures"), F.count("shape").alias("located"), F.min("coverage").alias("least"), F.max("coverage").alias("most"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY coverage)").alias("median"),
    )

    def commonest(column: str, n: int) -> DataFrame:
        counted = found.filter(F.col(column).isNotNull()).groupBy("source", column).agg(F.count("*").alias("n"))
        ranked = counted.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), column))).filter(F.col("k") <= n)
        return ranked.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", column, "n"))), lambda x: F.concat(x[column], F.lit(" "), x["n"].cast("string"))).alias(f"top_{column}"))

    return sums.join(commonest("shape", top), "source", "left").join(commonest("path", 1), "source", "left")
