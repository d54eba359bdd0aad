"""Full-text search: words, postings, an expression language, BM25, excerpts.

An expression is read into a tree of phrases; a phrase is found by lining its terms'
postings up (one shuffle by row), trees by joins on the row's id. A written index keeps
postings ordered by term, so a query reads the row groups of its own terms only; changes
are segments beside it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import ACCENTS, BARE, fold

#: BM25's parameters, the least IDF, and the deepest row that relevance paging reaches.
K1, B, LEAST_IDF, DEEPEST = 1.2, 0.75, 1e-6, 1000
COLUMNS = ("title", "body")
OPEN, CLOSE, ELLIPSIS, SNIPPET = ">>>", "<<<", "…", 24
_TOKEN = r"[\p{L}\p{N}\p{Co}][\p{L}\p{N}\p{M}\p{Co}]*"
_FOLD = str.maketrans(ACCENTS, BARE)
_PY_TOKEN = re.compile(r"[^\W_][^\W_̀-ͯ]*")


def tokens(text) -> Column:
    return F.regexp_extract_all(fold(F.coalesce(F.col(text), F.lit(""))), F.lit(_TOKEN), F.lit(0))


def terms_of(text: str) -> list[str]:
    """The same words, of an expression's short text."""
    return _PY_TOKEN.findall(text.lower().translate(_FOLD))


def postings(rows: DataFrame) -> DataFrame:
    """(term, id, col, pos) of every word of title (0) and body (1)."""
    parts = [rows.select("id", F.lit(i).alias("col"), F.posexplode(tokens(c)).alias("pos", "term")) for i, c in enumerate(COLUMNS)]
    return parts[0].unionByName(parts[1]).select("term", "id", "col", "pos")


def document_sizes(rows: DataFrame) -> DataFrame:
    return rows.select("id", (F.size(tokens("title")) + F.size(tokens("body"))).alias("len"))


@dataclass
class Index:
    """Postings (term, id, col, pos), sizes (id, len) and one row of totals (n, average)."""

    postings: DataFrame
    sizes: DataFrame
    totals: DataFrame


def index_of(rows: DataFrame) -> Index:
    """An index as a plan over the rows, written nowhere."""
    sizes = document_sizes(rows)
    return Index(postings(rows), sizes, totals_of(sizes))


def totals_of(sizes: DataFrame) -> DataFrame:
    return sizes.agg(F.count("*").alias("n"), F.avg("len").alias("average"))


_POSTINGS, _SIZES, _GONE = "term string, id long, col int, pos int, seg int", "id long, len int, seg int", "id long, seg int"


def _write(rows: DataFrame, gone: DataFrame | None, path: str, seg: int) -> None:
    """A segment: postings in order of term, so row groups hold few terms each."""
    postings(rows).repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{path}/postings/seg={seg}")
    document_sizes(rows).write.mode("overwrite").parquet(f"{path}/sizes/seg={seg}")
    (rows.select("id").limit(0) if gone is None else gone.select("id").distinct()).write.mode("overwrite").parquet(f"{path}/gone/seg={seg}")


def write_index(rows: DataFrame, path: str) -> None:
    """The index of all rows, in place of whatever the path held."""
    spark = rows.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _write(rows, None, path, 0)


def update_index(spark: SparkSession, path: str, changed: DataFrame, removed: DataFrame | None = None) -> None:
    """Rows that came or changed, and ids that went, as one more segment; what older segments
    hold of them is void from then on. Only the changed rows are read and written."""
    seg = 1 + spark.read.schema(_GONE).parquet(f"{path}/gone").agg(F.coalesce(F.max("seg"), F.lit(_segments(spark, path) - 1))).first()[0]
    gone = changed.select("id") if removed is None else changed.select("id").unionByName(removed.select("id"))
    _write(changed, gone, path, max(seg, _segments(spark, path)))


def _segments(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/postings")
    return len(where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where))


def open_index(spark: SparkSession, path: str) -> Index:
    """The index as its segments together make it."""
    gone = spark.read.schema(_GONE).parquet(f"{path}/gone").select(F.col("id").alias("g"), F.col("seg").alias("since"))

    def live(part: str, schema: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(f"{path}/{part}")
        if _segments(spark, path) > 1:
            rows = rows.join(gone, (F.col("id") == F.col("g")) & (F.col("seg") < F.col("since")), "left_anti")
        return rows.drop("seg")

    sizes = live("sizes", _SIZES)
    return Index(live("postings", _POSTINGS), sizes, totals_of(sizes))


def compacted(spark: SparkSession, path: str, to: str) -> None:
    """The index as one segment at another path."""
    index = open_index(spark, path)
    index.postings.repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{to}/postings/seg=0")
    index.sizes.write.mode("overwrite").parquet(f"{to}/sizes/seg=0")
    index.sizes.select("id").limit(0).write.mode("overwrite").parquet(f"{to}/gone/seg=0")


@dataclass
class Phrase:
    terms: list[str]
    prefix: bool = False
    columns: tuple[int, ...] = (0, 1)
    first: bool = False


@dataclass
class Node:
    kind: str  # AND, OR, NOT, NEAR
    parts: list = field(default_factory=list)
    distance: int = 10


class Syntax(ValueError):
    pass


_LEX = re.compile(r'\s*(?:("(?:[^"]|"")*")|([A-Za-z0-9_\x80-\U0010ffff\x1a]+)|([(){}:+*^,-]))')


def _lex(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while text[at:].strip():
        if not (m := _LEX.match(text, at)):
            raise Syntax(text)
        quoted, bare, mark = m.groups()
        out.append(("string", quoted[1:-1].replace('""', '"')) if quoted is not None else ("word", bare) if bare else (mark, mark))
        at = m.end()
    return out


class Parser:
    """OR < AND < NOT < words side by side; phrases, prefixes, columns, ^, +, NEAR()."""

    def __init__(self, text: str) -> None:
        self.t, self.i = _lex(text), 0

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.t[self.i + ahead] if self.i + ahead < len(self.t) else ("end", "")

    def take(self, kind: str) -> str:
        if self.peek()[0] != kind:
            raise Syntax(kind)
        self.i += 1
        return self.t[self.i - 1][1]

    def is_word(self, word: str) -> bool:
        return self.peek() == ("word", word)

    def parse(self):
        tree = self.either()
        if self.peek()[0] != "end":
            raise Syntax("rest")
        return tree

    def _chain(self, word: str, below):
        parts = [below()]
        while self.is_word(word):
            self.i += 1
            parts.append(below())
        if len(parts) == 1:
            return parts[0]
        return reduce(lambda a, b: Node(word, [a, b]), parts) if word == "NOT" else Node(word, parts)

    def either(self):
        return self._chain("OR", self.both)

    def both(self):
        return self._chain("AND", self.without)

    def without(self):
        return self._chain("NOT", self.side_by_side)

    def side_by_side(self):
        parts = [self.unit()]
        while self.peek()[0] in ("string", "word", "{", "^", "-") and not any(map(self.is_word, ("AND", "OR", "NOT"))):
            if self.peek()[0] == "-" or isinstance(parts[-1], Node) and parts[-1].kind in ("OR", "AND", "NOT") and getattr(parts[-1], "closed", False):
                raise Syntax("side by side")
            parts.append(self.unit())
        return parts[0] if len(parts) == 1 else Node("AND", parts)

    def columns(self) -> tuple[int, ...] | None:
        start, negative = self.i, False
        if self.peek()[0] == "-":
            negative, self.i = True, self.i + 1
        names: list[str] = []
        if self.peek()[0] == "{":
            self.i += 1
            while self.peek()[0] in ("word", "string"):
                names.append(self.take(self.peek()[0]))
            self.take("}")
        elif self.peek()[0] in ("word", "string") and self.peek(1)[0] == ":":
            names.append(self.take(self.peek()[0]))
        if not names or self.peek()[0] != ":":
            if negative or self.i != start:
                raise Syntax("columns")
            return None
        self.take(":")
        if any(n.lower() not in COLUMNS for n in names):
            raise Syntax("no such column")
        mine = {COLUMNS.index(n.lower()) for n in names}
        return tuple(sorted({0, 1} - mine if negative else mine))

    def unit(self):
        columns = self.columns()
        if self.peek()[0] == "(":
            self.i += 1
            tree = self.either()
            self.take(")")
            if isinstance(tree, Node):
                tree.closed = True
        elif self.is_word("NEAR") and self.peek(1)[0] == "(":
            self.i += 2
            parts = [self.phrase()]
            while self.peek()[0] in ("string", "word", "^"):
                parts.append(self.phrase())
            distance = 10
            if self.peek()[0] == ",":
                self.i += 1
                number = self.take("word")
                if not number.isdigit():
                    raise Syntax("NEAR")
                distance = int(number)
            self.take(")")
            tree = Node("NEAR", parts, distance)
        else:
            tree = self.phrase()
        if columns is not None:
            for phrase in phrases(tree):
                phrase.columns = tuple(c for c in phrase.columns if c in columns)
        return tree

    def phrase(self) -> Phrase:
        first = self.peek()[0] == "^"
        self.i += first
        if self.peek()[0] not in ("string", "word") or any(map(self.is_word, ("AND", "OR", "NOT"))):
            raise Syntax("phrase")
        out = Phrase(terms_of(self.take(self.peek()[0])), first=first)
        while self.peek()[0] == "+":
            self.i += 1
            if self.peek()[0] not in ("string", "word"):
                raise Syntax("+")
            out.terms += terms_of(self.take(self.peek()[0]))
        if self.peek()[0] == "*":
            self.i, out.prefix = self.i + 1, True
        return out


def phrases(tree) -> list[Phrase]:
    return [tree] if isinstance(tree, Phrase) else [p for part in tree.parts for p in phrases(part)]


def read(text: str) -> tuple[object, str]:
    """(tree, mode): the expression, or the whole text as one phrase if it is none."""
    try:
        return Parser(text).parse(), "raw"
    except Syntax:
        return Phrase(terms_of(text)), "literal"


def phrase_places(index: DataFrame, phrase: Phrase) -> DataFrame:
    """(id, col, start) of each place of a phrase."""
    n = len(phrase.terms)
    if not n or not phrase.columns:
        return index.select("id", "col", F.col("pos").alias("start")).limit(0)
    conditions = []
    for k, term in enumerate(phrase.terms):
        is_it = F.col("term").startswith(term) if phrase.prefix and k == n - 1 else F.col("term") == term
        conditions.append((k, is_it))
    rows = index.filter(reduce(lambda a, b: a | b, [c for _, c in conditions])).filter(F.col("col").isin(*phrase.columns))
    places = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions]))
    rows = rows.select("id", "col", "pos", F.explode(places).alias("k")).select("id", "col", (F.col("pos") - F.col("k")).alias("start"))
    if n > 1:
        rows = rows.groupBy("id", "col", "start").agg(F.count("*").alias("n")).filter(F.col("n") == n).select("id", "col", "start")
    return rows.filter("start = 0") if phrase.first else rows


def matches(index: DataFrame, tree) -> DataFrame:
    """(id) of the rows that the expression holds for."""
    if isinstance(tree, Phrase):
        return phrase_places(index, tree).select("id").distinct()
    if tree.kind == "NEAR":
        base, reach = phrase_places(index, tree.parts[0]), tree.distance
        for part in tree.parts[1:]:
            size = len(part.terms)
            other = phrase_places(index, part).select("id", "col", F.col("start").alias("s2"))
            base = base.join(other, ["id", "col"]).filter((F.col("s2") - F.col("start") - len(tree.parts[0].terms) <= reach) & (F.col("start") - F.col("s2") - size <= reach)).select("id", "col", "start").distinct()
        return base.select("id").distinct()
    parts = [matches(index, p) for p in tree.parts]
    if tree.kind == "OR":
        return reduce(DataFrame.unionByName, parts).distinct()
    return reduce(lambda a, b: a.join(b, "id", "left_anti" if tree.kind == "NOT" else "left_semi"), parts)


def bm25(index: Index, tree) -> DataFrame:
    """(id, score) of the matching rows; the lower, the better. Ties are open; order by id.

    One plan: how many rows hold a phrase is joined in, a row a phrase, and the corpus'
    totals are scalar subqueries."""
    parts = [phrase_places(index.postings, p).groupBy("id").agg(F.count("*").alias("f")).select(F.lit(k).alias("p"), "id", "f") for k, p in enumerate(phrases(tree))]
    hits = reduce(DataFrame.unionByName, parts)
    n, average = (index.totals.select(c).scalar() for c in ("n", "average"))
    held = hits.groupBy("p").agg(F.count("*").alias("df"))
    idf = F.ln((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    held = held.select("p", F.when(idf > 0, idf).otherwise(F.lit(LEAST_IDF)).alias("idf"))
    found = hits.select("id").distinct() if isinstance(tree, Phrase) else matches(index.postings, tree)
    scored = hits.join(found, "id", "left_semi").join(index.sizes, "id").join(F.broadcast(held), "p")  # a row a phrase of the expression
    part = F.col("idf") * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("len") / F.coalesce(average, F.lit(1.0))))
    return scored.groupBy("id").agg((-F.sum(part)).alias("score"))


def top(index: Index, text: str, limit: int = 8, offset: int = 0) -> DataFrame:
    """The best rows of an expression, to DEEPEST rows deep; none from there on."""
    tree, _ = read(text)
    best = bm25(index, tree).orderBy("score", "id")
    return best.offset(offset).limit(max(0, min(limit, DEEPEST - offset)))


def snippet_of(text: str | None, tree) -> str:
    """A stretch of at most SNIPPET words around most of the phrases' places, those marked."""
    text = text or ""
    spans = [(m.start(), m.end(), m.group().translate(_FOLD)) for m in _PY_TOKEN.finditer(text.lower())] if len(text.lower()) == len(text) else [(m.start(), m.end(), m.group().lower().translate(_FOLD)) for m in _PY_TOKEN.finditer(text)]
    places = []
    for p in phrases(tree):
        n = len(p.terms)
        if n and 1 in p.columns:
            for i in range(len(spans) - n + 1):
                if all(spans[i + k][2].startswith(t) if p.prefix and k == n - 1 else spans[i + k][2] == t for k, t in enumerate(p.terms)):
                    places.append((i, i + n))
    places.sort()
    start = max((max(0, min(a - 2, len(spans) - SNIPPET)) for a, _ in places), key=lambda s: (sum(a >= s and b <= s + SNIPPET for a, b in places), -s), default=0)
    stop = min(len(spans), start + SNIPPET)
    if not spans:
        return text[:200]
    out, at = [ELLIPSIS if start else ""], spans[start][0] if start else 0
    for a, b in [p for p in places if p[0] >= start and p[1] <= stop]:
        if spans[a][0] >= at:
            out += [text[at : spans[a][0]], OPEN, text[spans[a][0] : spans[b - 1][1]], CLOSE]
            at = spans[b - 1][1]
    out.append(text[at : spans[stop - 1][1] if stop < len(spans) else len(text)])
    return "".join(out) + (ELLIPSIS if stop < len(spans) else "")


def with_snippet(page: DataFrame, text: str) -> DataFrame:
    """A page of hits (bounded by its limit) with its excerpts."""
    tree, _ = read(text)

    @F.pandas_udf(T.StringType())
    def snippets(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: snippet_of(b, tree))

    return page.withColumn("snippet", snippets(F.col("body").cast("string")))


def excerpt_parts(snippet) -> Column:
    return F.split(snippet, f"{OPEN}|{CLOSE}")


def orphans(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Indexed ids that no row has (a stale index)."""
    return index.select("id").distinct().join(rows.select("id"), "id", "left_anti")


def missing(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with words that the index doesn't have."""
    return document_sizes(rows).filter("len > 0").select("id").join(index.select("id").distinct(), "id", "left_anti")
