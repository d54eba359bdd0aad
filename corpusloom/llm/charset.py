"""Garbled text from wrong character encodings (problem 2).

A character-plausibility cost in bits is learned from all bodies and documents: how often a
character outside ASCII stands between its two neighbours. Words that cost too much are
put through a best-first search over encode, decode and unescape steps: the open state of
least cost is taken next, states seen are kept in a hash set, and the cheapest text reached
is the repair. Bytes of pages are read by each known charset, those of ideographs
included, and the cheapest reading is taken for the text as it was written.

Defined results: null and empty texts cost nothing and are never garbled; U+FFFD stays, as
what it replaced is lost, but marks the text as garbled; a null or unknown charset counts
as UTF-8.
"""

from __future__ import annotations

import base64
import codecs
import heapq
import html
import math
import quopri
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import spread, table

#: Charsets that bytes may have been in, or been taken for.
CHARSETS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "koi8-r", "iso8859-5", "cp437", "cp850", "cp852", "cp866", "mac-roman", "mac-latin2")
#: Charsets that UTF-8 was taken for, beside those.
RARER = ("cp1253", "cp1254", "cp1257", "cp1258", "iso8859-15", "mac-cyrillic")
#: Contexts with less than this share of all are left out of the model, so it has at most 500,000 entries at any size.
LEAST_SHARE = 2e-6
#: Charsets that tools take unknown bytes for; a text read as one of the others is rarer.
USUAL = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "koi8-r", "mac-roman")
#: Bits: what a step costs (a step between two single-byte charsets that starts from a rare
#: one costs RARE more), what a repair must gain, what it must gain against words of its
#: own line that are sound, and from where on a word is looked at.
STEP, RARE, GAIN, AGAINST, ODD = 2.5, 3.0, 5.5, 25.0, 14.0
#: Bits that a stretch of a line must gain as a whole if sound words stand beside it.
STRETCH = 9.0
#: Bits over the best text from which a state isn't opened any more, bits over its parent at
#: most for a state reached through UTF-8 or an escape, and bits under it at least for one
#: reached between single-byte charsets (any text could be reached by a few of those).
OVER, WORSE, BETTER = 30.0, 12.0, 12.0
#: Bits for each place where Latin and Cyrillic letters touch, and for an ideograph unseen.
MIXED, IDEOGRAPH = 6.0, 20.0
#: Records that are worked on at a time; words, and odd and repaired ones, that a task keeps.
PART, WORDS_KEPT, REPAIRS_KEPT = 500, 100_000, 50_000
#: Charsets of ideographs, tried where bytes are in none of the above; all are read strictly.
IDEOGRAPHIC = ("shift_jis", "euc-jp", "gb18030", "big5", "euc-kr")

_MODELLED = re.compile("[\x80-\u04ff\u2000-\u2bff\ufb00-\ufb06\ufffd]")
_ESCAPED = re.compile(  # each alternative looks back at the mark that the search runs for
    r"[&+=%\\](?:(?<=&)(?:amp;#?\w+;|#?\w{2,8};)|(?<=\+)[A-Za-z0-9+/]{3,}-|(?<==)[0-9A-F]{2}(?:=[0-9A-F]{2})+"
    r"|(?<=%)[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2})+|(?<=\\)(?:u[0-9a-fA-F]{4}|x[89a-fA-F][0-9a-fA-F]))"
)
_TOUCH = re.compile("[A-Za-z\u00c0-\u024f][\u0400-\u04ff]|[\u0400-\u04ff][A-Za-z\u00c0-\u024f]")
_IDEOGRAPH = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
_SURE = re.compile("[\x80-\x9f\ufffd\u2500-\u259f]|[\u00c3\u00c2\u0102\u00e2\u00d0\u00d1\u00ce][\x80-\xbf\u0152-\u0178\u02c6-\u2122]")


def _kind(c: str) -> str:
    """A context's neighbour, with what doesn't matter folded."""
    if c < "\x80":
        return c if c.isalpha() else "0" if c.isdigit() else " " if c.isspace() else c
    return c if _MODELLED.match(c) else "*"


def _split(text: str) -> list[str]:
    for c in '\n\t\r<>"':
        text = text.replace(c, " ")
    return text.split(" ")


_APART = ' \n\t\r<>"'


def _escaped_words(text: str) -> set[str]:
    """The words between blanks that hold an escape; an escape holds no blank itself."""
    out, end = set(), 0
    for m in _ESCAPED.finditer(text):
        if m.start() >= end:
            start = 1 + max(text.rfind(c, end, m.start()) for c in _APART)
            ends = [i for c in _APART if (i := text.find(c, m.end())) >= 0]
            start, end = max(start, end), min(ends, default=len(text))
            out.add(text[start:end])
    return out


def _words(text: str) -> list[str]:
    """The words between blanks that hold anything outside ASCII (other white space, which
    may be part of a garbled sequence, stays inside)."""
    return [w for w in _split(text) if not w.isascii()]


def _contexts(word: str) -> list[tuple[str, str, str]]:
    """(before, character, after) of each modelled character; beside a mark at a word's edge any letter will do."""
    framed, out = f" {word} ", []
    for m in _MODELLED.finditer(framed):
        i = m.start()
        before, c, after = framed[i - 1 : i + 2]
        if not c.isalpha() and not (before.isalpha() and after.isalpha()):
            before, after = "a" if before.isalpha() else before, "a" if after.isalpha() else after
        out.append((before, c, after))
    return out


def count_contexts(texts: DataFrame) -> DataFrame:
    """(context, n) over the single text column; each task sums up before the shuffle."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        words: Counter[str] = Counter()

        def flush() -> None:
            for word, n in words.items():
                for c in _IDEOGRAPH.findall(word):
                    total["\0" + c] += n
                for before, c, after in _contexts(word):
                    total[_kind(before) + c + _kind(after)] += n
            words.clear()

        for batch in batches:
            for text in batch.iloc[:, 0].dropna():
                if not text.isascii():
                    words.update(_words(text))
                if len(words) > 100_000:
                    flush()
            if len(total) > 300_000:
                yield pd.DataFrame({"context": list(total), "n": list(total.values())})
                total.clear()
        flush()
        if total:
            yield pd.DataFrame({"context": list(total), "n": list(total.values())})

    return texts.mapInPandas(counts, "context string, n long").groupBy("context").agg(F.sum("n").alias("n"))


class Plausibility:
    """Bits that a text costs; learned by ``learn``, sent to the tasks once by broadcast."""

    def __init__(self, counts: dict[str, int]) -> None:
        seen = {key[1]: n for key, n in counts.items() if len(key) == 2}
        counts = {key: n for key, n in counts.items() if len(key) == 3}
        every = max(sum(seen.values()), 1)
        self.ideographs = {c: min(IDEOGRAPH, math.log2(every / n)) for c, n in seen.items()}
        total = max(sum(counts.values()), 1)
        self.three: dict[str, float] = {}
        self.left: dict[str, float] = {}
        self.right: dict[str, float] = {}
        self.one: dict[str, float] = {}
        for key, n in counts.items():
            share = n * 1e6 / total
            for to, k in ((self.three, key), (self.left, key[:2]), (self.right, key[1:]), (self.one, key[1])):
                to[k] = to.get(k, 0) + share
        #: The least that a character can cost, wherever it stands.
        self.floor = {c: math.log2(1e6 / (1.0303 * share + 0.02)) for c, share in self.one.items()}
        self.floor = {c: min(bits, 1.5 + self.floor.get(c.lower(), 25.5)) for c, bits in self.floor.items()}
        self._words: dict[str, float] = {}
        self._odd: dict[str, bool] = {}
        self._repairs: dict[str, tuple[str, float, tuple[str, ...]]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": {}, "_repairs": {}, "_odd": {}}

    def character(self, before: str, c: str, after: str) -> float:
        """Bits of one character between two; what the model knows nothing of costs most."""
        before, after = _kind(before), _kind(after)
        sides = min(self.left.get(before + c, 0), self.right.get(c + after, 0))
        bits = math.log2(1e6 / (self.three.get(before + c + after, 0) + 0.03 * sides + 0.0003 * self.one.get(c, 0) + 0.02))
        if bits > 8 and c.isupper() and (before.isupper() or after.isupper()) and len(c.lower()) == 1:
            return min(bits, 1.5 + self.character(before.lower(), c.lower(), after.lower()))
        return bits

    def word(self, word: str) -> float:
        """Bits of a word between blanks."""
        if (cost := self._words.get(word)) is None:
            if len(self._words) > WORDS_KEPT:
                self._words.clear()
            cost = sum(self.character(*x) for x in _contexts(word)) + sum(22.0 for c in word if c > "\u04ff" and not _MODELLED.match(c))
            cost += sum(12.0 for m in _ESCAPED.finditer(word) if not _unescaped(m.group()).isascii()) + MIXED * len(_TOUCH.findall(word))
            self._words[word] = cost
        return cost

    def least(self, word: str) -> float:
        """A bound from below of a word's cost."""
        floor, total = self.floor, 0.0
        for c in word:
            if c > "\x7f":
                total += floor.get(c) or (1.5 + floor.get(c.lower(), 20.0) if c.isupper() else 22.0)
        return total

    def odd(self, word: str) -> bool:
        """True if the word is worth a search."""
        if (odd := self._odd.get(word)) is None:
            if len(self._odd) > WORDS_KEPT:
                self._odd.clear()
            odd = bool(_SURE.search(word)) or any(self.character(*x) > ODD for x in _contexts(word)) or (self.word(word) >= 12 and bool(_ESCAPED.search(word)))
            self._odd[word] = odd
        return odd

    def repair(self, word: str) -> tuple[str, float, tuple[str, ...]]:
        """The cheapest text reached from ``word``, the bits gained, the steps."""
        if (found := self._repairs.get(word)) is None:
            if len(self._repairs) > REPAIRS_KEPT:
                self._repairs.clear()
            found = self._repairs[word] = self._search(word)
        return found

    def _search(self, word: str) -> tuple[str, float, tuple[str, ...]]:
        """Opens the cheapest state first until none is left that may lead on. Every state is
        opened once at most, and each step into the heap makes the text shorter (UTF-8,
        escapes) or much cheaper (single bytes), so the search ends by itself."""
        start = self.word(word)
        best, seen, tick = (start, word, ()), {word}, 0
        heap: list[tuple[float, int, str, tuple[str, ...], float]] = [(start, 0, word, (), 0.0)]
        while heap:
            cost, _, text, steps, paid = heapq.heappop(heap)
            if cost > best[0] + OVER:
                break
            for step, price, reached in _steps(text):
                if reached in seen:
                    continue
                through = _multibyte(step)
                if not through and paid + price + self.least(reached) >= max(best[0], cost - BETTER):
                    continue  # neither the cheapest nor one that leads on
                seen.add(reached)
                child = self.word(reached) + paid + price
                if child < best[0]:
                    best = (child, reached, (*steps, step))
                if child < (cost + WORSE if through else cost - BETTER):
                    tick += 1
                    heapq.heappush(heap, (child, tick, reached, (*steps, step), paid + price))
        return best[1], start - best[0], best[2]

    def passage(self, words: list[str], steps: tuple[str, ...]) -> float:
        """Most bits gained if a stretch of a line's words, in order, went through steps between
        single-byte charsets as a whole."""
        best = here = 0.0
        for word in words:
            text: str | None = word
            for step in steps:
                name, _, other = step.partition(">")
                data = None if _multibyte(step) else _table(name)[1](text)
                if data is None:
                    text = None
                    break
                text = _table(other)[2](data)
            here = 0.0 if text is None else max(0.0, here + self.word(word) - self.word(text))
            best = max(best, here)
        return best - STEP

    def mend(self, text: str | None) -> tuple[str | None, bool]:
        """The text with its garbled words restored where possible, and whether it is garbled."""
        if not text or (text.isascii() and not _ESCAPED.search(text)):
            return text, False
        words = {*_words(text)}
        if _ESCAPED.search(text):
            words |= _escaped_words(text)
        gains: dict[str, str] = {}
        doubtful: dict[str, tuple[str, float, tuple[str, ...]]] = {}
        for word in words:
            if self.odd(word):
                to, gain, steps = self.repair(word)
                if gain >= GAIN and to != word:
                    if _multibyte(steps[-1]) or _SURE.search(word) or gain >= AGAINST:
                        gains[word] = to
                    else:
                        doubtful[word] = (to, gain, steps)
        if doubtful:  # a wrong single-byte charset garbles whole stretches, so sound words beside speak against it
            for line in text.split("\n"):
                order = [w for w in _words(line) if w not in gains]
                here = {*order}
                if found := here & doubtful.keys():
                    if len(found) > len(here - found):
                        gains |= {w: doubtful[w][0] for w in found}
                        continue
                    for steps in {doubtful[w][2] for w in found}:
                        if self.passage(order, steps) >= STRETCH:
                            gains |= {w: doubtful[w][0] for w in found if doubtful[w][2] == steps}
        if gains:
            pattern = re.compile("|".join(map(re.escape, sorted(gains, key=len, reverse=True))))
            return pattern.sub(lambda m: gains[m.group()], text), True
        return text, "\ufffd" in text

    def read(self, content: bytes | None) -> tuple[str, str]:
        """Bytes as the text they were written as, and the charset."""
        if not content:
            return "", "utf-8"
        if content.isascii():
            return content.decode("ascii"), "utf-8"
        try:
            return content.decode("utf-8"), "utf-8"
        except UnicodeDecodeError:
            pass
        if content[:2] in (b"\xff\xfe", b"\xfe\xff") or content[:400].count(0) * 3 > len(content[:400]):
            name = "utf-16" if content[:2] in (b"\xff\xfe", b"\xfe\xff") else "utf-16-le" if content[1:400:2].count(0) > content[:400:2].count(0) else "utf-16-be"
            return content.decode(name, "replace"), name
        some = b" ".join(re.findall(rb"[^\s<>&;\"=]*[\x80-\xff][^\s<>&;\"=]*", content))
        cost = {}
        for name in CHARSETS:
            try:
                words = some.decode(name).split(" ")
            except UnicodeDecodeError:
                words = _table(name)[2](some).split(" ")
            cost[name] = sum(map(self.word, words))
        name = min(CHARSETS, key=cost.get)
        if self.ideographs:
            for other in IDEOGRAPHIC:
                try:
                    read = content.decode(other)
                except UnicodeDecodeError:
                    continue
                bits = self.ideographic(read)
                if bits < cost[name]:
                    cost[other], name = bits, other
        try:
            return content.decode(name), name
        except UnicodeDecodeError:
            return _table(name)[2](content), name

    def ideographic(self, text: str) -> float:
        """Bits of a text's characters outside ASCII, ideographs by how often the corpus has each;
        one that stands alone between other letters is no text."""
        bits = 0.0
        for run in re.findall(r"[^\x00-\x7f]+", text):
            found = _IDEOGRAPH.findall(run)
            bits += sum(self.ideographs.get(c, IDEOGRAPH) for c in found) + (IDEOGRAPH if len(found) == 1 else 0.0)
            bits += sum(self.word(w) for w in _IDEOGRAPH.sub(" ", run).split(" ") if w)
        return bits


@lru_cache(maxsize=64)
def _table(name: str):
    """(char → byte, as a translation), the decode and encode of a single-byte charset in
    which an undefined byte stands for the control character of its number."""
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            chars.append(chr(b))
    to_byte = {c: b for b, c in reversed([*enumerate(chars)])}
    if name == "cp1252":
        to_byte |= {chr(b): b for b in range(0x80, 0xA0)}
    decoding = "".join(chars)

    def encode(text: str) -> bytes | None:
        try:
            return bytes([to_byte[c] for c in text])
        except KeyError:
            return None

    return to_byte, encode, lambda data: codecs.charmap_decode(data, "strict", decoding)[0]


def _unescaped(text: str) -> str:
    """Character references, quoted-printable, percent, backslash and UTF-7 escapes read."""
    if "&" in text:
        return html.unescape(html.unescape(text))
    try:
        if "\\" in text:
            return re.sub(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})", lambda m: chr(int(m[1] or m[2], 16)), text)
        if "+" in text:
            def read(m: re.Match) -> str:
                data = base64.b64decode(m[1] + "=" * (-len(m[1]) % 4))
                return data.decode("utf-16-be") if len(data) % 2 == 0 else m[0]
            return re.sub(r"\+([A-Za-z0-9/]+)-", read, text)
        if "=" in text:
            return quopri.decodestring(text.encode("latin-1")).decode("utf-8")
        if "%" in text:
            return unquote_to_bytes(text).decode("utf-8")
    except (ValueError, UnicodeError):
        pass
    return text


def _multibyte(step: str) -> bool:
    return step.endswith(("utf-8", "unescape"))


def _steps(text: str) -> Iterator[tuple[str, float, str]]:
    """The states one step away, with the step's name and price."""
    if _ESCAPED.search(text):
        if not (reached := _unescaped(text)).isascii():
            yield "unescape", STEP, reached
    if text.isascii():
        return
    for name in (*CHARSETS, *RARER):
        data = _table(name)[1](text)
        if data is None:
            continue
        try:
            yield f"{name}>utf-8", STEP, data.decode("utf-8")
            continue  # what reads as UTF-8 is UTF-8
        except UnicodeDecodeError:
            pass
        if name in RARER:
            continue
        for other in CHARSETS:
            if other != name:
                reached = _table(other)[2](data)
                if reached != text:
                    yield f"{name}>{other}", STEP + RARE * (name not in USUAL), reached


def learn(spark: SparkSession, sf_dir: str) -> Plausibility:
    """The model over every body and every document's text. Pages have no share in it: which
    charset they are in is what the model is asked for, and mirrors repeat their damage.

    What comes to the driver is bounded at any size: a context needs LEAST_SHARE of all.
    """
    texts = spread(table(spark, sf_dir, "releases").select(F.col("body").alias("t"))).unionByName(spread(table(spark, sf_dir, "documents").select(F.col("text").alias("t"))))
    counts = count_contexts(texts)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()  # its shuffle is the one of the counts
    rows = counts.filter(F.col("n") >= F.greatest(F.lit(1), F.ceil(total * LEAST_SHARE))).collect()
    return Plausibility({r["context"]: r["n"] for r in rows})


#: Names under which charsets are known beside Python's own.
ALIASES = {"x-mac-roman": "mac-roman", "macintosh": "mac-roman", "unicode-1-1-utf-8": "utf-8", "x-sjis": "shift_jis"}


def strict(content: bytes, charset: str | None) -> str | None:
    """The bytes read strictly by ``charset``; None where they can't be."""
    name = (charset or "utf-8").strip().lower()
    try:
        return content.decode(ALIASES.get(name, name))
    except LookupError:
        return strict(content, None)
    except UnicodeDecodeError:
        return None


def is_html(content: bytes | None, kind: str | None) -> bool:
    """Pages: by the leading bytes where they tell, else by the declared type."""
    head = (content or b"")[:16].lstrip().lower()
    if head.startswith((b"%pdf", b"\xd0\xcf\x11\xe0", b"{\\rtf", b"pk\x03\x04", b"\x89png", b"\xff\xd8", b"gif8")):
        return False
    return head.startswith(b"<") or kind is None or "html" in kind.lower() or kind.lower().startswith("text/")


def garbled_page(model: Plausibility, content: bytes, charset: str | None) -> tuple[str, bool]:
    """The text of a page as it was written, mended, and whether it is a case."""
    text, _ = model.read(content)
    read = strict(content, charset)
    mended, garbled = model.mend(resolved(text))
    return mended, garbled or read != text


_REFERENCE = re.compile(r"&(?:#[0-9]{2,7}|#[xX][0-9a-fA-F]{2,6}|[A-Za-z][A-Za-z0-9]{1,30});")


def resolved(source: str) -> str:
    """A page's source with the character references outside ASCII read; markup stays as it is,
    and so does the number of lines."""

    def read(m: re.Match) -> str:
        c = html.unescape(m.group())
        return m.group() if c.isascii() or c.isspace() else c

    return _REFERENCE.sub(read, source) if "&" in source else source


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches in parts of PART records, so what is made of them is small at any time."""
    for batch in batches:
        for at in range(0, len(batch), PART):
            yield batch.iloc[at : at + PART]


def read_records(spark: SparkSession, sf_dir: str, model=None, columns: str = "text string, garbled boolean", work=None, finish=None) -> DataFrame:
    """Every release and every HTML page with its text as written and mended.

    ``work(rel, text)`` may map a record's text to a list of tuples for ``columns``, so that
    later operators run in the same pass over the bytes and texts don't travel. ``finish``
    may add columns to a batch of those rows; it names them in its attribute ``columns``.
    """
    model = model or spark.sparkContext.broadcast(learn(spark, sf_dir))
    work = work or (lambda rel, text, garbled: [(text, garbled)])
    schema = f"rel string, rec_key string, source string, {columns}" + (f", {finish.columns}" if finish else "")
    added = len(finish.columns.split(",")) if finish else 0
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def out(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=names[: len(names) - added])
        return made if finish is None else finish(made)

    def releases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in _parts(batches):
            rows = []
            for key, source, body in zip(batch["id"], batch["source"], batch["body"]):
                if isinstance(body, str):
                    text, garbled = m.mend(body)
                    rows += [("releases", str(key), source, *x) for x in work("releases", text, garbled)]
            if rows:
                yield out(rows)

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in _parts(batches):
            rows = []
            for key, kind, charset, content in zip(batch["url"], batch["id_content_type"], batch["fw_guessed_charset"], batch["content"]):
                if content is not None and is_html(content, kind):
                    text, garbled = garbled_page(m, content, charset)
                    rows += [("page_cache", key, None, *x) for x in work("page_cache", text, garbled)]
            if rows:
                yield out(rows)

    a = spread(table(spark, sf_dir, "releases").select("id", "source", "body")).mapInPandas(releases, schema)
    b = spread(table(spark, sf_dir, "page_cache").select("url", "id_content_type", "fw_guessed_charset", "content")).mapInPandas(pages, schema)
    return a.unionByName(b)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key) of the releases and HTML pages that are garbled."""
    cases = read_records(spark, sf_dir, columns="found boolean", work=lambda rel, text, garbled: [(True,)] if garbled else [])
    return cases.select("rel", "rec_key").distinct()


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key, text) with the original text of the garbled records, where it can be had."""
    cases = read_records(spark, sf_dir, columns="text string", work=lambda rel, text, garbled: [(text,)] if garbled and "\ufffd" not in text else [])
    return cases.select("rel", "rec_key", "text").dropDuplicates(["rel", "rec_key"])
