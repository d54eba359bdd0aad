"""Sentence boundaries across languages and scripts (problem 10).

Lines are cut first, as a line break always ends a sentence. In a line every terminator is
a node of a lattice whose edges are possible sentences. A node has a price by its mark, the
word before and the word after; an edge costs by what would be left in its sentence: a
bracket or quotation broken in two, or nothing but a short token. The dearest path through
nodes and edges is taken, so a cut can be given up for the sake of another.

What the price asks of words is learned from all documents. In spaced scripts a capital
speaks for a new sentence if the word is mostly written without one. Spaceless scripts are
segmented by a dictionary word lattice: its words are the runs of characters that hold
together across the corpus, and the gap at a mark is classified by the word before it (a
particle that often stands last) and the one after it (a word that often stands first). In
Thai a space between two Thai characters ends a sentence, as the data's contract has it.

Defined results: null, empty and blank texts have no sentences; a line of marks alone is a
sentence of its own; without documents to learn from the fixed lists decide alone.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import dropped, spread, table, written

# Abbreviations after which no sentence ends, whatever follows.
NEVER = frozenset(
    # English
    "dr prof mr mrs ms messrs st mt rev hon gen col capt lt sgt gov sen rep pres e.g i.e eg ie vs cf viz approx ca ed eds ph.d "
    # German
    "hr fr hrn frl dipl ing mag bzw vgl ggf evtl inkl incl exkl zzgl abzgl sog z.b d.h u.a i.d.r z.t u.u m.e s.o s.u o.g bspw insb einschl österr dt engl frz geb gest ev kath "
    # French
    "mme mlle mm mgr me env c.-à-d c-à-d p.ex ex av bd "
    # Spanish
    "sr sra srta dra d dña ud uds vd aprox ej p.ej avda "
    # Polish
    "tj tzn tzw np m.in ok al ul pl mgr inż hab ks św wg zob por im dot ww "
    # Russian, Hindi
    "ок г-н г-жа т.е т.н напр см ср ул пр им проф акад доц डॉ प्रो श्री सुश्री".split()
)
# Abbreviations of what is counted or named by a number; before one they end nothing.
NUMBERED = frozenset("no nos nr nrs fig figs abb abs art bd vol vols kap ch chap sec pp p s str rys tab núm pág págs cap n.º nº z tel min max каб рис стр гл табл кв д корп".split())
# Abbreviations that often stand last, so a capital after them opens a sentence.
LAST = frozenset("etc usw usf inc corp co ltd llc plc bros cie jr hrs itd itp мес др dgl al sq oz lb yr yrs approx".split()) - {"approx"}
# What goes on after a company's "Co." or "&".
AFTER_COMPANY = frozenset("kg kgaa ltd inc ohg gmbh llc".split())
# Months, which a German ordinal may precede.
GERMAN_MONTHS = frozenset("januar jänner februar märz april mai juni juli august september oktober november dezember quartal jahrhundert jahr auflage platz tag woche monat geburtstag jahrestag stock stunde mal rang etage".split())
# Words that open sentences, by language.
OPENERS = frozenset(
    "the a an this that these those it its in on at for with from by to as if when while since after before both all no not there here he she we they you i our their his her who what why how which where does do is are was were has have can will however but and or yet so according "
    "der die das dem den des ein eine einer eines einem einen es er sie wir ihr ich mit für im in am an auf aus bei bis seit nach vor von zum zur zu wer was warum wie wo wann ob wenn als da dass doch aber und oder auch so nun hier dort dies diese dieser dieses damit dazu über unter zwischen ohne durch um "
    "le la les un une des du de ce cet cette ces il elle ils elles on nous vous je en au aux à pour par avec sans sous sur dans depuis d’après selon pourquoi comment quand où qui que quoi si mais et ou est-ce "
    "el los las una unos unas lo al del con sin por para en desde según cuando donde quién quienes qué cómo si pero y o su sus este esta estos estas ese esa a es "
    "w we z ze na do od dla po przy przez o u według dlaczego jak kiedy gdzie kto co czy jeśli ale i oraz to ten ta te ci "
    "в во на по с со из от до для при о об у к за под над после перед почему как когда где кто что если но и или это этот эта эти он она они мы вы я его их".split()
)
_GERMAN = re.compile(r"(?i)\b(?:der|die|das|und|für|mit|von|im|am|den|dem|zum|zur|ein|eine|bis|ist|sind|wird|nicht|auch|bei|seit)\b")

# Particles that carry a sentence on after a closing quotation, in scripts
# without spaces.
CARRY_ON = frozenset("と とは との という といった として って も は が を に へ で の や から まで より など ・ 的 地 得 等 等等 是 之 一词 一句 这 这样 那样 为 一文 一书 では には".split())

_CJK = "぀-ヿ㐀-鿿豈-﫿　-〿＀-￯"
_THAI_GAP = re.compile(r"(?<=[฀-๿])\s+(?=[฀-๿])")
#: Sentence terminals of the basic plane by Unicode's property. The ASCII ones, the ellipsis
#: and the full-width ones have rules of their own, the others (Hindi, Burmese, Khmer,
#: Ethiopic ...) always end one.
TERMINALS = "".join(c for c in map(chr, range(0x80, 0x10000)) if regex.match(r"\p{Sentence_Terminal}", c))
_SURE = frozenset(TERMINALS) - frozenset("…。！？｡．")
_MARK = re.compile(f"[.!?…{TERMINALS}]+")
_CLOSE = "”’»)]}›」』】）〉》〕］｣"
_AFTER = re.compile(r"(?:[\"'“”’»›)\]}」』】）〉》〕］｣]|[   ](?=»)»)*")
_OPENING = " \t  „“«‚‘\"'([{¿¡‹「『【（《*•·"
_DASH = "–—-"
_FULL = "。！？｡"
_TOKEN = re.compile(r"\S+$")
_NEXT = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+|-[^\W\d_]+)*")
_INITIALS = re.compile(r"(?:[^\W\d_]\.\s?-?)*[^\W\d_]")


#: Longest word of the lattice; share of its kind that a count needs, so a kind has at most
#: 500,000; least information (in nats) by which the parts of a word hold together.
LONGEST, LEAST_SHARE, COHESION = 4, 2e-6, 2.0
_SPACELESS = re.compile(r"[぀-ヿ㐀-鿿豈-﫿฀-๿ກ-ໟက-႟ក-៿]+")


_BEFORE = re.compile(f"{_SPACELESS.pattern}$")


def count_line(line: str, total: Counter) -> None:
    """Runs of characters of a line in a spaceless script, wherever they stand (g), first in a
    piece (s) and last before a mark or the line's end (e). A kind's key alone is its sum."""
    for m in _SPACELESS.finditer(line):
        piece = m.group()
        for n in range(1, LONGEST + 1):
            total.update(["g" + piece[i : i + n] for i in range(len(piece) - n + 1)])
        first = m.start() == 0 or line[m.start() - 1] in "。！？"
        last = m.end() == len(line) or line[m.end()] in "。！？"
        for n in range(1, min(LONGEST, len(piece)) + 1):
            if first:
                total["s" + piece[:n]] += 1
            if last:
                total["e" + piece[-n:]] += 1


def count_words(documents: DataFrame) -> DataFrame:
    """(key, n) over all texts; each task sums up before the shuffle. A key is its kind (w for
    words between blanks, else as above) and the word or run."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        words: Counter[str] = Counter()

        def out() -> pd.DataFrame:
            for w, n in words.items():
                if w.isalpha() and not _SPACELESS.match(w) and (w.islower() or w.istitle()):
                    total["w" + w] += n
            made = pd.DataFrame({"key": list(total), "n": list(total.values())})
            words.clear()
            total.clear()
            return made

        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str):
                    words.update(text.split())
                    if not text.isascii() and _SPACELESS.search(text):
                        for line in text.split("\n"):
                            if line:
                                count_line(line, total)
            if len(words) + len(total) > 500_000:
                yield out()
        if words or total:
            yield out()

    return documents.select("text").mapInPandas(work, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


class Words:
    """What the corpus says of words; sent to the tasks once."""

    def __init__(self, counts: dict[str, int]) -> None:
        kinds: dict[str, dict[str, int]] = {"w": {}, "g": {}, "s": {}, "e": {}}
        for key, n in counts.items():
            kinds[key[0]][key[1:]] = n
        #: Words that are written without a capital at least as often as with one.
        self.common = frozenset(w for w, n in kinds["w"].items() if w.islower() and n > 1 and n >= kinds["w"].get(w.title(), 0))
        runs = kinds["g"]
        one = max(1, sum(n for w, n in runs.items() if len(w) == 1))
        self.price: dict[str, float] = {}
        for w, n in runs.items():
            held = min((math.log(n * one / (runs.get(w[:i], n) * runs.get(w[i:], n))) for i in range(1, len(w))), default=0.0)
            if len(w) == 1 or (n > 2 and held >= COHESION):
                self.price[w] = math.log(one / n)
        self.first, self.last = self._odds(kinds["s"], runs), self._odds(kinds["e"], runs)

    @staticmethod
    def _odds(there: dict[str, int], anywhere: dict[str, int]) -> dict[str, float]:
        """How much likelier than elsewhere a run stands there, in nats."""
        a, b = max(1, sum(n for w, n in there.items() if len(w) == 1)), max(1, sum(n for w, n in anywhere.items() if len(w) == 1))
        return {w: math.log((n / a) / (anywhere.get(w, n) / b)) for w, n in there.items() if n > 2}

    def segment(self, piece: str) -> list[str]:
        """The cheapest path through the lattice of dictionary words."""
        cost, back = [0.0] + [math.inf] * len(piece), [0] * (len(piece) + 1)
        for i in range(len(piece)):
            for n in range(1, min(LONGEST, len(piece) - i) + 1):
                w = piece[i : i + n]
                price = self.price.get(w, 1.0 if w in CARRY_ON else 16.0 if n == 1 else math.inf)
                if cost[i] + price < cost[i + n]:
                    cost[i + n], back[i + n] = cost[i] + price, i
        out, end = [], len(piece)
        while end:
            out.append(piece[back[end] : end])
            end = back[end]
        return out[::-1]

    def gap(self, before: str, after: str) -> tuple[float, float, str]:
        """How much the word before a gap speaks for an end (a final particle), how much the
        one after it does (an opening word), and the word after it."""
        a, b = _BEFORE.search(before), _SPACELESS.match(after)
        last = self.segment(a.group())[-1] if a else ""
        first = self.segment(b.group())[0] if b else ""
        bound = lambda x: max(-3.0, min(3.0, x))
        return bound(self.last.get(last, 0.0)), bound(self.first.get(first, -1.0 if first in self.price and len(first) > 1 else 0.0)), first


NOTHING = Words({})


def learn(spark: SparkSession, sf_dir: str) -> Words:
    """The words of all documents; what comes to the driver is bounded by LEAST_SHARE."""
    counts = written(count_words(spread(table(spark, sf_dir, "documents"))), "sentence-words")
    kind = F.substring("key", 1, 1)
    totals = {r["kind"]: r["n"] for r in counts.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n")).collect()}
    least = F.lit(2)
    for k, n in totals.items():
        least = F.when(kind == k, max(2, math.ceil(n * LEAST_SHARE))).otherwise(least)
    rows = counts.filter(F.col("n") >= least).collect()
    dropped(counts)
    return Words({r["key"]: r["n"] for r in rows})


def _price(line: str, start: int, end: int, stop: int, german: bool, words: Words) -> float:
    """What speaks for an end at the marks line[start:end], closed at ``stop`` (positive) or against it."""
    marks, rest = line[start:end], line[stop:]
    after = rest.lstrip(_OPENING)
    if not rest.strip():
        return 9.0
    if marks[-1] in _FULL or (marks[-1] in "!?…" and re.match(f"[{_CJK}]", after[:1] or " ")):
        if stop > end and any(c in _CLOSE or c == "“" for c in line[end:stop]):
            _, opening, first = words.gap("", rest)
            if rest[:1] in "、，,：:；;" or (first in CARRY_ON and opening < OPENS):
                return -5.0
            if opening >= OPENS or rest[:1].isspace():
                return 5.0
            return 5.0 if re.match(r"[㐀-鿿A-Za-z]", rest[:1]) and not re.search(r"[぀-ヿ]", line) else -1.0 if re.match(r"[぀-ゟ]", rest[:1]) else 3.0
        if marks[-1] == "…":
            final, opening, _ = words.gap(line[:start], rest)
            return 2.0 + final + opening
        return -5.0 if rest[:1] in "、，,」』" else 6.0
    if marks[-1] in _SURE:
        return 6.0
    spaced = rest[0].isspace() or stop > end and line[stop - 1].isspace()
    closed = stop > end
    if rest[0] in ",;:/&%=@_" or (rest[0] in _DASH and rest[1:2] != " "):
        return -6.0
    while after[:1] in _DASH and after[:1]:
        after = after[1:].lstrip(_OPENING)
    c = after[:1]
    if not c:
        return -1.0 if rest[0] in _DASH else 4.0
    before = _TOKEN.search(line, max(0, start - 60), start)
    token = before.group().lstrip("„“«‚‘\"'([{¿¡‹*•–—-") if before else ""
    if not spaced:
        # a missing blank: letters run into a capital that begins a word
        if marks[-1] in "!?" and rest[:1] == c and c.isupper() and not re.search(r"(?i)(?:www|http|@|/)", token):
            return 2.0
        if marks[0] in ".!?" and c.isupper() and rest[:1] == c and re.match(r"[^\W\d_][^\W\d_A-ZÀ-Ž]|[^\W\d_]’|[^\W\d_] ", rest) and re.search(r"(?:[^\W\d_A-ZÀ-Ž]{2}|\d{2}|[™®)\]”»])$", line[:start] if not closed else ")") and not re.search(r"(?i)(?:www|http|@|/)", token):
            return 2.0
        return 3.0 if closed and marks[-1] in ".!?" and c.isupper() and rest[:1] in "„“«¿¡" else -6.0
    follow = _NEXT.match(after)
    word = follow.group() if follow else ""
    loud = len(word) > 1 and word.isupper() and token.isupper() and len(token) > 1
    opens = word.lower() in OPENERS or word.lower() in words.common or word.lower().split("’")[0] in OPENERS and "’" in word
    if c.islower() or (loud and closed and marks != "." and not opens):
        return -6.0
    if len(marks) > 1 or marks in "…!?":
        return 4.0
    # one point
    low = token.lower()
    if not token:
        return -3.0
    if low in NEVER:
        return -6.0
    if low in NUMBERED and c.isdigit():
        return -6.0
    if token.isdigit():
        if not line[: start - len(token)].strip(_OPENING + _DASH) and len(token) <= 3:
            return -6.0  # a list's number
        if len(token) <= 3 and german and not closed:
            ahead = re.search(r"(\S+)\s+$", line[max(0, start - 40) : start - len(token)])
            named = ahead and re.search(r"[^\W\d_]$|[™®]$", ahead[1]) and not ahead[1][:1].islower()  # "Fitor 79." is no ordinal
            return 3.0 if word.lower() not in GERMAN_MONTHS and (opens or named or rest.lstrip()[:1] in "(„“«") else -4.0
        return 4.0
    if low in LAST:
        if word.lower() in AFTER_COMPANY:
            return -6.0
        return 3.0
    if _INITIALS.fullmatch(token):
        if low in ("п", "д") and re.search(r"т\.\s?$", line[: start - 1]):
            return 3.0
        if len(token) == 1 or not opens:
            return -5.0
        return 2.0
    return 5.0


#: Odds from which a word opens a sentence; what an edge of the lattice costs for each bracket
#: or quotation that it breaks, and for a sentence that is a short token alone.
OPENS, BROKEN, LONE = 0.7, 1.25, 1.5
_PAIRS = re.compile(r"[(（)）]")
_LONE = re.compile(r"\W*\w{1,2}\W*")


def best_path(line: str, nodes: list[tuple[int, int, float]]) -> list[int]:
    """Places where the dearest path through (end of mark, place of cut, price) cuts the line.

    A path's worth is the sum of its nodes' prices less what its edges cost. An edge costs for
    a bracket that is open at its end and closed later, and, between neighbours, for a lone
    token, so the best path to a node comes over its neighbour or over the best before that."""
    marks = [(m.start(), 1 if m.group() in "(（" else -1) for m in _PAIRS.finditer(line)]
    later = [0]  # closing brackets from each bracket on
    for _, x in reversed(marks):
        later.append(later[-1] + (x < 0))
    later.reverse()
    level = opened = 0
    top = before = (0.0, None)  # the best path so far, and that without the last node
    last: tuple[float, tuple | None] | None = None
    at = 0
    for _, stop, price in nodes:
        while opened < len(marks) and marks[opened][0] < stop:
            level = max(0, level + marks[opened][1])
            opened += 1
        reach = top
        if last is not None and last is top and _LONE.fullmatch(line[at:stop]):
            reach = max((last[0] - LONE, last[1]), before, key=lambda p: p[0])
        broken = level > 0 and later[opened] > 0
        last, before, at = (reach[0] + price - 2 * BROKEN * broken, (stop, reach[1])), top, stop
        if last[0] > top[0]:
            top = last
    cuts, path = [], top[1]
    while path:
        cuts.append(path[0])
        path = path[1]
    return cuts[::-1]


def line_sentences(line: str, german: bool, words: Words = NOTHING) -> list[tuple[int, int]]:
    """(start, end) of the sentences of one line."""
    if "฀" <= max(line) and _THAI_GAP.search(line):
        cuts = [(m.start(), m.end()) for m in _THAI_GAP.finditer(line)]
    else:
        cuts = []
    nodes = []
    for m in _MARK.finditer(line):
        stop = _AFTER.match(line, m.end()).end()
        nodes.append((m.end(), stop, _price(line, m.start(), m.end(), stop, german, words)))
    ends = best_path(line, nodes) if nodes else []
    gaps = sorted({*[(e, e) for e in ends], *cuts})
    out, last = [], 0
    for a, b in [*gaps, (len(line), len(line))]:
        piece = line[last:a]
        if stripped := piece.strip():
            start = last + len(piece) - len(piece.lstrip())
            out.append((start, start + len(stripped)))
        last = max(last, b)
    return out


def sentences(text: str | None, words: Words = NOTHING) -> list[tuple[int, int]]:
    """(start, end) of every sentence, in code points."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    at = 0
    for line in re.split(r"[\n\r  ]", text):
        if line and not line.isspace():
            german = len(_GERMAN.findall(line)) * 25 > len(line.split())
            out += [(at + a, at + b) for a, b in line_sentences(line, german, words)]
        at += len(line) + 1
    return out


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, s_start, s_end) of every sentence of every document."""
    model = spark.sparkContext.broadcast(learn(spark, sf_dir))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, starts, ends = [], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if isinstance(text, str):
                    for a, b in sentences(text, model.value):
                        ids.append(doc_id)
                        starts.append(a)
                        ends.append(b)
            if ids:
                yield pd.DataFrame({"doc_id": ids, "s_start": starts, "s_end": ends})

    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).mapInPandas(work, "doc_id long, s_start int, s_end int")
