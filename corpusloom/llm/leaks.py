"""Evaluation texts leaking into training text (problem 9).

Rare n-gram seeds: how often each five-word run of the test items comes in the WHOLE
corpus is counted first; then, of every thirteen-word window of an item, its rarest run is
kept as a seed, so no thirteen words in a row can be missed. An edit breaks just the runs
that the corpus then holds least, so for edited copies every run that the corpus holds is a
seed. Documents are joined with the items by the seeds they hold (one pass of an automaton
over each text). Smith-Waterman alignment around the seeds scores each
pair, within a band, which finds edited and paraphrased copies of a whole item or of thirteen words and
more of it that keep five words in a row somewhere; an exact check for the run asked for
follows. Japanese and Chinese have seeds of ten characters out of every thirty as well.

The items are the one side that is sent to all tasks, in blocks of a bounded size.

Defined results: null and empty texts hold nothing; items too short for a run of thirteen
words (or thirty characters) can only be found by alignment.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import spread, table

WORDS, SEED = 13, 5
CHARACTERS, CHARACTER_SEED = 30, 10
SPACELESS = ("ja", "zh")
#: Items, and their characters, that are sent to the tasks at once; more make several passes.
MOST_ITEMS, MOST_CHARACTERS = 20_000, 20_000_000
#: Scores of the alignment, the share of the aligned part's best score from which it counts
#: as leaked in edited form, and how far apart seeds' shifts may lie to be aligned once.
MATCH, MISMATCH, GAP, EDITED, DRIFT = 2, -1, -1, 0.65, 2
#: Words to either side of a shift that an alignment may go, and cells of all bands of a chunk.
BAND, CELLS = 8, 1_000_000

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(unicodedata.normalize("NFC", text).lower())


def runs(sequence: list, n: int) -> list[tuple[int, str]]:
    """(place, run) of each run of n; words are set off by blanks."""
    return [(i, f" {' '.join(sequence[i : i + n])} ") for i in range(len(sequence) - n + 1)]


class Item:
    def __init__(self, item_id: int, lang: str | None, text: str) -> None:
        self.id = item_id
        self.words = words(text)
        self.text = unicodedata.normalize("NFC", text)
        self.spaceless = (lang or "").lower()[:2] in SPACELESS
        self.codes = self.characters = np.zeros(0, np.int32)

    def prepare(self, codes: dict[str, int]) -> None:
        """The item as numbers, to be aligned."""
        self.codes, self.characters = np.array([codes[w] for w in self.words], np.int32), np.array([*map(ord, self.text)], np.int32)

    def seeds(self) -> list[tuple[int, str]]:
        """(place, seed): its runs of words, and of characters where words aren't set off."""
        return runs(self.words, SEED) + ([(i, self.text[i : i + CHARACTER_SEED]) for i in range(len(self.text) - CHARACTER_SEED + 1)] if self.spaceless else [])

    def candidates(self) -> list[list[str]]:
        """For each window that may leak, the seeds that would show it."""
        seeds = [s for _, s in runs(self.words, SEED)]
        out = [seeds[i : i + WORDS - SEED + 1] for i in range(len(self.words) - WORDS + 1)] or ([seeds] if seeds else [])
        if self.spaceless:
            pieces = [self.text[i : i + CHARACTER_SEED] for i in range(len(self.text) - CHARACTER_SEED + 1)]
            out += [pieces[i : i + CHARACTERS - CHARACTER_SEED + 1] for i in range(len(self.text) - CHARACTERS + 1)] or ([pieces] if pieces else [])
        return out


def _automata(seeds) -> list:
    """One automaton over the words, one over the characters; None where there are no seeds."""
    out = []
    for mine in ([s for s in seeds if s[0] == " " == s[-1]], [s for s in seeds if not (s[0] == " " == s[-1])]):
        automaton = ahocorasick.Automaton() if mine else None
        for s in mine:
            automaton.add_word(s, s)
        if mine:
            automaton.make_automaton()
        out.append(automaton)
    return out


_PLAIN = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})


def _views(text: str) -> tuple[str, str, list[str]]:
    """The text as words between blanks, as composed characters, and its words."""
    if text.isascii():
        found = text.lower().translate(_PLAIN).split()
        return f" {' '.join(found)} ", text, found
    composed = unicodedata.normalize("NFC", text)
    found = _WORD.findall(composed.lower())
    return f" {' '.join(found)} ", composed, found


def hits(automata: list, views: tuple) -> list[tuple[int, str]]:
    """(end, seed) of each seed in a text."""
    out: list[tuple[int, str]] = []
    if automata[0] is not None:
        out += automata[0].iter(views[0])
    if automata[1] is not None and not views[1].isascii():
        out += automata[1].iter(views[1])
    return out


def align_many(tasks: list[tuple[np.ndarray, np.ndarray, int]], band: int = BAND, sizes: list[int] | None = None) -> list[tuple[int, int, int]]:
    """Smith-Waterman of many pairs of code sequences (x, y, shift) at once: (score, first,
    last) of the best local alignment within ``band`` of the shift from x to y, with the
    places in ``x`` that it spans. With ``sizes``, the places that an alignment must span at
    least, pairs that can't reach EDITED over so many stay (0, 0, 0).

    All pairs of a chunk advance a row of their bands together. The gap along a row is the
    running maximum of what stands before it, less its length. Spans are traced back."""
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(tasks)
    order = sorted((k for k, (x, y, _) in enumerate(tasks) if len(x) and len(y)), key=lambda k: len(tasks[k][0]))
    width = 2 * band + 1
    while order:
        longest = len(tasks[order[-1]][0])
        many = max(1, CELLS // (longest * width))
        chunk, order = order[-many:][::-1], order[:-many]
        kind = np.int16 if longest < 15_000 else np.int32
        x = np.full((longest, len(chunk)), -2, np.int32)
        y = np.full((len(chunk), longest + 2 * band), -3, np.int32)  # what lies in each pair's band
        for n, k in enumerate(chunk):
            own, other, shift = tasks[k]
            x[: len(own), n] = own
            part = other[max(0, shift - band) : max(0, shift + len(own) + band)]
            y[n, max(0, band - shift) : max(0, band - shift) + len(part)] = part
        near = np.lib.stride_tricks.sliding_window_view(y, width, axis=1).transpose(1, 0, 2)
        if sizes:
            may = promising(x, near[:, :, band - 3 : band + 4], np.array([sizes[k] for k in chunk]))
            chunk, x, near = [k for k, m in zip(chunk, may) if m], x[:, may], near[:, may]
            if not chunk:
                continue
        gain = np.where(near == x[:, :, None], kind(MATCH), kind(MISMATCH))
        table = np.zeros((longest + 1, len(chunk), width + 1), kind)
        slope = np.arange(width, dtype=kind) * kind(-GAP)
        for i in range(longest):
            row = table[i, :, :-1] + gain[i]
            np.maximum(row, table[i, :, 1:] + kind(GAP), out=row)
            np.maximum(row, 0, out=row)
            row += slope
            np.maximum.accumulate(row, axis=1, out=row)
            np.subtract(row, slope, out=table[i + 1, :, :-1])
        by_row = table.max(axis=2)
        last = by_row.argmax(axis=0)
        score = by_row[last, np.arange(len(chunk))]
        enough = np.array([MATCH * EDITED * sizes[k] for k in chunk]) if sizes else np.ones(len(chunk))
        first = _starts(table, gain, last, score >= enough)
        for k, *found in zip(chunk, score.tolist(), first.tolist(), last.tolist()):
            out[k] = (found[0], found[1], found[2]) if found[1] >= 0 else (found[0], 0, 0)
    return out


def promising(x: np.ndarray, near: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which pairs have so many neighbours in x with an equal within three shifts that an
    alignment of them may reach EDITED: an edit costs a place its match and one more."""
    equal = np.cumsum((near == x[:, :, None]).any(axis=2), axis=0, dtype=np.int32)
    out = np.zeros(len(sizes), bool)
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        total = equal[:, mine]
        window = total[size - 1 :].copy()
        window[1:] -= total[: len(total) - size]
        out[mine] = window.max(axis=0) >= int((MATCH * EDITED + 1) / (MATCH + 1) * size)
    return out


def _starts(table: np.ndarray, gain: np.ndarray, last: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the best alignment of each wanted pair starts in x, traced back from its last row,
    all pairs a step at a time; -1 for the others."""
    first = np.full(len(last), -1)
    n = np.flatnonzero(wanted)
    i, j = last[n], table[last[n], n].argmax(axis=1)
    while len(n):
        here = table[i, n, j]
        ended = here <= 0
        if ended.any():
            first[n[ended]] = i[ended]
            n, i, j, here = n[~ended], i[~ended], j[~ended], here[~ended]
        diagonal = here == table[i - 1, n, j] + gain[i - 1, n, np.minimum(j, gain.shape[2] - 1)]
        up = ~diagonal & (here == table[i - 1, n, np.minimum(j + 1, table.shape[2] - 1)] + GAP)
        i = i - (diagonal | up)
        j = j + up - ~(diagonal | up)
    return first


def count_seeds(documents: DataFrame, seeds) -> dict[str, int]:
    """How often each of the items' runs comes in all documents. Each task sums up first, and
    no more rows come back than there are runs in the items."""
    shared = documents.sparkSession.sparkContext.broadcast(sorted(seeds))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata, total = _automata(shared.value), Counter()
        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str) and text:
                    total.update(s for _, s in hits(automata, _views(text)))
        if total:
            yield pd.DataFrame({"seed": list(total), "n": list(total.values())})

    counted = documents.select("text").mapInPandas(work, "seed string, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    return {r["seed"]: r["n"] for r in counted.collect()}


def blocks_of_items(items: DataFrame) -> Iterator[dict[int, Item]]:
    """The items in blocks of about MOST_ITEMS and MOST_CHARACTERS, by a hash of their ids, so
    what is sent to the tasks at once is bounded however many there are."""
    items = items.select("item_id", "lang", "text").filter("text IS NOT NULL")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters")).first()
    number = max(1, math.ceil(size["n"] / MOST_ITEMS), math.ceil(size["characters"] / MOST_CHARACTERS))
    for k in range(number):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(number)) == k).collect()
        yield {r["item_id"]: Item(r["item_id"], r["lang"], r["text"]) for r in rows}


def leaks(spark: SparkSession, sf_dir: str, edited: bool = False) -> DataFrame:
    """(doc_id, item_id, score, share, exact): pairs joined by a seed, with the score of their
    best alignment, its share of the best possible over the part of the item that is aligned,
    and whether the run asked for is there. Exact copies need one seed a window, ``edited``
    ones every run that the corpus holds."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    parts = [_leaks_of(documents, items, edited) for items in blocks_of_items(table(spark, sf_dir, "eval_items"))]
    return reduce(DataFrame.unionByName, parts)


def _leaks_of(documents: DataFrame, items: dict[int, Item], edited: bool) -> DataFrame:
    chosen = {s for item in items.values() for _, s in item.seeds()}
    if not edited:
        count = count_seeds(documents, chosen)
        chosen = {min(window, key=lambda s: (count.get(s, 0), s)) for item in items.values() for window in item.candidates()}
        chosen = {s for s in chosen if count.get(s)}  # what the corpus never holds can't leak
    places: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for item in items.values():
        for i, s in item.seeds():
            if s in chosen:
                places[s].append((item.id, i))
    shared = documents.sparkSession.sparkContext.broadcast((items, dict(places)))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, seeds = shared.value
        automata = _automata(seeds)
        codes = {w: i for i, w in enumerate(dict.fromkeys(w for item in items.values() for w in item.words))}
        for item in items.values():
            item.prepare(codes)
        for batch in batches:
            met: list[tuple] = []  # (doc_id, item_id, by_words, codes of the text, shift)
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if isinstance(text, str) and text:
                    met += [(doc_id, *x) for x in meetings(automata, seeds, codes, _views(text))]
            if out := judged(items, met):
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "share", "exact"])

    return documents.mapInPandas(work, "doc_id long, item_id long, score int, share double, exact boolean")


def meetings(automata: list, seeds: dict[str, list[tuple[int, int]]], codes: dict[str, int], views: tuple[str, str, list[str]]) -> list[tuple[int, bool, np.ndarray, int]]:
    """(item_id, by_words, the text's codes, shift): where a text shares seeds with items, once
    for shifts up to DRIFT apart."""
    shifts: dict[tuple[int, bool], set[int]] = defaultdict(set)
    words, ends = views[2], None
    for end, seed in hits(automata, views):
        if by_words := seed[0] == " " == seed[-1]:
            if ends is None:
                ends = [*itertools.accumulate(len(w) + 1 for w in words)]
            j = bisect.bisect_left(ends, end) + 1 - SEED
        else:
            j = end + 1 - CHARACTER_SEED
        for item_id, i in seeds[seed]:
            shifts[item_id, by_words].add(j - i)
    out = []
    own: list = [None, None]
    for (item_id, by_words), here in shifts.items():
        if own[by_words] is None:
            own[by_words] = np.array([codes.get(w, -1) for w in words], np.int32) if by_words else np.fromiter(map(ord, views[1]), np.int32, len(views[1]))
        last = None
        for shift in sorted(here):
            if last is None or shift - last > DRIFT:
                out.append((item_id, by_words, own[by_words], shift))
                last = shift
    return out


def judged(items: dict[int, Item], met: list[tuple]) -> list[tuple[int, int, int, float, bool]]:
    """(doc_id, item_id, score, share, exact) of the meetings whose best alignment reaches
    EDITED over as many words (or characters) in a row as a leak needs, or over a shorter item."""
    tasks = [(items[item_id].codes if by_words else items[item_id].characters, y, shift) for _, item_id, by_words, y, shift in met]
    sizes = [min(WORDS if by_words else CHARACTERS, len(x)) for (_, _, by_words, _, _), (x, _, _) in zip(met, tasks)]
    best: dict[tuple[int, int], tuple[int, float, bool]] = {}
    for (doc_id, item_id, by_words, y, shift), (x, _, _), least, (score, first, last) in zip(met, tasks, sizes, align_many(tasks, sizes=sizes)):
        size = WORDS if by_words else CHARACTERS
        share = score / (MATCH * max(1, last - first))
        if last - first < least or share < EDITED:
            continue
        exact = score >= MATCH * size and any(longest_run(x, y, d) >= size for d in range(shift - BAND, shift + BAND + 1))
        found = (score, round(share, 4), exact)
        best[doc_id, item_id] = max(best.get((doc_id, item_id), found), found, key=lambda v: (v[2], v[0]))
    return [(*k, *v) for k, v in best.items()]


def longest_run(x: np.ndarray, y: np.ndarray, shift: int) -> int:
    """Most neighbours of ``x`` that equal those of ``y`` at one shift."""
    a, b = max(0, -shift), min(len(x), len(y) - shift)
    if a >= b:
        return 0
    ends = np.flatnonzero(np.concatenate(([True], x[a:b] != y[a + shift : b + shift], [True])))
    return int(np.diff(ends).max()) - 1


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of the documents that hold the run asked for."""
    return leaks(spark, sf_dir).filter("exact").select("doc_id", "item_id").distinct()


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, score, share, exact) of exact, edited and paraphrased copies."""
    return leaks(spark, sf_dir, edited=True).dropDuplicates(["doc_id", "item_id"])


def _runs_sql(key: str, name: str) -> str:
    words = "regexp_extract_all(lower(nfc_normalize(text)), '[\\p{L}\\p{N}]+')"
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - 11)) AS i FROM (SELECT {key}, {words} AS w FROM {name} WHERE text IS NOT NULL))"


def _pieces_sql(key: str, name: str, where: str) -> str:
    return f"SELECT DISTINCT {key}, substr(t, i, 30) AS g FROM (SELECT {key}, t, unnest(range(1, length(t) - 28)) AS i FROM (SELECT {key}, nfc_normalize(text) AS t FROM {name} WHERE text IS NOT NULL AND {where}))"


_OTHER = "regexp_matches(text, '[^\\x00-\\x7F]')"
_LANGS = "lang IN ('ja', 'zh')"
SQL = {
    "p9_found": f"""WITH d AS ({_runs_sql("doc_id", "documents")}), e AS ({_runs_sql("item_id", "eval_items")}),
 dc AS ({_pieces_sql("doc_id", "documents", _OTHER)}), ec AS ({_pieces_sql("item_id", "eval_items", _LANGS)})
 SELECT doc_id, item_id FROM d JOIN e ON d.g = e.g UNION SELECT doc_id, item_id FROM dc JOIN ec ON dc.g = ec.g""",
}
