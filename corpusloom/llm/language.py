"""Missing or wrong language labels, and texts that mix languages (problem 5).

Nearest-centroid classification. Texts become normalised TF-IDF vectors of hashed
character trigrams; each language has several centroids, found by spherical k-means, so
that its registers may differ. Every sentence is compared with all centroids by cosine; one
that is too far from all of them says nothing. A best path over a body's sentences, with a
price for each change of language, then joins sentences to segments with a confidence. A
segment long enough to tell that lies far from all of them, and hardly nearer to its own
language than to another, is rejected: its language is UNKNOWN.

The centroids and the IDF are fitted on a bounded sample of labelled documents (SAMPLE a
language, of at most LONGEST characters, by hash of the id). Labels may be wrong: a sample text nearer to another language's centroid
than to its own is put aside before the clusters are formed. All bodies are classified
whole.

Defined results: null, empty and letterless bodies have no language; sentences that say
nothing or hold few letters take the language of the sentences around them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import charset
from corpusloom.llm.residue import residue_records
from corpusloom.session import spread, table

LANGUAGES = ("de", "en", "es", "fr", "pl", "ru")
#: Label of segments in none of them.
UNKNOWN = "und"
#: Labelled documents a language that the centroids are fitted on, at most, and their longest.
SAMPLE, LONGEST = 150, 50_000
#: Centroids a language, and buckets that trigrams are hashed to.
CLUSTERS, BUCKETS = 3, 1 << 14
#: Least cosine of a sentence to some centroid; price of a change of language; weight of the evidence.
NEAR, CHANGE, WEIGHT = 0.05, 3.0, 1.0
#: Trigrams from which a segment can be rejected; cosine under which it is far from all, and
#: how much nearer it must then be to its language than to the next; the mean of its
#: sentences' margins under which that is looked at.
ENOUGH, FAR, MARGIN, DOUBT = 100, 0.25, 0.07, 0.15
#: Code points from which a segment counts as a passage.
PASSAGE = 60

_END = re.compile(r"(?:[!?…]|(?:(?<=[^\W\d_]{3})|(?<=\d{3})|(?<=[™®\])”“»%€$]))\.)[\"”“»)’]*\s+(?=[„“«\"¿¡(]?\s?[^\W\d_a-zà-öø-ÿа-яąćęłńóśźż])")
_WORDS = re.compile(r"[^\W\d_]+")


def trigrams(text: str) -> np.ndarray:
    """Buckets of the text's character trigrams, words set off by single blanks."""
    return many_trigrams([text])[0]


def many_trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of all texts, and where each text's begin.

    Capitalised words are mostly names, which belong to no language, and are left out
    unless little else remains.
    """
    cleaned = []
    for text in texts:
        words = _WORDS.findall(text)
        plain = " ".join([w for w in words if w.islower()])
        if len(plain) < 14:
            plain = " ".join(words).lower()
        cleaned.append(f" {plain} " if plain else "")
    codes = np.frombuffer("\0".join(cleaned).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1]) * np.uint64(0x85EBCA77) + codes[2:]
    mixed = (mixed ^ (mixed >> np.uint64(23))) * np.uint64(0xC2B2AE3D27D4EB4F)
    apart = codes == 0
    whole = ~(apart[:-2] | apart[1:-1] | apart[2:])
    of = np.cumsum(apart)[:-2][whole]
    return (mixed[whole] >> np.uint64(50)).astype(np.int64), np.searchsorted(of, np.arange(len(texts)))


class Centroids:
    """Centroids of all languages as one matrix, buckets by centroids, IDF multiplied in."""

    def __init__(self, samples: list[tuple[str, str]]) -> None:
        labels = [x for x, _ in samples]
        vectors = np.zeros((len(samples), BUCKETS), np.float32)
        for row, (_, text) in enumerate(samples):
            np.add.at(vectors[row], trigrams(text), 1)
        self.idf = np.sqrt(np.log((1 + len(samples)) / (1 + (vectors > 0).sum(axis=0))).astype(np.float32) + 0.1)
        vectors = _unit(vectors * self.idf)
        self.languages = [x for x in LANGUAGES if x in labels]
        own = np.array([self.languages.index(x) for x in labels], np.int64)
        mean = _unit(np.array([vectors[own == k].mean(axis=0) for k in range(len(self.languages))])) if labels else np.zeros((0, BUCKETS), np.float32)
        for _ in range(2):  # wrong labels out, then once more from what remains
            right = (vectors @ mean.T).argmax(axis=1) == own if labels else np.zeros(0, bool)
            mean = _unit(np.array([vectors[(own == k) & right].mean(axis=0) if ((own == k) & right).any() else mean[k] for k in range(len(self.languages))])) if labels else mean
        centroids, self.of = [], []
        for k in range(len(self.languages)):
            for c in _clusters(vectors[(own == k) & right], mean[k]):
                centroids.append(c)
                self.of.append(k)
        self.of = np.array(self.of, np.int64)
        self.matrix = (np.array(centroids, np.float32).reshape(-1, BUCKETS) * self.idf).T.copy()

    def cosines(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Cosine of each sentence (grams[starts[i]:starts[i + 1]]) to each language's nearest centroid."""
        if not len(grams) or not len(self.of):
            return np.zeros((len(starts), len(self.languages)), np.float32)
        ends = np.append(starts[1:], len(grams))
        filled = ends > starts
        dots = np.zeros((len(starts), len(self.of)), np.float32)
        dots[filled] = np.add.reduceat(self.matrix[grams], starts[filled], axis=0)
        which = np.repeat(np.arange(len(starts)), ends - starts)
        pairs, counts = np.unique(which * BUCKETS + grams, return_counts=True)
        norm = np.sqrt(np.bincount(pairs // BUCKETS, (counts * self.idf[pairs % BUCKETS]) ** 2, len(starts)))
        dots /= np.maximum(norm, 1e-9)[:, None]
        return np.stack([dots[:, self.of == k].max(axis=1) for k in range(len(self.languages))], axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _clusters(rows: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Spherical k-means; starts from the texts farthest from the centres chosen so far."""
    if len(rows) <= CLUSTERS:
        return mean[None, :]
    centres = [rows[(rows @ mean).argmax()]]
    while len(centres) < CLUSTERS:
        centres.append(rows[(rows @ np.array(centres).T).max(axis=1).argmin()])
    centres = np.array(centres)
    for _ in range(8):
        nearest = (rows @ centres.T).argmax(axis=1)
        centres = _unit(np.array([rows[nearest == k].mean(axis=0) if (nearest == k).any() else centres[k] for k in range(CLUSTERS)]))
    return centres


def sentences(text: str) -> list[tuple[int, int]]:
    """Rough sentences of all lines, as offsets; a line's break always ends one."""
    out, at = [], 0
    for line in text.split("\n"):
        last = at
        for m in _END.finditer(line):
            out.append((last, at + m.end()))
            last = at + m.end()
        if last < at + len(line):
            out.append((last, at + len(line)))
        at += len(line) + 1
    return out


def segments(model: Centroids, text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of runs of sentences of one language in one line."""
    spans = sentences(text)
    if not spans or not model.languages:
        return []
    grams, starts = many_trigrams([text[a:b] for a, b in spans])
    cos = model.cosines(grams, starts)
    sizes = np.diff(np.append(starts, len(grams))).astype(np.float32)
    known = cos.max(axis=1) >= NEAR
    evidence = WEIGHT * np.log((cos + 0.03) / (cos.max(axis=1, keepdims=True) + 0.03)) * np.sqrt(sizes)[:, None] * known[:, None]
    if not known.any():
        return [(spans[0][0], spans[-1][1], UNKNOWN, round(float(1 - cos.max()), 4))] if sizes.sum() >= ENOUGH else []
    steps = evidence.tolist()
    best, back = steps[0], []
    for step in steps[1:]:
        top = max(best)
        at, move = best.index(top), top - CHANGE
        back.append([j if x >= move else at for j, x in enumerate(best)])
        best = [max(x, move) + e for x, e in zip(best, step)]
    path = [best.index(max(best))]
    for came in reversed(back):
        path.append(came[path[-1]])
    path.reverse()
    share = np.exp(8 * (cos - cos.max(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    two = np.partition(cos, -2, axis=1)[:, -2:] if cos.shape[1] > 1 else np.stack([np.zeros(len(cos)), cos[:, 0]], axis=1)
    apart = (two[:, 1] - two[:, 0]) * sizes
    out: list[list] = []
    for i, ((a, b), lang) in enumerate(zip(spans, path)):
        weight = float(sizes[i]) if known[i] else 0.0
        if out and out[-1][2] == lang and "\n" not in text[out[-1][1] : a]:
            last = out[-1]
            last[1], last[3], last[4], last[6] = b, last[3] + weight * float(share[i][lang]), last[4] + weight, i + 1
        else:
            out.append([a, b, lang, weight * float(share[i][lang]), weight, i, i + 1])
    found = []
    for a, b, lang, got, weight, i, j in out:
        size = float(sizes[i:j].sum())
        if size >= ENOUGH and float(apart[i:j].sum()) < DOUBT * size:
            end = int(starts[j]) if j < len(starts) else len(grams)
            near = np.sort(model.cosines(grams[starts[i] : end], np.zeros(1, np.int64))[0])
            if near[-1] < FAR and near[-1] - (near[-2] if len(near) > 1 else 0.0) < MARGIN:
                found.append((a, b, UNKNOWN, round(float(1 - near[-1]), 4)))
                continue
        if weight > 0:
            found.append((a, b, model.languages[lang], round(got / weight, 4)))
    return found


def fit(spark: SparkSession, sf_dir: str) -> Centroids:
    """Centroids from at most SAMPLE documents a language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower(F.substring("lang", 1, 2)).alias("lang"), "text")
    docs = docs.filter(F.col("lang").isin(*LANGUAGES) & F.length("text").between(201, LONGEST))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = docs.select("doc_id", "lang").withColumn("nth", nth).filter(F.col("nth") <= SAMPLE)
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").orderBy("lang", "nth").select("lang", "text").collect()
    return Centroids([(r["lang"], r["text"]) for r in rows])


def release_segments(spark: SparkSession, sf_dir: str, plausibility=None) -> DataFrame:
    """(id, source, s_start, s_end, lang, confidence) of every body's segments, garbled text as mended."""
    model = spark.sparkContext.broadcast(fit(spark, sf_dir))
    plausibility = plausibility or spark.sparkContext.broadcast(charset.learn(spark, sf_dir))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, source, body in zip(batch["id"], batch["source"], batch["body"]):
                if isinstance(body, str):
                    rows += [(key, source, *x) for x in segments(model.value, plausibility.value.mend(body)[0])]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "source", "s_start", "s_end", "lang", "confidence"])

    bodies = spread(table(spark, sf_dir, "releases").select("id", "source", "body"))
    return bodies.mapInPandas(work, "id long, source string, s_start int, s_end int, lang string, confidence double")


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment of each release with its language and confidence."""
    return release_segments(spark, sf_dir).drop("source").dropDuplicates(["id", "s_start"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lang): languages of passages that the source's label doesn't name."""
    model = spark.sparkContext.broadcast(fit(spark, sf_dir))

    def also(rel: str, text: str) -> str | None:
        if rel != "releases":
            return None
        return ",".join(sorted({lang for a, b, lang, _ in segments(model.value, text) if b - a >= PASSAGE and lang != UNKNOWN})) or None

    residue, passages = residue_records(spark, sf_dir, also=also)
    passages = passages.join(residue, ["rel", "rec_key"], "left_anti")
    tags = table(spark, sf_dir, "source_tags").groupBy("source").agg(F.max(F.lower("lang")).alias("labelled"))
    other = passages.withColumn("lang", F.explode(F.split("other", ","))).join(tags, "source", "left").filter("labelled IS NULL OR lang <> labelled")
    return other.select(F.col("rec_key").cast("long").alias("id"), "lang").distinct()
