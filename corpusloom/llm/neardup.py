"""Near-duplicate records with small edits (problem 7), by Order MinHash.

A record is its sequence of words; its k-mers are runs of three words, each taken where it
first comes, as the share asked for counts distinct runs and repeats mustn't lower it. Each
of REPEATS sketches takes the KEEP k-mers of least hash and keeps them in the order of the
text, so two records meet in a sketch only if they share those k-mers in that order: the
chance follows edit similarity, not the mere set. Pairs of the signature's other minima,
without an order, are keys as well, for texts with moved parts.
Candidates are verified by banded alignments of their distinct runs: the chain about the
commonest shift, then those of moved parts, until the runs aligned reach the share of the
union that is asked for (the record is kept) or nothing is left to align (it is dropped),
at which point all equal runs have been counted, so the outcome is exact.

Exact copies (same words) are one class, compared once through its smallest id, and
expanded at the end only. What travels of a class is its sketches and a signature of its
minima; texts are fetched for verified candidates alone. Sketches that more than HOT
classes share are mostly made of set phrases; their classes are paired by an exact prefix
filter instead: of n distinct runs two classes need 0.6 n in common, so with the runs in
one order for all, commonest last, they have one of the first 0.4 n in common. Any order
is exact; the runs of all releases, counted in SLOTS numbers by their hashes, tell which are
common, which saves pairs. So a hot bucket loses no pair of the share needed.

Defined results: null bodies and bodies under MIN_WORDS words take no part; a null title
is empty; ids come out once a pair, smaller first.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import dropped, spread, table, written

#: Words in a k-mer; k-mers in a sketch; sketches; pairs of other minima; minima in a signature.
K, KEEP, REPEATS, TWOS, MINIMA = 3, 2, 24, 16, 64
#: Words a body needs, share of distinct runs that a pair needs (also in tenths), classes in a bucket before it is hot.
MIN_WORDS, SHARE, TENTHS, HOT = 60, 0.6, 6, 24
#: Numbers that runs are counted in, by their hashes, and parts that these are summed up in.
SLOTS, PARTS = 1 << 22, 256
#: Of MINIMA, those a candidate must agree in: by one bit, and by eight. A pair with the share
#: needed agrees in 51 (deviation 3.2) and 38 (3.9) on average, and is dropped once in 3 and 19 million.
BIT_FILTER, BYTE_FILTER = 34, 18
#: The same by three bits, for those that meet by a prefix: 42 (3.8) on average, dropped once in 25 million.
BITS_FILTER = 21
#: Rows of prefixes that meet in one pass, and most passes: beyond them a pass takes its share of the rows.
PASS_ROWS, PASSES = 4_000_000, 8
#: Runs that an alignment may lie off its commonest shift, and runs in order that make a part which groups count.
BAND, PART = 64, 3
#: Members of a class of copies that meet the class in one task.
BLOCK = 2_000
_WORD = re.compile(r"[^\W_]+")
_SEEDS = np.array([xxhash.xxh3_64_intdigest(f"omh{r}") | 1 for r in range(MINIMA)], np.uint64)


class _Hashes(dict):
    """The hashes of words, kept while they are few."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _Hashes().__getitem__


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASH, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def kmers(title: str | None, body: str) -> np.ndarray:
    """Hashes of the three-word runs of title and body, in order; empty if the body is short."""
    words = _WORD.findall(body.lower())
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.uint64)
    h = _word_hashes(_WORD.findall((title or "").lower()) + words)
    return _mix(_mix(_mix(h[:-2]) * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:])


def labelled(runs: np.ndarray) -> np.ndarray:
    """The runs, each mixed with the number of times it has come before."""
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    before = np.arange(len(runs)) - np.maximum.accumulate(np.where(first, np.arange(len(runs)), 0))
    out = runs.copy()
    out[order] += _mix(before.astype(np.uint64)) * (before > 0)
    return out


def sketches(runs: np.ndarray) -> tuple[np.ndarray, int, int, int, bytes]:
    """(keys, one bit of each minimum, another, a third, one byte of each minimum), all over distinct runs.

    A sketch hashes the KEEP least k-mers in the order of the text; the minima that no
    sketch uses are keys in twos."""
    distinct, first = np.unique(runs, return_index=True)
    every = _mix(distinct[np.argsort(first)][None, :] * _SEEDS[:, None])
    keep = min(KEEP, len(distinct))
    rest, each, places = every[:REPEATS].copy(), np.arange(REPEATS), []
    for _ in range(keep):
        places.append(rest.argmin(axis=1))
        rest[each, places[-1]] = np.uint64(2**64 - 1)
    taken = np.take_along_axis(every[:REPEATS], np.sort(np.stack(places, axis=1), axis=1), axis=1)
    keys = np.arange(1, REPEATS + 1, dtype=np.uint64)
    for i in range(keep):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + taken[:, i])
    minima = every.min(axis=1)
    twos = np.arange(REPEATS + 1, REPEATS + 1 + TWOS, dtype=np.uint64)
    for i in (0, 1):
        twos = _mix(twos * np.uint64(0x9E3779B97F4A7C15) + minima[REPEATS + i : REPEATS + 2 * TWOS : 2])
    bits = (int(np.packbits((minima >> np.uint64(at)).astype(np.uint8) & 1).view(np.int64)[0]) for at in (40, 41, 42))
    return np.concatenate((keys, twos)).view(np.int64), *bits, (minima >> np.uint64(50)).astype(np.uint8).tobytes()


def prefix(runs: np.ndarray, times: np.ndarray) -> tuple[int, np.ndarray]:
    """(number of distinct runs, the least of them of which a pair with the share needed has
    one in common, rarest first, cut to 32 bits); ``times`` has how often the runs of each slot were counted."""
    distinct = np.unique(runs)
    seen = times[distinct % np.uint64(SLOTS)]
    need = -(-TENTHS * len(distinct) // 10)
    return len(distinct), distinct[np.lexsort((distinct, seen))[: len(distinct) - need + 1]].astype(np.uint32).view(np.int32)


def chains(a: np.ndarray, b: np.ndarray, band: int = BAND) -> tuple[list[int], int]:
    """Sizes of the chains that banded alignments of two records' distinct runs find, and how
    many distinct runs both have together, counted twice where equal.

    Equal runs are points (place in a, place in b), and a band is ``band`` neighbouring
    shifts between the two. The band with most points is aligned first, by its longest
    increasing chain, then the next, so a moved part is a chain of its own; points that no
    chain holds come last, as chains of one."""
    (x, at_x), (y, at_y) = np.unique(a, return_index=True), np.unique(b, return_index=True)
    _, in_x, in_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    at_a, at_b = at_x[in_x], at_y[in_y]
    order = np.argsort(at_a)
    at_b, shifts = at_b[order], (at_b - at_a)[order]
    if not len(order):
        return [], len(x) + len(y)
    middle = int(np.median(shifts))  # the records' own shift lies within a band, not between two
    bands = (shifts - middle + band // 2) // band
    out, single = [], 0
    names, count = np.unique(bands, return_counts=True)
    for name in names[np.argsort(-count, kind="stable")]:
        tails: list[int] = []
        for j in at_b[bands == name].tolist() if len(names) > 1 else at_b.tolist():
            if not tails or j > tails[-1]:
                tails.append(j)
            else:
                tails[bisect.bisect_left(tails, j)] = j
        single += int(count[names == name][0]) - len(tails)
        out.append(len(tails))
    return out + [1] * single, len(x) + len(y)


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[bool, float]:
    """Whether the runs aligned, chain after chain, reach SHARE of the union of distinct runs,
    and the share that chains of PART or more runs hold."""
    sizes, both = chains(a, b)
    total = kept = 0
    for size in sizes:
        total += size
        if kept := total >= SHARE * (both - total):
            break
    parts = sum(size for size in sizes if size >= PART)
    return bool(kept), parts / max(1, both - sum(sizes))


def run_counts(releases: DataFrame) -> np.ndarray:
    """In how many releases the runs of each slot are, over all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for title, body in zip(*(c.to_pylist() for c in batch.columns)):
                if body is not None:
                    np.add.at(times, np.unique(kmers(title, body)) % np.uint64(SLOTS), 1)
        if times.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in np.split(times, PARTS)], pa.binary())], names=["part", "times"])

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        times = np.zeros(SLOTS // PARTS, np.uint32)
        for x in rows["times"]:
            times += np.frombuffer(x, np.uint32)
        return pd.DataFrame({"part": rows["part"].iloc[:1], "times": [times.tobytes()]})

    counted = spread(releases.select("title", "body")).mapInArrow(work, "part int, times binary")
    times = np.zeros((PARTS, SLOTS // PARTS), np.uint32)
    for r in written(counted.groupBy("part").applyInPandas(summed, "part int, times binary"), "near-run-counts").collect():
        times[r["part"]] = np.frombuffer(r["times"], np.uint32)
    return times.reshape(-1)


def classes(releases: DataFrame) -> DataFrame:
    """(id, cls, keys, bits, bits1, bits2, sig, size, least): each record's class of exact copies, its
    sketches, and its distinct runs' number and prefix."""
    shared = releases.sparkSession.sparkContext.broadcast(run_counts(releases))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = shared.value
        for batch in batches:
            rows = []
            for key, title, body in zip(*(c.to_pylist() for c in batch.columns)):
                if body is not None:
                    runs = kmers(title, body)
                    if len(runs):
                        rows.append((key, xxhash.xxh3_128_hexdigest(runs.tobytes()), *sketches(runs), *prefix(runs, times)))
            if rows:
                key, cls, keys, *bits, sig, size, least = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(cls), _lists(keys), *(pa.array(b, pa.int64()) for b in bits), pa.array(sig, pa.binary()), pa.array(size, pa.int32()), _lists(least)], names=["id", "cls", "keys", "bits", "bits1", "bits2", "sig", "size", "least"])

    return spread(releases.select("id", "title", "body")).mapInArrow(work, "id long, cls string, keys array<long>, bits long, bits1 long, bits2 long, sig binary, size int, least array<int>")


def _lists(arrays: tuple[np.ndarray, ...]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)], dtype=np.int32)), pa.array(np.concatenate(arrays)))


@F.pandas_udf(T.IntegerType())
def _agree(a: pd.Series, b: pd.Series) -> pd.Series:
    """Bytes in which two signatures agree."""
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, MINIMA) for s in (a, b))
    return pd.Series((x == y).sum(axis=1).astype(np.int32))


def _meeting(rows: DataFrame, *more: str) -> DataFrame:
    """Pairs a < b of rows (key, id, size, bits, ...) that share a key; of both sides the columns left."""
    left, right = (rows.toDF("key", side, *(f"{c}_{side}" for c in ("size", "bits", *more))) for side in "ab")
    return left.join(right, "key").filter("a < b")


def _differ(*bits: str):
    """Minima that differ in one of some bits."""
    return F.bit_count(functools.reduce(lambda x, y: x.bitwiseOR(y), (F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b")) for b in bits)))


def _by_prefix(prefixes: DataFrame, passes: int, i: int) -> DataFrame:
    """(a, b) of the classes that share a run of their prefixes, of the i-th of so many parts of the runs."""
    more = "bits1", "bits2", "place"
    least = prefixes.select("id", "size", "bits", "bits1", "bits2", F.posexplode("least").alias("place", "key")).filter(F.pmod("key", F.lit(passes)) == i)
    rest = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    met = _meeting(least.select("key", "id", "size", "bits", *more), *more).filter(rest * (10 + TENTHS) >= (F.col("size_a") + F.col("size_b")) * TENTHS)
    return met.filter(_differ("bits", "bits1", "bits2") <= MINIMA - BITS_FILTER).select("a", "b").distinct()


def candidates(reps: DataFrame) -> DataFrame:
    """(a, b), a < b: classes that share a sketch and whose signatures allow the share needed.
    Those that share a hot sketch only are found by their prefixes: of the runs from the
    first common one on, the shorter rest must hold what the share needs.

    How many classes a key has is counted before its rows meet, and each part is written
    before the next begins, so its shuffle files are gone by then. Prefixes meet in passes, each
    with its share of the keys, and three bits of each minimum go with them: set phrases bring
    together far more classes than are alike, and those are gone before their pairs travel."""
    rows = reps.select(F.explode("keys").alias("key"), "id", "size", "bits")
    crowd = rows.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    rows = written(rows.join(crowd, "key"), "near-keys")
    hot = written(rows.filter(F.col("crowd") > HOT).select("id").distinct(), "near-hot")
    by_sketch = _meeting(rows.filter(F.col("crowd") <= HOT).drop("crowd")).filter(_differ("bits") <= MINIMA - BIT_FILTER).filter(F.least("size_a", "size_b") * 10 >= F.greatest("size_a", "size_b") * TENTHS)
    by_sketch = written(by_sketch.select("a", "b").distinct(), "near-by-sketch")
    dropped(rows)
    prefixes = written(reps.select("id", "size", "bits", "bits1", "bits2", "least").join(hot, "id", "left_semi"), "near-prefixes")
    passes = max(1, min(PASSES, -(-(prefixes.agg(F.sum(F.size("least"))).first()[0] or 0) // PASS_ROWS)))
    pairs = by_sketch
    for i in range(passes):
        pairs = pairs.unionByName(written(_by_prefix(prefixes, passes, i), "near-by-prefix"))
    dropped(prefixes)
    sig = reps.select("id", "sig")
    pairs = pairs.distinct().join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
    return pairs.filter(_agree("sig_a", "sig_b") >= BYTE_FILTER).select("a", "b")


def verified(pairs: DataFrame, releases: DataFrame) -> DataFrame:
    """(a, b, parts) of the candidates that the alignment keeps, and the share that lies in parts
    of PART or more runs in order; texts join in here only."""
    texts = releases.select("id", "title", "body")
    both = pairs.join(texts.toDF("a", "title_a", "body_a"), "a").join(texts.toDF("b", "title_b", "body_b"), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # a text takes part in several pairs

        def runs_of(key: int, title: str | None, body: str) -> np.ndarray:
            if (runs := known.get(key)) is None:
                if len(known) > 2_000:
                    known.clear()
                runs = known[key] = kmers(title, body)
            return runs

        for batch in batches:
            rows = []
            for a, b, title_a, body_a, title_b, body_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "title_a", "body_a", "title_b", "body_b"))):
                kept, parts = aligned(runs_of(a, title_a, body_a), runs_of(b, title_b, body_b))
                if kept:
                    rows.append((a, b, parts))
            if rows:
                a, b, parts = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(parts, pa.float64())], names=["a", "b", "parts"])

    return both.mapInArrow(work, "a long, b long, parts double")


def links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Verified links between classes (a, b, parts), and members (id, rep)."""
    releases = table(spark, sf_dir, "releases")
    every = written(classes(releases), "near-classes")
    first = every.groupBy("cls").agg(F.min("id").alias("rep"))
    members = written(every.select("id", "cls").join(first, "cls").select("id", "rep"), "near-members")
    reps = written(every.drop("cls").join(members.filter("id = rep").select("id"), "id", "left_semi"), "near-representatives")
    dropped(every)
    pairs = written(candidates(reps), "near-candidates")
    return written(verified(pairs, releases), "near-links"), members


def copy_pairs(members: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of exact copies. A large class is split into blocks of about
    BLOCK members; each block meets the whole class in a task of its own."""
    sizes = members.groupBy("rep").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = members.join(sizes, "rep")
    left = rows.select("rep", F.col("id").alias("id_a"), F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
    right = rows.select("rep", F.col("id").alias("id_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    return left.join(right, ["rep", "block"]).filter("id_a < id_b").select("id_a", "id_b")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_a, id_b): every pair of like records, copies included, as the data's contract asks."""
    found, members = links(spark, sf_dir)
    copies = copy_pairs(members)
    across = found.select("a", "b").join(members.toDF("x", "a"), "a").join(members.toDF("y", "b"), "b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    return copies.unionByName(across)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) with component the least node reached; edges (a, b), nodes (node).

    Least labels spread along edges, and labels are looked up in labels (pointer jumping),
    so a chain takes a logarithm of its length in rounds. Each round is cut by a written
    table; only a row's count comes to the driver.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "component-edges")
    labels = written(nodes.select("node", F.col("node").alias("component")), "component-labels")
    while True:
        near = both.join(labels.toDF("b", "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node", "left").select("node", "component", F.least("component", F.coalesce("near", "component")).alias("next"))
        jumped = lower.join(lower.select(F.col("node").alias("next"), F.col("next").alias("far")), "next").select("node", F.least("next", "far").alias("component"), (F.least("next", "far") < F.col("component")).alias("moved"))
        step = written(jumped, "component-labels")
        if step.filter("moved").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, group_id, copies, links): each record that takes part, its group's least id, and
    how many copies and how many links between different texts its class has. A group's
    links need the share in parts of PART or more runs that the banded alignment keeps in
    order; runs that lie scattered don't make two records versions of one text."""
    found, members = links(spark, sf_dir)
    found = found.filter(F.col("parts") >= SHARE)
    sizes = members.groupBy("rep").agg(F.count("*").alias("copies"))
    group = components(found, sizes.select(F.col("rep").alias("node")))
    count = found.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    of = sizes.join(group.toDF("rep", "group_id"), "rep").join(count, "rep", "left")
    return members.join(of, "rep").select("id", "group_id", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


_P = "'[\\p{L}\\p{N}]+'"
SQL = {
    "p7_found": f"""WITH w AS (SELECT id, list_concat(regexp_extract_all(lower(coalesce(title, '')), {_P}), regexp_extract_all(lower(body), {_P})) AS w FROM releases WHERE len(regexp_extract_all(lower(body), {_P})) >= 60),
 g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w),
 n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
 s AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2)
 SELECT id_a, id_b FROM s JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE c * 10 >= 6 * (x.n + y.n - c)""",
}
