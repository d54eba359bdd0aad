"""Template residue and error-page text (problem 1).

Every visible passage (line or block) of every record gets a 64-bit SimHash of its masked
words, from which addresses, numbers, codes and names in programs' messages are left out.
Trusted labels come from what says so itself, in any language: pages that show nothing but
a heading with the words of their title, what pages tell readers without scripts, reports
of servers and programs, the usual Latin filler. Those passages are the seeds. They are
joined with all passages through partitioned tables (the four 16-bit blocks of the SimHash,
by bands of length), where a seed looks up its own blocks and all that differ in one or two
bits, so any passage within HAMMING bits is met in some block; what meets is verified by
Hamming distance and by the Jaccard similarity of its five-word runs (0.8 or more). The
trusted label then spreads along verified links until no passage is new, which labels
exactly the connected components that hold a seed, while passages far from any seed are
never compared with one another.

The tables are made once; only the seeds' side of a join grows with residue, and a passage
that a third of all records show is one row for the comparison.

Defined results: null and empty texts hold no passage; a passage of fewer than five words
is similar only to itself; a placeholder inside a real sentence marks the record but does
not spread, as the sentence's other copies are sound.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.charset import read_records
from corpusloom.session import written

#: Most bits in which verified passages may differ (four blocks, three bits each, less one), and least similarity of their word runs.
HAMMING, SIMILARITY, RUN = 11, 0.8, 5
#: Most words of a page whose headings, repeating its title, are all that it shows.
BARE = 40

#: Forms of unfilled placeholders.
PLACEHOLDER = re.compile(
    r"""\{\{\s*[\w.|\- ]{1,60}\s*\}\}|\{%-?\s*\w[^%{}\n]{0,80}%\}|[$#]?\{\$?[A-Za-z_][\w.]{0,40}\}
    |<%[=-]?\s*\w[^%\n]{0,80}%>|<\?(?:php|=)[^?\n]{1,80}\?>|<!--\#\w[^>\n]{0,60}-->|<<\s?[A-Za-z_][\w ]{0,40}>>
    |\#\#[A-Za-z_]\w{1,40}\#\#|%%[A-Za-z_]\w{1,40}%%|@@[A-Za-z_]\w{1,40}@@|\$\$[A-Za-z_]\w{1,40}\$\$|__[A-Z][A-Z_]{1,40}__
    |\[\[\s?[A-Za-z_]\w{1,40}\s?\]\]|%\([A-Za-z_]\w{0,40}\)[sdf]|\[[A-Z][A-Z_]{2,40}\]|\bX{2,4}[./-]X{2,4}[./-]X{2,4}\b""",
    re.VERBOSE,
)
#: A sentence that names a pattern, template or placeholder talks about it.
MENTION = re.compile(
    r"(?i)\b(?:pattern|placeholder|template|syntax|muster|platzhalter|vorlage|motif|modèle|gabarit|patrón|plantilla|marcador|wzór|wzorz\w+|szablon\w*|шаблон\w*|образ(?:ец|ц)\w*)\b"
    r".{0,40}\b(?:such as|like|called|wie|namens|comme|tel(?:le)? que|como|llamad\w|jak|typu|np|как|вроде|типа|вида)\b"
)
#: Forms by which servers and runtimes report, whatever the language around
#: them: status numbers behind the word for error, and messages of programs.
REPORTS = (
    r"(?:bad gateway|gateway time-?out|service (?:temporarily )?unavailable|internal server error)\b|(?:http|error|fehler|erreur|błąd|ошибка)[ :/-]{1,3}[45]\d\d\b(?!.{0,40}\bonly\b)|[45]\d\d[ -]+(?:page |file )?not found|err_[a-z]+"
    r"|(?:php )?(?:fatal|parse) error:|(?:php )?(?:warning|notice): \w+\(|exception in thread|traceback \(most|odbc driver error|microsoft ole db|you have an error in your sql"
    r"|\[an error occurred while|index of /|object moved\b.{0,40}\bfound here"
)
#: How the usual filler and notes to the writer begin.
FILLER = r"lorem ipsum|(?:todo|tbd|fixme)\s*:|(?:headline|title|text|copy|caption|name) goes here"
TRUSTED = re.compile(rf"\W{{0,3}}(?:{REPORTS}|{FILLER})")  # of lower-cased passages
#: What a page tells readers without scripts speaks of scripts, in any language.
SCRIPTS = re.compile(r"(?i)s[ck]r[iy]pt|скрипт")
#: A bracket that tells the writer what to put there.
BRACKET = re.compile(r"(?i)\[[^\[\]\n]{0,60}\b(?:insert|add|enter|place|einfügen|einsetzen|ergänzen|insérer|ajouter|insertar|añadir|wstaw|wstawić|dodaj|вставьте|вставить|добавьте)\b[^\[\]\n]{0,60}\]")
#: The words of the usual Latin filler.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation "
    "ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat "
    "non proident sunt culpa qui officia deserunt mollit anim id est laborum massa porta augue vitae urna semper tempus orci eros ligula feugiat nullam sodales vestibulum mauris "
    "pellentesque curabitur donec praesent vivamus faucibus lectus sapien tincidunt turpis purus risus metus nunc quam erat libero justo felis arcu nec at ac a mi leo cras morbi "
    "aliquam diam dui egestas fusce gravida habitant iaculis integer lacus maecenas malesuada mattis nam neque nibh odio phasellus placerat posuere pretium proin pulvinar rhoncus "
    "rutrum sagittis scelerisque sem suspendisse tellus tortor tristique ultrices ultricies varius vel vehicula venenatis viverra volutpat".split()
)
_WORD = re.compile(r"\w+")
_MARKED = re.compile(r"[{<#%@$_\[X]")
_HOST = re.compile(r"\.(?:example|com|org|net|de|fr|es|pl|ru)\b")
_SITE = re.compile(r"\b(?:www\.)?[\w-]+\.(?:example|com|org|net|de|fr|es|pl|ru)\b")
_PATH = re.compile(r"(?<![\w<])/[\w./?=&%-]+")
_DIGIT = re.compile(r"\d")
#: A status number put before a message; what programs name: "x", 'x', a.b(), f().
_STATUS = re.compile(r"^\W*https? (?:error )?[1-5]\d\d\s*[-–:]\s*")
_NAMED = re.compile(r"\"[\w-]{1,30}\"|'[\w-]{1,30}'|\b[\w.]{2,40}\((?:unknown source)?\)|(?<=upstream )\w+")
#: Numbers, and words of six or more hexadecimal digits.
_NUMBER = re.compile(r"\b(?:\d\w*|[a-f](?=[a-f]*\d)[0-9a-f]{5,}\b)")
_DROPPED = re.compile(r"(?is)<!--.*?-->|<(script|style|noscript|title|head)\b.*?</\1\s*>|<!doctype[^>]*>")
_BLOCKS = re.compile(r"(?i)</?(?:p|div|li|ul|ol|td|th|tr|table|h[1-6]|br|hr|body|html|main|article|nav|aside|footer|header|section|form|small|pre|blockquote|dl|dt|dd)\b[^>]*>")
_TAGS = re.compile(r"</?[A-Za-z][^>]*>")
_TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)</title")
_NOSCRIPT = re.compile(r"(?is)<noscript\b[^>]*>(.*?)</noscript")
_HEADING = re.compile(r"(?is)<h1\b[^>]*>.*?</h1>")


def passages(rel: str, text: str) -> list[str]:
    """The visible passages of a record: a body's lines, a page's blocks."""
    if rel == "page_cache":
        text = _DROPPED.sub(" ", text)
        text = _BLOCKS.sub("\x00", text.replace("\n", " "))
        return [p for x in _TAGS.sub("", text).split("\x00") if (p := " ".join(html.unescape(x).split()))]
    return [p for x in text.split("\n") if (p := " ".join(x.split()))]


def notices(source: str) -> list[str]:
    """What a page shows in place of scripts: trusted notices, though not shown themselves."""
    if "<noscript" not in source and "<NOSCRIPT" not in source:
        return []
    found = (" ".join(html.unescape(_TAGS.sub(" ", x)).split()) for x in _NOSCRIPT.findall(source))
    return [x for x in found if SCRIPTS.search(x)]


def bare(source: str, shown: list[str]) -> bool:
    """True for a page that shows a heading with the words of its title and nothing else, as
    servers answer in place of an article."""
    if sum(len(p.split()) for p in shown) > BARE or not (title := _TITLE.search(source)) or not shown:
        return False
    title = " ".join(html.unescape(title[1]).split())
    rest = _HEADING.sub(" ", _DROPPED.sub(" ", source))
    return bool(title) and shown[0].startswith(title) and not html.unescape(_TAGS.sub("", rest)).strip()


def placeholder(passage: str) -> bool:
    """True for an unfilled part in use, not in a sentence that talks about such parts."""
    if not _MARKED.search(passage):
        return False
    return any(not MENTION.search(passage[max(0, m.start() - 90) : m.start()]) for m in PLACEHOLDER.finditer(passage)) or bool(BRACKET.search(passage))


def trusted(passage: str) -> bool:
    """True for a passage that is residue as a whole."""
    low = passage.lower()
    if TRUSTED.match(low):
        return True
    words = _WORD.findall(low)
    return len(words) >= 5 and sum(map(LATIN.__contains__, words)) >= 0.8 * len(words)


def masked(passage: str) -> str:
    """The passage's words, lower-cased, without what differs from copy to copy: addresses,
    numbers, codes, names in programs' messages."""
    passage = passage.lower()
    if _HOST.search(passage):
        passage = _SITE.sub(" ", passage)
    if "/" in passage:
        passage = _PATH.sub(" ", passage)
    if '"' in passage or "'" in passage or "(" in passage:
        passage = _NAMED.sub(" ", passage)
    if _DIGIT.search(passage):
        passage = _NUMBER.sub(" ", _STATUS.sub("", passage))
    return " ".join(_WORD.findall(passage))


_HASHES: dict[str, int] = {}


def _hash(word: str) -> int:
    if (h := _HASHES.get(word)) is None:
        if len(_HASHES) > 150_000:
            _HASHES.clear()
        h = _HASHES[word] = xxhash.xxh3_64_intdigest(word)
    return h


def simhashes(texts: list[str]) -> np.ndarray:
    """64-bit SimHash (signed) of each masked text, over its words and pairs of words."""
    if not texts:
        return np.zeros(0, np.int64)
    words: list[int] = []
    starts = []
    for text in texts:
        starts.append(len(words))
        words += map(_hash, text.split() or [""])
    one = np.array(words, np.uint64)
    pair = (one * np.uint64(0x9E3779B97F4A7C15)) ^ np.roll((one << np.uint64(31)) | (one >> np.uint64(33)), -1)
    pair[np.array([*starts[1:], len(words)]) - 1] = one[np.array([*starts[1:], len(words)]) - 1]  # a text's last word has no pair
    features = np.column_stack((one, pair)).ravel()
    edges, sizes = np.array(starts) * 2, np.diff([*starts, len(words)]) * 2
    out = np.zeros(len(texts), np.uint64)
    for bit in range(64):
        ones = np.add.reduceat(((features >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), edges)
        out |= (ones * 2 > sizes).astype(np.uint64) << np.uint64(bit)
    return out.view(np.int64)


def similar(a: str, b: str) -> bool:
    """True if the five-word runs of two masked texts share 0.8 of their union."""
    x, y = a.split(), b.split()
    if len(x) < RUN or len(y) < RUN:
        return a == b
    x, y = {*zip(*(x[i:] for i in range(RUN)))}, {*zip(*(y[i:] for i in range(RUN)))}
    return len(x & y) >= SIMILARITY * len(x | y)


@F.pandas_udf(T.BooleanType())
def similar_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similar(x, y) for x, y in zip(a, b)], dtype=bool)


_VARYING = re.compile(r"[\d/\"'(]|\.[a-z]")


def judged(passage: str) -> tuple[bool, bool, str]:
    """(trusted, placeholder, masked) of a passage, its words found once where masks change none."""
    low = passage.lower()
    if _VARYING.search(low):
        return trusted(passage), placeholder(passage), masked(passage)
    words = _WORD.findall(low)
    seed = bool(TRUSTED.match(low)) or (len(words) >= 5 and sum(map(LATIN.__contains__, words)) >= 0.8 * len(words))
    return seed, placeholder(passage), " ".join(words)


_KNOWN: dict[str, tuple[bool, bool, str]] = {}


def _work(rel: str, text: str, garbled: bool) -> list[tuple]:
    """(seed, in_use, shown, masked) of each distinct passage: whether it is trusted for
    residue as a whole, holds a placeholder in use, is shown at all."""
    out = {}
    found = passages(rel, text)
    lone = rel == "page_cache" and bare(text, found)
    for p in found:
        if (known := _KNOWN.get(p)) is None:
            known = judged(p)
            if len(p) < 100:  # menus and the like come again and again
                if len(_KNOWN) > 50_000:
                    _KNOWN.clear()
                _KNOWN[p] = known
        seed, in_use, m = known
        if (seed or in_use or m) and (m not in out or not (out[m][0] or out[m][1])):
            out[m] = (seed or (lone and not in_use and " " in m), in_use, True, m)
    if rel == "page_cache":
        for p in notices(text):
            if (m := masked(p)) and m not in out:
                out[m] = (True, False, False, m)
    return [*out.values()]


def add_hashes(batch: pd.DataFrame) -> pd.DataFrame:
    """A batch of passages with the hash, the SimHash and the number of distinct five-word
    runs of their masked texts."""
    texts = [t if isinstance(t, str) else "" for t in batch["masked"]]
    distinct = dict.fromkeys(texts)
    sizes = []
    for t in distinct:
        w = t.split()
        sizes.append(len({*zip(w, w[1:], w[2:], w[3:], w[4:])}) if len(w) >= RUN else 0)
    distinct = dict(zip(distinct, zip(simhashes([*distinct]).tolist(), sizes)))
    return batch.assign(h=np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64), simhash=np.array([distinct[t][0] for t in texts], np.int64), runs=np.array([distinct[t][1] for t in texts], np.int32))


add_hashes.columns = "h long, simhash long, runs int"


def _band() -> Column:
    """Passages whose runs share SIMILARITY of their union lie in the same or the next band."""
    return F.floor(F.log(F.col("runs")) / math.log(1 / SIMILARITY)).cast("int")


def _blocks(df: DataFrame) -> DataFrame:
    """A row a table: the block's number and its 16 bits."""
    block = F.array(*[F.struct(F.lit(i).alias("i"), F.shiftrightunsigned("simhash", 16 * i).bitwiseAND(0xFFFF).alias("bits")) for i in range(4)])
    return df.withColumn("b", F.explode(block)).select(*df.columns, "b.i", "b.bits")


def _probes(blocks: DataFrame) -> DataFrame:
    """The blocks and those that differ from them in one or two bits, in their band and those beside."""
    masks = sorted({1 << i | 1 << j for i in range(16) for j in range(16)} | {0})
    flipped = blocks.select("*", F.explode(F.array(*map(F.lit, masks))).alias("flip")).withColumn("bits", F.col("bits").bitwiseXOR(F.col("flip").cast("long"))).drop("flip")
    return flipped.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))


def spread_labels(passage: DataFrame, seeds: DataFrame) -> DataFrame:
    """h of every passage in a component with a seed.

    Both are (h, simhash, runs, masked), a row a passage. Passages without a five-word run
    are similar to themselves only and stay out of the tables, which are made once. Each
    round joins only what the last one found, and ends when it found nothing.
    """
    tables = written(_blocks(passage.filter("runs > 0").select("h", "simhash", _band().alias("band"))), "residue-tables")
    known = seeds.select("h")
    frontier, found = seeds.filter("runs > 0"), None
    while True:
        near = _probes(_blocks(frontier.select(F.col("h").alias("from_h"), F.col("simhash").alias("from_simhash"), "simhash", _band().alias("band"))).drop("simhash"))
        pairs = tables.join(near, ["i", "bits", "band"]).filter(F.bit_count(F.col("simhash").bitwiseXOR(F.col("from_simhash"))) <= HAMMING).filter("h <> from_h").select("h", "from_h").distinct()
        new = pairs.join(known, "h", "left_anti").join(passage, "h").join(frontier.select(F.col("h").alias("from_h"), F.col("masked").alias("from_masked")), "from_h")
        new = written(new.filter(similar_udf("masked", "from_masked")).select("h", "simhash", "runs", "masked").dropDuplicates(["h"]), "residue-round")
        if new.isEmpty():
            return known if found is None else known.unionByName(found)
        known = known.unionByName(new.select("h"))
        frontier = new


def residue_records(spark: SparkSession, sf_dir: str, model=None, also=None) -> tuple[DataFrame, DataFrame]:
    """(rel, rec_key) of the records to leave out, and (rel, rec_key, source, other) of what
    ``also(rel, text)``, a function to a string or None, made of each record in the same pass."""
    cases, others = residue_reasons(spark, sf_dir, model, also)
    return cases.select("rel", "rec_key").distinct(), others


def residue_reasons(spark: SparkSession, sf_dir: str, model=None, also=None) -> tuple[DataFrame, DataFrame]:
    """(rel, rec_key, how), by what each record is one: 'placeholder', 'trusted', 'spread'; and
    the others as above."""

    def work(rel: str, text: str, garbled: bool) -> list[tuple]:
        rows = [(*x, None) for x in _work(rel, text, garbled)]
        return rows if also is None or (other := also(rel, text)) is None else [*rows, (None, None, None, None, other)]

    rows = read_records(spark, sf_dir, model, columns="seed boolean, in_use boolean, shown boolean, masked string, other string", work=work, finish=add_hashes)
    every = written(rows, "residue-passages")
    others = every.filter("other IS NOT NULL").select("rel", "rec_key", "source", "other")
    rows = every.filter("masked IS NOT NULL")
    distinct = rows.groupBy("h").agg(F.first("simhash").alias("simhash"), F.first("runs").alias("runs"), F.first("masked").alias("masked"), F.max("seed").alias("seed"))
    distinct = written(distinct, "residue-distinct")
    columns = ["h", "simhash", "runs", "masked"]
    labelled = spread_labels(distinct.filter("NOT seed").select(columns), distinct.filter("seed").select(columns))
    direct = rows.filter("shown AND (seed OR in_use)").select("rel", "rec_key", F.when(F.col("in_use"), "placeholder").otherwise("trusted").alias("how"))
    spread = rows.filter("shown AND NOT seed").select("rel", "rec_key", "h").join(labelled, "h", "left_semi").select("rel", "rec_key", F.lit("spread").alias("how"))
    return direct.unionByName(spread), others


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key) of the records that hold or are residue."""
    return residue_records(spark, sf_dir)[0]


def p1_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key, how): the cases with the firmest of what made them cases; 'spread' is a
    label that came along links alone."""
    cases, _ = residue_reasons(spark, sf_dir)
    place = F.when(F.col("how") == "placeholder", 3).when(F.col("how") == "trusted", 2).otherwise(1)
    return cases.groupBy("rel", "rec_key").agg(F.max_by("how", place).alias("how"))
