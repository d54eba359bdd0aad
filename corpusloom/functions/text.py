"""Scalar text functions, all within the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The number of a month by its German and English name.
MONTH_NUMBERS = {name: i for i, names in enumerate(("januar january", "februar february", "märz march", "april", "mai may", "juni june", "juli july", "august", "september", "oktober october", "november", "dezember december"), 1) for name in names.split()}
_FOLDED = {c: d[0] for c in map(chr, range(0xC0, 0x250)) if len(d := unicodedata.normalize("NFD", c)) > 1}
ACCENTS, BARE = "".join(_FOLDED), "".join(_FOLDED.values())


def fold(text) -> Column:
    """Lower case without the accents of precomposed Latin letters."""
    return F.translate(F.lower(text), ACCENTS, BARE)


def collapse(text) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def squash(text) -> Column:
    """Without white space and bullets."""
    return F.regexp_replace(text, r"(?U)[\s•]+", "")


def word_characters(text) -> Column:
    """Letters and digits alone, without the numbers that begin lines."""
    return F.regexp_replace(F.regexp_replace(text, r"(?mU)^\s*\d+[.)]\s+", ""), r"(?U)\W+", "")


def title_key(text) -> Column:
    return F.lower(collapse(text))


def slug(text, default: str = "release") -> Column:
    made = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(made == "", default).otherwise(made)


def synthetic_url(url: Column, title: Column, date: Column) -> Column:
    """The row's own address, or one made of its title and date."""
    dated = F.when(F.coalesce(date, F.lit("")) == "", "undated").otherwise(date)
    return F.coalesce(F.when(url != "", url), F.concat(F.lit("/press/"), slug(F.coalesce(title, F.lit(""))), F.lit("-"), dated))


def without_repeat(text: Column) -> Column:
    """A title cut before the second coming of its first twenty characters."""
    head = F.substring(text, 1, 20)
    at = F.call_function("locate", head, text, F.lit(21))
    return F.when((F.length(text) > 20) & (at > 0), F.rtrim(text.substr(F.lit(1), at - 1))).otherwise(text)


def normal_layout(text) -> Column:
    """Unix line ends, no form feeds, no blanks at line ends, one empty line at most."""
    text = F.regexp_replace(text, "\r\n?|\f", "\n")
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    return F.trim(F.regexp_replace(text, r"\n{3,}", "\n\n"), F.lit(" \n\t"))


def artefacts(text) -> Column:
    """(doubled pairs of words, numbers run together, capitals within words)."""
    count = lambda pattern: F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.struct(count(r"\b(\w+ \w+) \1\b").alias("doubled"), count(r"\d{2,}[.,]\d+[.,]\d{3,}").alias("merged"), count(r"[a-z][A-Z]").alias("inner_capitals"))


def month_date(year: Column, month: Column, day: Column | None = None) -> Column:
    """ISO text of a date in words; '' for an unknown month."""
    number = F.lit(None).cast("int")
    for name, n in MONTH_NUMBERS.items():
        number = F.when(F.lower(month) == name, n).otherwise(number)
    parts = [year, F.lpad(number.cast("string"), 2, "0")] + ([F.lpad(day, 2, "0")] if day is not None else [])
    return F.coalesce(F.concat_ws("-", *[F.when(number.isNotNull(), p) for p in parts]), F.lit(""))


def german_date(text) -> Column:
    """``d.m.yyyy`` or ``d. Monat yyyy``, whichever comes first, else ``Month d, yyyy``; '' otherwise."""
    words = "|".join(sorted(MONTH_NUMBERS, key=len, reverse=True))
    numeric, named, english = r"(\d{1,2})\.(\d{1,2})\.(\d{4})", rf"(?i)(\d{{1,2}})\. ({words}) (\d{{4}})", rf"(?i)({words}) (\d{{1,2}}), (\d{{4}})"
    part = lambda pattern, i: F.regexp_extract(text, pattern, i)
    place = lambda pattern: F.when(part(pattern, 0) == "", 1 << 30).otherwise(F.call_function("locate", part(pattern, 0), text))
    by_number = F.concat_ws("-", part(numeric, 3), F.lpad(part(numeric, 2), 2, "0"), F.lpad(part(numeric, 1), 2, "0"))
    by_name, by_english = month_date(part(named, 3), part(named, 2), part(named, 1)), month_date(part(english, 3), part(english, 1), part(english, 2))
    return F.when((part(numeric, 0) != "") & (place(numeric) <= place(named)), by_number).when(part(named, 0) != "", by_name).when(part(english, 0) != "", by_english).otherwise("")


def month_year(title: Column) -> Column:
    """struct(title, date): a title that ends in a month and a year, in words, split into what
    stands before them and ``YYYY-MM``; others as they are, with ''."""
    words = "|".join(sorted(MONTH_NUMBERS, key=len, reverse=True))
    pattern = rf"(?iu)^(.*?)[\s,(–-]*\b({words})\s+(\d{{4}})\)?\s*$"
    part = lambda i: F.regexp_extract(title, pattern, i)
    date = month_date(part(3), part(2))
    return F.struct(F.when(part(3) != "", part(1)).otherwise(title).alias("title"), F.when(part(3) != "", date).otherwise("").alias("date"))


def month_range_date(text: Column) -> Column:
    """``YYYY-MM`` of a name such as ``news_0304``, ``roundup-2003-04`` or ``april2003``; ''."""
    words = "|".join(sorted(MONTH_NUMBERS, key=len, reverse=True))
    low = F.lower(text)
    full, short = r"((?:19|20)\d{2})[-_]?(0[1-9]|1[0-2])(?!\d)", r"(?<!\d)(\d{2})(0[1-9]|1[0-2])(?!\d)"
    named = rf"(?:^|[^a-zäöü])({words})[-_]?((?:19|20)\d{{2}})"
    x = lambda p, i: F.regexp_extract(low, p, i)
    century = F.when(x(short, 1) >= "70", "19").otherwise("20")
    return F.when(x(named, 0) != "", month_date(x(named, 2), x(named, 1))).when(x(full, 0) != "", F.concat_ws("-", x(full, 1), x(full, 2))).when(x(short, 0) != "", F.concat(century, x(short, 1), F.lit("-"), x(short, 2))).otherwise("")


def year_span(first: Column, last: Column) -> Column:
    """'2002–2006', a single year, or ''."""
    a, b = F.substring(F.coalesce(first, F.lit("")), 1, 4), F.substring(F.coalesce(last, F.lit("")), 1, 4)
    return F.when(a == b, a).when(a == "", b).when(b == "", a).otherwise(F.concat(a, F.lit("–"), b))


#: What Windows-1252 has at the numbers of the C1 controls, without the five it leaves undefined.
C1_READ = {n: c for n, c in enumerate(bytes(range(256)).decode("cp1252", "replace")) if 0x80 <= n < 0xA0 and c != "\ufffd"}


def undo_c1(text: Column) -> Column:
    """C1 controls as the Windows-1252 characters of their numbers; the five undefined ones stay."""
    return F.translate(text, "".join(map(chr, C1_READ)), "".join(C1_READ.values()))
