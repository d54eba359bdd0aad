"""Gates between an old text and a new one: what a rewrite keeps, adds and loses.

Lengths and containment are settled within the JVM; only pairs they leave open reach the
Python tests.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import squash, word_characters

#: A short old text may be replaced by one over GROWTH times as long; a loss of up to LOSS is taken.
SHORT, GROWTH, LOSS, A_LIST_ITEM = 400, 2, 0.02, 2


def subsequence(old: str, new: str) -> bool:
    """True if all of old comes in new, in order."""
    rest = iter(new)
    return all(c in rest for c in old)


@F.pandas_udf(T.BooleanType())
def is_subsequence(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([subsequence(a or "", b or "") for a, b in zip(old, new)], dtype=bool)


def edges_only(old: str, new: str) -> Column:
    """The new text is a stretch of the old: only its edges went."""
    return F.contains(word_characters(F.coalesce(F.col(old), F.lit(""))), word_characters(F.coalesce(F.col(new), F.lit(""))))


def removed(old: str, new: str) -> Column:
    """The share of characters that went."""
    a, b = (F.length(word_characters(F.coalesce(F.col(c), F.lit("")))) for c in (old, new))
    return F.when(a == 0, F.lit(0.0)).otherwise((a - b) / a)


def safe_to_write(old: str, new: str) -> Column:
    """Why a rewrite is safe: edges, grown, small_loss, kept; or lost."""
    a, b = (F.length(F.coalesce(F.col(c), F.lit(""))) for c in (old, new))
    x, y = (word_characters(F.coalesce(F.col(c), F.lit(""))) for c in (old, new))
    cheap = F.when(edges_only(old, new), "edges").when((a < SHORT) & (b > GROWTH * a), "grown").when((removed(old, new) > 0) & (removed(old, new) <= LOSS), "small_loss")
    open_pair = cheap.isNull()
    return F.coalesce(cheap, F.when(is_subsequence(F.when(open_pair, x), F.when(open_pair, y)), "kept").otherwise("lost"))


def same_text(old: str, new: str) -> Column:
    return squash(F.coalesce(F.col(old), F.lit(""))) == squash(F.coalesce(F.col(new), F.lit("")))


def not_shorter(old: str, new: str) -> Column:
    return F.length(F.coalesce(F.col(new), F.lit(""))) >= F.length(F.coalesce(F.col(old), F.lit("")))


def same_characters(old: str, new: str, drops: str = "") -> bool:
    """True if the texts hold the same letters and digits, but for ``drops`` and, for each
    list item of the new, up to two characters that are digits or ``o``."""
    a, b = (Counter(re.sub(r"\W+", "", t)) for t in (old, new))
    gone, come = a - b - Counter(drops), b - a
    items = len(re.findall(r"(?m)^(?:• |\d+\. )", new))
    loose = lambda c: c.isdigit() or c == "o"
    return all(map(loose, (gone + come))) and sum((gone + come).values()) <= A_LIST_ITEM * items


@F.pandas_udf(T.BooleanType())
def same_words(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([same_characters(a or "", b or "") for a, b in zip(old, new)], dtype=bool)
