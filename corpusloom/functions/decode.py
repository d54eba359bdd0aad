"""Bytes to text, and the repair of single damaged strings (UDFs behind cheap guards)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.flags import damaged
from corpusloom.functions.text import C1_READ, undo_c1

#: Charsets that a UTF-8 text may have been taken for.
TAKEN_FOR = ("cp1252", "cp1258", "cp1250", "cp1254", "cp1257", "latin-1")
_LEAD_AND_TRAIL = re.compile("[ÃÂĂâ][\x80-ſ€]")
_C1 = re.compile("[\x80-\x9f]")


def decode_mixed(content: bytes | None) -> str | None:
    """UTF-8; bytes that aren't are read as Windows-1252, undefined ones as U+FFFD."""
    if content is None:
        return None
    out, at = [], 0
    while at < len(content):
        try:
            out.append(content[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as error:
            out += [content[at : at + error.start].decode("utf-8"), content[at + error.start : at + error.end].decode("cp1252", "replace")]
            at += error.end
    return "".join(out)


@F.pandas_udf(T.StringType())
def _decode_udf(content: pd.Series) -> pd.Series:
    return content.map(decode_mixed)


@F.pandas_udf(T.StringType())
def decode_cp1252(content: pd.Series) -> pd.Series:
    """Bytes of sources older than UTF-8."""
    return content.map(lambda b: None if b is None else bytes(b).decode("cp1252", "replace"))


def decode_html(content="content") -> Column:
    """Valid UTF-8 is cast within the JVM; only other bytes go to Python."""
    as_text = F.col(content).cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(_decode_udf(F.when(~F.is_valid_utf8(as_text), F.col(content))))


def clean(text: str) -> bool:
    return not (_C1.search(text) or _LEAD_AND_TRAIL.search(text) or "\ufffd" in text)


def undo_mojibake(text: str) -> tuple[str, str] | None:
    """(text, charset) where a charset that could have been taken for UTF-8 gives a clean text,
    and all that do agree on it; the charset is the first of them."""
    found: dict[str, str] = {}
    for charset in TAKEN_FOR:
        try:
            back = text.encode(charset).decode("utf-8")
        except UnicodeError:
            continue
        if clean(back):
            found.setdefault(back, charset)
    return next(iter(found.items())) if len(found) == 1 else None


def repaired(text: str | None) -> tuple[str | None, str]:
    """(text, method): what was done to the whole text, or the text as it was and ''.

    Sequences of a lead and a trail are undone first; if that can't be done for the whole
    text, nothing is. C1 controls are then read as Windows-1252. A repair that would lose a
    character isn't made. Repair leaves a repaired text alone.
    """
    if not text:
        return text, ""
    fixed, method = text, []
    if _LEAD_AND_TRAIL.search(fixed):
        if (undone := undo_mojibake(fixed)) is None:
            return text, ""
        fixed, method = undone[0], [f"utf8-read-as-{undone[1]}"]
    if _C1.search(fixed):
        fixed, method = fixed.translate(C1_READ), [*method, "cp1252-read-as-latin1"]
    if fixed == text or fixed.count("\ufffd") > text.count("\ufffd"):
        return text, ""
    return fixed, "+".join(method)


_REPAIRED = T.StructType([T.StructField("text", T.StringType()), T.StructField("method", T.StringType())])


@F.pandas_udf(_REPAIRED)
def _repair_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([repaired(t if isinstance(t, str) else None) for t in texts], columns=["text", "method"])


def repair(text="body") -> Column:
    """struct(text, method); sound texts don't leave the JVM."""
    return F.when(damaged(text), _repair_udf(F.when(damaged(text), F.col(text)))).otherwise(F.struct(F.col(text).alias("text"), F.lit("").alias("method")))


def undefined_bytes(text="body") -> Column:
    """The C1 controls that no Windows-1252 character stands for."""
    return F.regexp_extract_all(undo_c1(F.col(text)), F.lit("[\\x{81}\\x{8D}\\x{8F}\\x{90}\\x{9D}]"), F.lit(0))
