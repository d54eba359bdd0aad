"""Quality flags of release rows, as Column predicates that stay in code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A body under so many code points counts as short.
SHORT = 300
#: Grades below the full text.
UPGRADABLE = ("teaser", "stub")
#: Sequences that UTF-8 taken for a single-byte charset leaves, and the C1 controls.
MARKS = ("â€", "Ã")
C1 = "[\\x{80}-\\x{9F}]"
LEAD_AND_TRAIL = "[ÃÂĂâ][\\x{80}-\\x{17F}\\x{20AC}]"


def size(text="body") -> Column:
    return F.length(F.coalesce(F.col(text), F.lit("")))


def teaser() -> Column:
    return F.coalesce(F.col("grade").isin(*UPGRADABLE), F.lit(False))


def short() -> Column:
    return size() < SHORT


def empty() -> Column:
    return size() == 0


def nodate() -> Column:
    return F.coalesce(F.col("date"), F.lit("")) == ""


def mojibake(text="body") -> Column:
    body = F.coalesce(F.col(text), F.lit(""))
    hit = body.rlike(C1)
    for mark in MARKS:
        hit = hit | body.contains(mark)
    return hit


def damaged(text="body") -> Column:
    """The repair's own, narrower detector: a C1 control, or a lead and a trail together."""
    body = F.coalesce(F.col(text), F.lit(""))
    return body.rlike(C1) | body.rlike(LEAD_AND_TRAIL)


def plain() -> Column:
    low = F.lower(F.coalesce(F.col("url"), F.lit("")))
    return F.col("body_html").isNull() & ~low.endswith(".pdf") & ~low.endswith(".doc")


#: Flags by name, for filters that take a list of names; unknown names are ignored.
FLAGS = {"teaser": teaser, "short": short, "nodate": nodate, "mojibake": mojibake, "plain": plain}


def all_of(names) -> Column:
    condition = F.lit(True)
    for name in names:
        if name in FLAGS:
            condition = condition & FLAGS[name]()
    return condition
