"""Normalising mixed date and time spellings to one unambiguous form (problem 6).

All spellings are compiled into ONE alternation with named groups. A value is matched
once, its components are read once, calendar ranges are checked, and instants are put
together by integer day arithmetic. Zone rules come from the IANA tables.

Defined results: null, blank, unknown and impossible values (30 February, hour 25) give
null; ``YYYY``, ``YYYY-MM`` and ``YYYY-MM-DD`` are already normal and come out unchanged
from ``normalise`` (``p6_found`` leaves them out). A source without tags counts as UTC
and day first.
"""

from __future__ import annotations

import re
from datetime import datetime
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import table

# Month names by month, in English, German, French, Spanish, Polish, Russian.
MONTHS = {
    1: "january jan januar jänner jän janvier janv enero ene stycznia styczeń sty января январь янв",
    2: "february feb februar février févr fév febrero lutego luty lut февраля февраль фев",
    3: "march mar märz mär mrz mars marzo marca marzec марта март мар",
    4: "april apr avril avr abril abr kwietnia kwiecień kwi апреля апрель апр",
    5: "may mai mayo maja maj мая май",
    6: "june jun juni juin junio czerwca czerwiec cze июня июнь июн",
    7: "july jul juli juillet juil julio lipca lipiec lip июля июль июл",
    8: "august aug août agosto ago sierpnia sierpień sie августа август авг",
    9: "september sep sept septembre septiembre września wrzesień wrz сентября сентябрь сен сент",
    10: "october oct oktober okt octobre octubre października październik paź октября октябрь окт",
    11: "november nov novembre noviembre listopada listopad lis ноября ноябрь ноя",
    12: "december dec dezember dez décembre déc diciembre dic grudnia grudzień gru декабря декабрь дек",
}
MONTH_OF = {w: m for m, words in MONTHS.items() for w in words.split()}

# Minutes east of Greenwich of zone abbreviations that name one offset.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "MEZ": 60, "CET": 60, "MESZ": 120,
    "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
# Abbreviations that mean the local time of a place.
ZONE_PLACE = {"ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles"}

_WORD = "|".join(sorted(MONTH_OF, key=len, reverse=True))
_ZONES = "|".join(sorted([*ZONE_MINUTES, *ZONE_PLACE], key=len, reverse=True))
_DAY = r"(?:\w{2,12}\.?,?\s+)?"  # a weekday's name
_TIME = (
    r"(?:(?:\s*,\s*|\s+|[Tt]|\s+(?:at|um|à|a\s+las|o|в)\s+)"
    r"(?P<hour{0}>\d{{1,2}})[:.h](?P<minute{0}>\d{{2}})(?::(?P<second{0}>\d{{2}})(?:[.,]\d+)?)?"
    r"(?:\s*(?P<half{0}>[ap])\.?m\.?)?(?:\s*Uhr|\s*h)?"
    r"\s*(?P<zone{0}>[+-]\d{{2}}:?\d{{2}}|[+-]\d{{2}}|(?:" + _ZONES + r"))?)?"
)
# One alternative a spelling; the digit at the end of a group's name is the alternative's.
_FORMS = [
    r"(?P<year0>\d{4})-(?P<month0>\d{1,2})(?:-(?P<day0>\d{1,2})" + _TIME.format(0) + ")?",
    r"(?P<year1>\d{4})-(?P<ordinal1>\d{3})",
    r"(?P<year2>\d{4})-?W(?P<week2>\d{2})-?(?P<weekday2>\d)",
    r"(?P<year3>\d{4})(?P<month3>\d{2})(?P<day3>\d{2})(?:T(?P<hour3>\d{2}):?(?P<minute3>\d{2})(?::?(?P<second3>\d{2})(?:[.,]\d+)?)?(?P<zone3>Z|[+-]\d{2}:?\d{2})?)?",
    r"(?P<year4>\d{4})(?P<month4>\d{2})(?P<day4>\d{2})(?P<hour4>\d{2})(?P<minute4>\d{2})(?P<second4>\d{2})",
    r"(?P<milli5>\d{12,13})|(?P<epoch5>\d{9,10})(?:\.\d+)?",
    r"(?P<year6>\d{4})[/.](?P<month6>\d{1,2})[/.](?P<day6>\d{1,2})" + _TIME.format(6),
    r"(?P<first7>\d{1,2})/(?P<second_part7>\d{1,2})/(?P<year7>\d{4}|\d{2})" + _TIME.format(7),
    r"(?:[^\d,]{2,40},\s*)?(?P<day8>\d{1,2})\.\s?(?P<month8>\d{1,2})\.\s?(?P<year8>\d{4}|\d{2})" + _TIME.format(8),
    r"(?:[^\d,]{2,40},\s*)?" + _DAY + r"(?P<day9>\d{1,2})(?:st|nd|rd|th|er|\.|º)?[\s-]*(?:de\s+|of\s+)?(?P<name9>" + _WORD + r")\.?,?[\s-]*(?:de\s+|del\s+)?(?P<year9>\d{4})(?:\s*(?:г\.?|r\.?|года|roku))?" + _TIME.format(9),
    _DAY + r"(?P<nameA>" + _WORD + r")\.?\s+(?P<dayA>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<yearA>\d{4})" + _TIME.format("A"),
    r"(?P<nameB>" + _WORD + r")\.?,?\s+(?:de\s+|of\s+)?(?P<yearB>\d{4})",
]
SPELLING = re.compile(r"\s*(?:" + "|".join(_FORMS) + r")\s*", re.IGNORECASE)
NORMAL = re.compile(r"\d{4}(?:-\d{2}(?:-\d{2})?)?", re.ASCII)
_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def _leap(year: int) -> bool:
    return year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)


def _days_in(year: int, month: int) -> int:
    return _DAYS[month - 1] + (month == 2 and _leap(year))


def _day_number(year: int, month: int, day: int) -> int:
    """Days since 1970-01-01 of a date of the Gregorian calendar."""
    before = year - 1
    return before * 365 + before // 4 - before // 100 + before // 400 + sum(_DAYS[: month - 1]) + (month > 2 and _leap(year)) + day - 719163


def _date_of(number: int) -> tuple[int, int, int]:
    """The inverse of ``_day_number``."""
    z = number + 719468
    era, of_era = divmod(z, 146097)
    year = (of_era - of_era // 1460 + of_era // 36524 - of_era // 146096) // 365
    day = of_era - (365 * year + year // 4 - year // 100)
    shifted = (5 * day + 2) // 153
    month = shifted + 3 if shifted < 10 else shifted - 9
    return year + era * 400 + (month <= 2), month, day - (153 * shifted + 2) // 5 + 1


@lru_cache(maxsize=256)
def _zone(name: str) -> ZoneInfo:
    return ZoneInfo(name)


def _offset(place: str, year: int, month: int, day: int, hour: int, minute: int, second: int) -> int:
    """Seconds east of Greenwich. fold=0 gives the earlier of two moments, and in a gap
    the offset before the change."""
    return int(datetime(year, month, day, hour, minute, second, tzinfo=_zone(place), fold=0).utcoffset().total_seconds())


def _instant(seconds: int) -> str | None:
    days, rest = divmod(seconds, 86400)
    year, month, day = _date_of(days)
    if not 1 <= year <= 9999:
        return None
    return f"{year:04d}-{month:02d}-{day:02d}T{rest // 3600:02d}:{rest // 60 % 60:02d}:{rest % 60:02d}Z"


@lru_cache(maxsize=100_000)
def normalise(value: str | None, place: str | None = "UTC", dayfirst: bool | None = True) -> str | None:
    """The one form of ``value``: ``YYYY``, ``YYYY-MM``, ``YYYY-MM-DD`` or a UTC instant.

    ``place`` is the IANA zone of times without one (null: UTC), ``dayfirst`` the reading
    of slashes with the year last (null: day first).
    """
    if value is None:
        return None
    if NORMAL.fullmatch(value):
        year, month, day = [*map(int, value.split("-")), 1, 1][:3]
        return value if year and 1 <= month <= 12 and 1 <= day <= _days_in(year, month) else None
    found = SPELLING.fullmatch(value)
    if not found:
        return None
    got: dict[str, str] = {k[:-1]: v for k, v in found.groupdict().items() if v is not None}
    if "milli" in got or "epoch" in got:
        return _instant(int(got["milli"]) // 1000 if "milli" in got else int(got["epoch"]))
    year = int(got["year"])
    if len(got["year"]) == 2:
        year += 1900 if year >= 96 else 2000
    if year < 1:
        return None
    if "ordinal" in got:
        nth = int(got["ordinal"])
        if not 1 <= nth <= 365 + _leap(year):
            return None
        return "%04d-%02d-%02d" % _date_of(_day_number(year, 1, 1) + nth - 1)
    if "week" in got:
        week, weekday = int(got["week"]), int(got["weekday"])
        start = _day_number(year, 1, 4)
        monday, following = start - (start + 3) % 7, _day_number(year + 1, 1, 4)
        weeks = (following - (following + 3) % 7 - monday) // 7
        if not (1 <= week <= weeks and 1 <= weekday <= 7):
            return None
        return "%04d-%02d-%02d" % _date_of(monday + 7 * (week - 1) + weekday - 1)
    if "name" in got:
        month = MONTH_OF[got["name"].lower()]
    elif "first" in got:
        a, b = int(got["first"]), int(got["second_part"])
        got["day"], month = (str(a), b) if dayfirst in (True, None) else (str(b), a)
    else:
        month = int(got["month"])
    if not 1 <= month <= 12:
        return None
    if "day" not in got:
        return f"{year:04d}-{month:02d}"
    day = int(got["day"])
    if not 1 <= day <= _days_in(year, month):
        return None
    if "hour" not in got:
        return f"{year:04d}-{month:02d}-{day:02d}"
    hour, minute, second = int(got["hour"]), int(got["minute"]), int(got.get("second", 0))
    if half := got.get("half"):
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half.lower() == "p" else 0)
    if hour > 23 or minute > 59 or second > 59:
        return None
    seconds = _day_number(year, month, day) * 86400 + hour * 3600 + minute * 60 + second
    zone = got.get("zone")
    if zone and zone[0] in "+-":
        digits = zone[1:].replace(":", "").ljust(4, "0")
        if int(digits[2:]) > 59 or int(digits[:2]) > 18:
            return None
        offset = (int(digits[:2]) * 60 + int(digits[2:])) * (60 if zone[0] == "+" else -60)
    elif zone and zone.upper() in ZONE_MINUTES:
        offset = ZONE_MINUTES[zone.upper()] * 60
    elif not zone and found.group("second4") is not None:
        offset = 0  # 14 digits are a capture's stamp, in UTC
    else:
        offset = _offset(ZONE_PLACE[zone.upper()] if zone else place or "UTC", year, month, day, hour, minute, second)
    return _instant(seconds - offset)


@F.pandas_udf(T.StringType())
def normalise_udf(value: pd.Series, place: pd.Series, dayfirst: pd.Series) -> pd.Series:
    # Spark's nulls arrive as None or NaN, depending on the column's type
    return pd.Series(
        [normalise(v if isinstance(v, str) else None, p if isinstance(p, str) else None, None if f is None or f != f else bool(f)) for v, p, f in zip(value, place, dayfirst)],
        dtype=object,
    )


def with_normal_date(df: DataFrame, column: str, place, dayfirst, out: str = "norm") -> DataFrame:
    """Add ``out``, the normal form of ``column``; ``place`` and ``dayfirst`` are columns."""
    return df.withColumn(out, normalise_udf(F.col(column), place, dayfirst))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, rec_key, norm): the values that name a date in another than a normal form.

    The listing's place and day order are given by the data's contract. The tags table
    holds one row a source; Spark broadcasts it only while it is under the session's
    threshold.
    """
    other = (F.trim("value") != "") & ~F.col("value").rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$")
    tags = table(spark, sf_dir, "source_tags").select("source", "tz", "dayfirst").dropDuplicates(["source"])
    releases = table(spark, sf_dir, "releases").select(F.lit("releases").alias("rel"), F.col("id").cast("string").alias("rec_key"), F.col("date").alias("value"), "source").filter(other).join(tags, "source", "left")
    listing = table(spark, sf_dir, "terratec_early__listing_1").select(F.lit("terratec_early__listing_1").alias("rel"), F.col("url").alias("rec_key"), F.col("date_str").alias("value"), F.lit("Europe/Berlin").alias("tz"), F.lit(True).alias("dayfirst")).filter(other)
    both = releases.select(*listing.columns).unionByName(listing)
    return with_normal_date(both, "value", F.col("tz"), F.col("dayfirst")).filter("norm IS NOT NULL").select("rel", "rec_key", "norm").distinct()
