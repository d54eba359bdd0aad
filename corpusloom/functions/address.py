"""Algebra of archive addresses: ``<archive>/web/<14 digits>id_/<page>``, on strings alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where captures live; a parameter of every function that builds an address.
ARCHIVE = "https://web.archive.example/web/"
MARK = "id_/"


def is_capture(url) -> Column:
    return F.coalesce(F.col(url).rlike(r"^https?://[^/]+/web/\d{14}id_/."), F.lit(False))


def is_timestamp(text) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.rlike(r"^[0-9]{14}$"), F.lit(False))


def capture_url(timestamp: Column, page: Column, archive: str = ARCHIVE) -> Column:
    return F.concat(F.lit(archive), timestamp, F.lit(MARK), page)


def capture_key(detail_id="detail_id", url="url", archive: str = ARCHIVE) -> Column:
    """The address a row's own reference leads to; '' where that is no timestamp."""
    return F.when(is_timestamp(detail_id), F.coalesce(capture_url(F.col(detail_id), F.col(url), archive), F.lit(""))).otherwise("")


def timestamp_of(url) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"/web/(\d{14})id_/", 1)


def page_of(url) -> Column:
    """The page behind the first marker, or null."""
    at = F.instr(F.col(url), MARK)
    return F.when(at > 0, F.col(url).substr(at + len(MARK), F.length(F.col(url))))


def viewer_url(url) -> Column:
    """The address people look at: without the first marker."""
    at = F.instr(F.col(url), MARK)
    return F.when(at > 0, F.concat(F.col(url).substr(F.lit(1), at - 1), F.lit("/"), page_of(url))).otherwise(F.col(url))


def base_name(url) -> Column:
    return F.lower(F.substring_index(F.col(url), "/", -1))


def origin_key(origin="origin_url", detail_id="detail_id", url="url") -> Column:
    """The recorded address, else the one the row's reference leads to."""
    return F.coalesce(F.col(origin), capture_key(detail_id, url))


def own_page(origin="origin_url", detail_id="detail_id", url="url") -> Column:
    key = capture_key(detail_id, url)
    return (key != "") & (origin_key(origin, detail_id, url) == key)


def origin_class(origin="origin_url", detail_id="detail_id", url="url") -> Column:
    """computed: the row's own reference; located: its page at another time; else inferred."""
    return F.when(F.col(origin) == capture_key(detail_id, url), "computed").when(page_of(origin) == F.col(url), "located").otherwise("inferred")


def capture_kind(origin="origin_url", url="url") -> Column:
    """mirror: another page of the same file name; other: any other page; null for the own page or none."""
    page = page_of(origin)
    return F.when(page.isNull() | (page == F.col(url)), F.lit(None).cast("string")).when(F.lower(F.substring_index(page, "/", -1)) == base_name(url), "mirror").otherwise("other")
