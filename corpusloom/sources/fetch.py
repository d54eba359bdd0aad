"""Fetching through the cache: what isn't cached yet is fetched by a function that is named, so
no part of the library opens a connection by itself and tests read files.

A fetcher maps (url, timeout) to (bytes, content type, status); it raises OSError when the
network fails. Each site's addresses are fetched by one task, in order, with its pause
between them, and a site that answers 503 or 429 is left alone for the cooldown. Every
attempt is a row of the call log; a failing log never fails a fetch.
"""

from __future__ import annotations

import hashlib
import importlib
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.schema import COLUMNS

#: Tries, seconds before the second (doubled each time), seconds between two
#: requests, seconds a refusing site is left alone, seconds a request may take.
TRIES, BACKOFF, PAUSE, COOLDOWN, TIMEOUT = 3, 5.0, 1.5, 120.0, 20
PAGES = "url string, content binary, id_content_type string, outcome string, fetched_at double, calls array<struct<ts: double, attempt: int, outcome: string, duration: double>>"


def site(url) -> Column:
    """The host, without ``www.``; a capture's is the archive's."""
    return F.regexp_replace(F.lower(F.coalesce(F.parse_url(url, F.lit("HOST")), F.lit(""))), r"^www\.", "")


def fetched(urls: DataFrame, fetcher: str, pause: float = PAUSE, backoff: float = BACKOFF, cooldown: float = COOLDOWN) -> DataFrame:
    """(url, content, id_content_type, outcome, fetched_at, calls) of each address (url). The
    outcome is ok, or that of the last attempt: 503, 429, timeout, connection_error, other."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = fetcher.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        free_at: dict[str, float] = {}
        for batch in batches:
            rows = []
            for url, host in zip(batch["url"], batch["site"]):
                calls, content, kind, outcome = [], None, None, "other"
                for k in range(TRIES):
                    time.sleep(max(0.0, free_at.get(host, 0.0) - time.time()))
                    began = time.time()
                    try:
                        content, kind, status = fetch(url, TIMEOUT)
                        outcome = "ok" if status == 200 else str(status) if status in (503, 429) else "other"
                    except TimeoutError:
                        outcome = "timeout"
                    except OSError:
                        outcome = "connection_error"
                    calls.append({"ts": began, "attempt": k + 1, "outcome": outcome, "duration": time.time() - began})
                    free_at[host] = time.time() + (cooldown if outcome in ("503", "429") else pause)
                    if outcome in ("ok", "other"):
                        break
                    if k < TRIES - 1 and outcome not in ("503", "429"):
                        time.sleep(backoff * 2**k)
                rows.append((url, content if outcome == "ok" else None, kind, outcome, time.time(), calls))
            yield pd.DataFrame(rows, columns=["url", "content", "id_content_type", "outcome", "fetched_at", "calls"])

    asked = urls.select("url").distinct().withColumn("site", site("url")).repartition("site").sortWithinPartitions("site", "url")
    return asked.mapInPandas(work, PAGES)


def fetch_cached(cache: DataFrame, urls: DataFrame, fetcher: str, refetch: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """(pages of the addresses, whether cached or fetched now; the new rows with their calls, to
    be stored and logged). With ``refetch`` cached bytes don't count."""
    wanted = urls.select("url").distinct()
    new = fetched(wanted if refetch else wanted.join(cache.select("url"), "url", "left_anti"), fetcher, **options)
    there = cache.join(wanted, "url", "left_semi").select("url", "content", "id_content_type")
    if refetch:
        there = there.join(new.filter("outcome = 'ok'").select("url"), "url", "left_anti")
    return there.unionByName(new.filter("outcome = 'ok'").select("url", "content", "id_content_type")), new


def cache_rows(new: DataFrame) -> DataFrame:
    """Fetched rows as the page cache holds them."""
    guess = F.nullif(F.regexp_extract(F.lower("id_content_type"), r"charset=([\w-]+)", 1), F.lit(""))
    rows = new.filter("outcome = 'ok'").withColumn("content_sha256", F.sha2("content", 256)).withColumn("fw_guessed_charset", guess).withColumn("bs4_encoding", F.lit(None).cast("string"))
    return rows.select(COLUMNS["page_cache"].split())


def call_rows(new: DataFrame, kind: str = "content") -> DataFrame:
    """Attempts as the call log holds them, but for the id, which the log's writer gives."""
    rows = new.select("url", F.explode("calls").alias("c"))
    return rows.select("c.ts", F.lit(kind).alias("kind"), "url", "c.attempt", F.lit(float(TIMEOUT)).alias("timeout_budget"), "c.outcome", "c.duration")


def append_calls(calls: DataFrame, folder: str) -> bool:
    """Append to the log; whether it could be done. Telemetry never fails what it is about."""
    try:
        calls.withColumn("id", F.xxhash64("ts", "url", "attempt")).select(COLUMNS["wayback_calls"].split()).write.mode("append").parquet(folder)
    except Exception:
        return False
    return True


def from_folder(url: str, timeout: int, root: str = "") -> tuple[bytes, str, int]:
    """A fetcher over a folder whose files are named by the addresses' SHA-256."""
    import os

    path = os.path.join(root or os.environ.get("CORPUSLOOM_PAGES", "."), hashlib.sha256(url.encode()).hexdigest())
    if not os.path.exists(path):
        return b"", "text/html", 404
    with open(path, "rb") as file:
        return file.read(), "text/html; charset=utf-8", 200
