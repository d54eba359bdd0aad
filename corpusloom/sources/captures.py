"""A data source for the archive's index of captures: ``spark.read.format("captures")``.

The index is served by a fetcher, a function from (url, prefix, limit) to rows of
(timestamp, url, status, type); it is named as ``module:function``, so tests and offline
runs read a file and no part of the library opens a connection by itself. Each url of the
option is read by its own task; failures are tried again with growing pauses, and an index
that refuses is left alone for a while. An answer that would not be whole is an error, not
a cut. ``collapse`` keeps the first capture of each page.
"""

from __future__ import annotations

import importlib
import json
import re
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Tries, seconds before the second, rows of one answer for an address and for a
#: prefix, seconds that a refusing index is left alone.
TRIES, PAUSE, MOST, MOST_BY_PREFIX, COOLDOWN = 3, 5.0, 1000, 10_000, 120.0


class Refused(OSError):
    """The index answered 503 or 429."""


class Truncated(OSError):
    """The index has more rows than one answer holds."""


class _Url(InputPartition):
    def __init__(self, url: str) -> None:
        self.url = url


def from_file(url: str, prefix: bool, limit: int, path: str = "") -> list[tuple]:
    """A fetcher over a file of JSON lines."""
    with open(path, encoding="utf-8") as lines:
        rows = [json.loads(line) for line in lines]
    hit = [r for r in rows if (r["url"].startswith(url) if prefix else r["url"] == url)]
    return [(r["timestamp"], r["url"], r.get("status"), r.get("type")) for r in hit[:limit]]


class CaptureIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return "timestamp string, url string, status string, type string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.prefix = options.get("prefix", "false") == "true"
        self.fails = options.get("failOnError", "true") == "true"
        self.limit = int(options.get("limit", MOST_BY_PREFIX if self.prefix else MOST))
        self.collapse = options.get("collapse", "false") == "true"
        self.cooldown = float(options.get("cooldown", COOLDOWN))
        self.fetcher, self.path, self.pause = options["fetcher"], options.get("file"), float(options.get("pause", PAUSE))

    def partitions(self) -> list[InputPartition]:
        return [_Url(u) for u in self.urls] or [_Url("")]

    def read(self, partition: _Url) -> Iterator[tuple]:
        if not partition.url:
            return
        module, _, function = self.fetcher.partition(":")
        fetch = getattr(importlib.import_module(module), function)
        extra = {"path": self.path} if self.path else {}
        for k in range(TRIES):
            try:
                rows = list(fetch(partition.url, self.prefix, self.limit + 1, **extra))  # bounded by the limit
                if len(rows) > self.limit:
                    raise Truncated(f"more than {self.limit} captures of {partition.url}; ask by narrower prefixes or raise the limit")
                seen: set[str] = set()
                for row in rows:
                    key = re.sub(r"^https?://(?:www\.)?|/$", "", row[1].lower())
                    if not self.collapse or key not in seen:
                        yield row
                    seen.add(key)
                return
            except Truncated:
                raise
            except OSError as error:
                if k == TRIES - 1:
                    if self.fails:
                        raise
                    return
                time.sleep(self.cooldown if isinstance(error, Refused) else self.pause * 2**k)
