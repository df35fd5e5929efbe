"""Minute candles from a paged HTTP API, as a Spark data source: `spark.read.format("klines")`.

Options: symbol, start_ms, end_ms (half-open), page_size (minutes a page, at most 1000), base_url,
timeout_s, max_retries. base_url may be a folder (file:///...) of recorded pages named
<symbol>-<first minute>.json, which tests use. Each page is an input partition, so executors fetch
pages in parallel; the whole range is paged, whatever its length.
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MINUTE = 60_000
PAGE = 1000
SCHEMA = "symbol string, tf string, ts long, o double, h double, l double, c double, v double, t double"


class Page(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))
        self.start, self.end = start, end


def pages(start_ms: int, end_ms: int, page_size: int = PAGE) -> list[tuple[int, int]]:
    """Half-open windows of whole minutes that cover [start, end)."""
    page_size = max(1, min(page_size, PAGE))
    low = start_ms - start_ms % MINUTE
    step = page_size * MINUTE
    return [(a, min(a + step, end_ms)) for a in range(low, end_ms, step)]


def wait_seconds(attempt: int, retry_after: str | None) -> float:
    """What the server asks for, else exponential with jitter, at most a minute."""
    if retry_after and retry_after.isdigit():
        return float(retry_after)
    return min(60.0, 2 ** min(attempt, 6) + random.random())


def get(url: str, timeout_s: float, max_retries: int, sleep=time.sleep) -> dict:
    for attempt in range(max_retries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout_s) as answer:  # noqa: S310
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if attempt == max_retries or (e.code < 500 and e.code != 429):
                raise
            sleep(wait_seconds(attempt, e.headers.get("Retry-After") if e.code == 429 else None))
        except (urllib.error.URLError, TimeoutError):
            if attempt == max_retries or url.startswith("file:"):
                raise
            sleep(wait_seconds(attempt, None))
    raise AssertionError


def rows_of(answer: dict, symbol: str, start: int, end: int) -> list[tuple]:
    """Distinct minutes in [start, end), sorted; of equal ones the last in the answer."""
    found: dict[int, tuple] = {}
    for row in (answer.get("result") or {}).get("list") or []:
        numbers = []
        for x in row[1:7]:
            try:
                numbers.append(float(x))
            except (TypeError, ValueError):
                numbers.append(None)
        ts = int(row[0])
        if start <= ts < end:
            found[ts] = (symbol, "1m", ts, *numbers, *[None] * (6 - len(numbers)))
    return [found[k] for k in sorted(found)]


class KlinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self) -> list[Page]:
        return [Page(a, b) for a, b in pages(int(self.o["start_ms"]), int(self.o["end_ms"]), int(self.o.get("page_size", PAGE)))]

    def read(self, partition: Page | None) -> Iterator[tuple]:
        if partition is None:  # an empty range has no pages
            return
        symbol, base = self.o["symbol"], self.o["base_url"].rstrip("/")
        if base.startswith("file:"):
            url = f"{base}/{symbol}-{partition.start}.json"
        else:  # the API's end is inclusive
            ask = {"category": self.o.get("category", "linear"), "symbol": symbol, "interval": 1, "start": partition.start, "end": partition.end - MINUTE, "limit": PAGE}
            url = f"{base}?{urllib.parse.urlencode(ask)}"
        answer = get(url, float(self.o.get("timeout_s", 10)), int(self.o.get("max_retries", 5)))
        yield from rows_of(answer, symbol, max(partition.start, int(self.o["start_ms"])), partition.end)


class KlinesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "klines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> KlinesReader:
        return KlinesReader(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(KlinesSource)
