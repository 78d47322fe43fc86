"""Paged sources as Spark data sources.

A source says how to start, fetch and move on; reading runs one task a symbol and one
page at a time in it.  Fetching is given by the caller: nothing here opens a connection.

    spark.dataSource.register(paged_source("vendor", first, fetch))
    spark.read.format("vendor").option("symbols", "A,B").load()
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MOST_PAGES = 10_000


class NoNewData(Exception):
    """A source had no rows for what was asked."""


@dataclass(frozen=True)
class Page:
    rows: list
    next: Any = None


def pages(first: Any, fetch: Callable[[Any], Page], most: int = MOST_PAGES) -> Iterator[list]:
    """Rows of pages until a page has no next cursor; a cursor that repeats, or too many pages, raises."""
    seen, cursor = set(), first
    for _ in range(most):
        page = fetch(cursor)
        yield page.rows
        if page.next is None:
            return
        key = json.dumps(page.next, sort_keys=True, default=str)
        if key in seen or page.next == cursor:
            raise RuntimeError(f"cursor {cursor!r} repeats")
        seen.add(key)
        cursor = page.next
    raise RuntimeError(f"more than {most} pages")


#: How far ahead a source is asked again where it has nothing yet, in milliseconds.
PROBE_MS = 90 * 86_400_000


def forward(start_ms: int, end_ms: int, fetch: Callable[[int], list], time_of: Callable[[Any], int], probe_ms: int = PROBE_MS) -> Iterator[list]:
    """Rows of a source that is read forward in time, each page from the last row's time on.

    An empty page before any data moves on by ``probe_ms``, as a symbol may be listed late;
    one after data is the end.  A page that brings nothing later ends it too.
    """
    at, seen = start_ms, False
    while at < end_ms:
        rows = fetch(at)
        if rows:
            seen = True
            last = max(map(time_of, rows))
            yield rows
            if last < at:
                return
            at = last + 1
        elif seen:
            return
        else:
            at += probe_ms


def with_retries(call: Callable[[], tuple[int, str]], attempts: int = 4, sleep: Callable[[float], None] = time.sleep) -> str:
    """Body of a call's (status, body); 429, 5xx and OSError are tried again after 1, 2, 4 .. s."""
    for n in range(attempts):
        last = n == attempts - 1
        try:
            status, body = call()
        except OSError:
            if last:
                raise
        else:
            if status < 400:
                return body
            if last or not (status == 429 or status >= 500):
                raise RuntimeError(f"status {status}")
        sleep(2**n)
    raise AssertionError


PAGE = "symbol string, page int, body string"


class _Reader(DataSourceReader):
    """Reads a symbol's pages in order, one task a symbol."""

    def __init__(self, symbols: list[str], first: Callable[[str], Any], fetch: Callable[[str, Any], Page]) -> None:
        self.symbols, self.first, self.fetch = symbols, first, fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in self.symbols]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        symbol, n = partition.value, 0
        for k, rows in enumerate(pages(self.first(symbol), lambda c: self.fetch(symbol, c))):
            n += len(rows)
            yield symbol, k, json.dumps(rows)
        if not n:
            raise NoNewData(symbol)


def paged_source(source: str, first: Callable[[str], Any], fetch: Callable[[str, Any], Page]) -> type[DataSource]:
    """A data source of that name to register: symbol, page, body of all pages of the option ``symbols``.

    first and fetch run on executors; each page's rows are one JSON text.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return source

        def schema(self) -> str:
            return PAGE

        def reader(self, schema) -> DataSourceReader:
            return _Reader(self.options["symbols"].split(","), first, fetch)

    return Paged


def fetch_all(spark: SparkSession, symbols: list[str], first: Callable[[str], Any], fetch: Callable[[str, Any], Page], parallel: int | None = None) -> DataFrame:
    """symbol, page, body: all pages of all symbols, each page's rows as one JSON text.

    first and fetch run on executors, a symbol's pages in order in one task.
    """
    import pandas as pd

    def load(batches):
        for pdf in batches:
            for symbol in pdf["symbol"]:
                n = 0
                for k, rows in enumerate(pages(first(symbol), lambda c, s=symbol: fetch(s, c))):
                    n += len(rows)
                    yield pd.DataFrame({"symbol": [symbol], "page": [k], "body": [json.dumps(rows)]})
                if not n:
                    raise NoNewData(symbol)

    wanted = spark.createDataFrame([(s,) for s in symbols], "symbol string").repartition(parallel or len(symbols))
    return wanted.mapInPandas(load, "symbol string, page int, body string")
