"""A paged remote search as a source: the total is asked first, then every page is a partition of its own.

The remote side is a function ``fetch(query, page) -> {"total": n, "matches": [record, ...]}`` (page 0 asks for the total alone),
named as ``module:function``; the engine brings no client of its own.

Defined cases
    * a request that fails is tried again, after a pause that doubles up to MOST_PAUSE; a total that can't be had is null.
    * a page that fails to the end is an error, or with ``on_failure=skip`` brings no rows; a query without results has none.
    * with ``most_pages`` (a backstop against runaway queries) later pages are left unread; without it all are read.
"""

from __future__ import annotations

import importlib
import json
import math
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE_SIZE, TRIES, PAUSE, MOST_PAUSE = 100, 3, 15.0, 120.0


class Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.query, self.named, self.on_failure = options["query"], options["fetch"], options.get("on_failure", "error")
        self.tries, self.pause = int(options.get("tries", TRIES)), float(options.get("pause", PAUSE))
        self.most = int(options["most_pages"]) if "most_pages" in options else None

    def ask(self, page: int) -> dict:
        module, _, name = self.named.partition(":")
        fetch, pause = getattr(importlib.import_module(module), name), self.pause
        for left in reversed(range(self.tries)):
            try:
                return fetch(self.query, page)
            except Exception:
                if not left:
                    raise
                time.sleep(min(pause, MOST_PAUSE))
                pause *= 2
        raise ValueError("tries must be at least 1")

    def partitions(self) -> list[Page]:
        pages = math.ceil(self.ask(0)["total"] / PAGE_SIZE)
        return [Page(i + 1) for i in range(pages if self.most is None else min(pages, self.most))] or [Page(0)]

    def read(self, partition: Page) -> Iterator[tuple]:
        if not partition.number:
            return
        try:
            found = self.ask(partition.number).get("matches") or []
        except Exception:
            if self.on_failure != "skip":
                raise
            found = []
        for place, record in enumerate(found):
            yield self.query, partition.number, place, json.dumps(record)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "query string, page int, place int, record string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def search(spark: SparkSession, query: str, fetch: str, **options) -> DataFrame:
    """query, page, place, record (JSON) of all pages."""
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_search").options(query=query, fetch=fetch, **options).load()


def total(query: str, fetch: str, **options) -> int | None:
    """How many results a query has, or None where that can't be had."""
    try:
        return PagedReader({"query": query, "fetch": fetch} | {k: str(v) for k, v in options.items()}).ask(0)["total"]
    except Exception:
        return None
