"""A paginated JSON endpoint as a Spark data source, for batches and for streams.

One row per page: ``page``, ``n_items``, the page ``body`` as text, and with the option ``key``
the greatest key of its records as text and the number of those without one. Page ranges are
input partitions, so executors fetch in parallel; the JSON itself is decoded by Spark.

Without a last page each of several tasks reads every n-th page until one has nothing to give: no
records, or under a pushed filter ``max_key > mark`` no key above the mark. A stream ends at a
page and a number of its records, and goes on from there.
"""

from __future__ import annotations

import json
import sys
import time
from urllib.error import HTTPError, URLError
from urllib.request import urlopen

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    GreaterThan,
    InputPartition,
)

FORMAT = "paged_json"
PAGE_ROW = "page BIGINT, n_items BIGINT, body STRING, max_key STRING, n_keyless BIGINT"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# Attempts after the first, first pause in seconds (doubled each time), timeout.
RETRIES = 3
BACKOFF = 1.0
TIMEOUT = 30.0


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class Stripe(InputPartition):
    """Every ``step``-th page from ``first`` on."""

    def __init__(self, first: int, step: int):
        super().__init__((first, step))
        self.first, self.step = first, step


class PageFetcher:
    def __init__(self, options):
        self.url = options["url"]
        self.first = int(options.get("first_page", 1))
        self.last = int(options["last_page"]) if "last_page" in options else None
        self.key = options.get("key")
        self.per_page = int(options.get("per_page", 200))
        self.pages_per_task = int(options.get("pages_per_task", 4))
        self.retries = int(options.get("retries", RETRIES))
        self.backoff = float(options.get("backoff", BACKOFF))
        self.timeout = float(options.get("timeout", TIMEOUT))
        self.missing = options.get("missing", "error")

    def fetch(self, page):
        body, items = self.load(page)
        return body, len(items)

    def load(self, page):
        """The text and the records of a page."""
        url = self.url.format(page=page, per_page=self.per_page)
        for attempt in range(self.retries + 1):
            try:
                with urlopen(url, timeout=self.timeout) as response:
                    body = response.read().decode("utf-8")
                items = json.loads(body)
                if not isinstance(items, list):
                    raise ValueError("the page is not a JSON array")
                return body, items
            except (OSError, ValueError) as error:
                if self.missing == "empty" and is_missing(error):
                    return "[]", []
                if attempt == self.retries:
                    raise RuntimeError(
                        f"PAGE_FETCH_FAILED page {page} after {attempt + 1} attempts: {error}"
                    ) from error
                time.sleep(self.backoff * 2**attempt)

    def row(self, page, body, items):
        if self.key is None:
            return page, len(items), body, None, None
        keys = [key_text(item, self.key) for item in items]
        present = [key for key in keys if key is not None]
        return page, len(items), body, max(present, default=None), len(keys) - len(present)


class PagedJsonReader(PageFetcher, DataSourceReader):
    """Pages up to a last one; a task ends early after an empty page."""

    def partitions(self):
        step = self.pages_per_task
        return [
            PageRange(first, min(first + step - 1, self.last))
            for first in range(self.first, self.last + 1, step)
        ]

    def read(self, partition):
        for page in range(partition.first, partition.last + 1):
            body, items = self.load(page)
            yield self.row(page, body, items)
            if not items:
                return


class OpenEndedReader(PageFetcher, DataSourceReader):
    """Pages until there is nothing more, or up to ``max_page``."""

    def __init__(self, options):
        super().__init__(options)
        self.readers = int(options.get("readers", 8))
        self.max_page = int(options["max_page"]) if "max_page" in options else None
        self.mark = None

    def pushFilters(self, filters):
        for one in filters:
            known = isinstance(one, GreaterThan) and one.attribute == ("max_key",) and self.key
            if known and isinstance(one.value, str):
                self.mark = one.value if self.mark is None else max(self.mark, one.value)
            else:
                yield one

    def partitions(self):
        return [Stripe(self.first + i, self.readers) for i in range(self.readers)]

    def read(self, partition):
        page = partition.first
        while self.max_page is None or page <= self.max_page:
            body, items = self.load(page)
            row = self.row(page, body, items)
            if not items or self.mark is not None and (row[3] is None or row[3] <= self.mark):
                return
            yield row
            page += partition.step


class PageStream(PageFetcher, DataSourceStreamReader):
    """New records of a source that only grows at its end, sorted by age.

    An offset is the last page with records and how many it had. Its later records come with the
    next batch, so each is given once however triggers and restarts fall.
    """

    def __init__(self, options):
        super().__init__(options)
        self.reached = self.first

    def initialOffset(self):
        return {"page": self.first, "items": 0}

    def latestOffset(self):
        """The end, found in twice as many requests as the new pages have binary digits."""
        if not self.fetch(self.reached)[1]:
            return {"page": self.reached, "items": 0}
        full, step = self.reached, 1
        while self.fetch(full + step)[1]:
            full, step = full + step, step * 2
        empty = full + step
        while empty - full > 1:
            middle = (full + empty) // 2
            if self.fetch(middle)[1]:
                full = middle
            else:
                empty = middle
        self.reached = full
        return {"page": full, "items": self.fetch(full)[1]}

    def partitions(self, start, end):
        step = self.pages_per_task
        return [
            InputPartition(
                (first, min(first + step - 1, end["page"]), start["page"], start["items"],
                 end["page"], end["items"])
            )
            for first in range(start["page"], end["page"] + 1, step)
        ]

    def read(self, partition):
        first, last, from_page, seen, to_page, until = partition.value
        for page in range(first, last + 1):
            body, items = self.load(page)
            part = items[seen if page == from_page else 0 : until if page == to_page else None]
            if part:
                text = body if len(part) == len(items) else json.dumps(part, ensure_ascii=False)
                yield self.row(page, text, part)


def key_text(item, key: str) -> str | None:
    """The key of a record as Spark reads it from JSON: as text."""
    value = item.get(key) if isinstance(item, dict) else None
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def is_missing(error: Exception) -> bool:
    if isinstance(error, HTTPError):
        return error.code == 404
    return isinstance(error, URLError) and isinstance(error.reason, FileNotFoundError)


class PagedJsonSource(DataSource):
    """Options: ``url`` with ``{page}`` and ``{per_page}``, ``first_page``, ``last_page`` and
    ``pages_per_task``, or ``readers`` and ``max_page``; ``per_page``, ``key``, ``retries``,
    ``backoff``, ``timeout`` and ``missing`` (``error``, or ``empty`` where the server answers
    404 past its end)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return PAGE_ROW

    def reader(self, schema):
        kind = PagedJsonReader if "last_page" in self.options else OpenEndedReader
        return kind(self.options)

    def streamReader(self, schema):
        return PageStream(self.options)


def register(spark: SparkSession) -> None:
    # the module only needs the standard library, so workers get it by value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedJsonSource)


def read_pages(
    spark: SparkSession, url: str, first_page: int, last_page: int, **options
) -> DataFrame:
    register(spark)
    return (
        spark.read.format(FORMAT)
        .options(url=url, first_page=first_page, last_page=last_page, **options)
        .load()
    )


def read_all_pages(spark: SparkSession, url: str, first_page: int = 1, **options) -> DataFrame:
    """Pages from ``first_page`` on. A filter ``max_key > mark`` ends the paging at the source."""
    register(spark)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format(FORMAT).options(url=url, first_page=first_page, **options).load()


def stream_pages(spark: SparkSession, url: str, **options) -> DataFrame:
    """The pages as a stream; a page that grew comes again with its new records only."""
    register(spark)
    return spark.readStream.format(FORMAT).options(url=url, **options).load()


def records(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per record with its page number and the fields of ``schema``."""
    return pages.select("page", F.inline(F.from_json("body", T.ArrayType(schema))))


def record_texts() -> Column:
    """The records of a page body, each as its own JSON text with all its fields."""
    return F.from_json("body", T.ArrayType(T.StringType()))


def text_field(record: Column, name: str) -> Column:
    """A top-level field of a JSON text, as text."""
    return F.get_json_object(record, f"$.{name}")
