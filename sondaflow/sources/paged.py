"""Paged and date-windowed extracts, read by the executors.

The transport is a function the caller supplies; it gets one request and
returns that request's records, those of a window as a list or one after another. It runs inside tasks, so no record ever passes
through the driver, and a task that is lost simply asks again.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import date
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The readers travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGE_SIZE = 15_000
READERS = 4  # at once per source: a public source limits its callers, however large the cluster
WINDOW_DAYS = 5 * 365 + 1
RECORDS_AT_ONCE = 10_000


@dataclass(frozen=True)
class PageRequest:
    """What a transport is asked for: one page in the order of the full natural key.

    ``filter`` is a Spark SQL predicate on the records; the transport translates it for its
    source, or ignores it, because it is applied to the records again after they are read.
    """

    endpoint: str
    order_by: tuple[str, ...]
    filter: str
    skip: int
    top: int


@dataclass(frozen=True)
class WindowRequest:
    """What a transport is asked for: one series between two days, both included."""

    series: str
    first: date
    last: date


class _Share(InputPartition):
    def __init__(self, index: int):
        self.index = index


class _Windows(InputPartition):
    def __init__(self, windows: list):
        self.windows = windows


def _batch(records: list[dict]) -> pa.RecordBatch:
    """Records as one Arrow batch of JSON texts."""
    texts = [json.dumps(r, ensure_ascii=False) for r in records]
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])


class _PageReader(DataSourceReader):
    """Reader k of n takes pages k, k+n, k+2n, ... and stops at its first short page.

    The total need not be known: every page before the last is full, so all of
    them are taken, and each reader makes at most one request too many.
    """

    def __init__(self, options: dict, fetch: Callable[[PageRequest], list[dict]]):
        self.size = int(options.get("page_size", PAGE_SIZE))
        self.readers = int(options["readers"])
        self.endpoint = options.get("endpoint", "")
        self.order_by = tuple(k for k in options.get("order_by", "").split(",") if k)
        self.filter = options.get("filter", "")
        self.fetch = fetch

    def partitions(self) -> list[InputPartition]:
        return [_Share(k) for k in range(self.readers)]

    def read(self, partition: _Share) -> Iterator[pa.RecordBatch]:
        page = partition.index
        while True:
            records = self.fetch(PageRequest(
                self.endpoint, self.order_by, self.filter, page * self.size, self.size))
            yield _batch(records)
            if len(records) < self.size:
                return
            page += self.readers


class _WindowReader(DataSourceReader):
    """Reader k of n takes windows k, k+n, k+2n, ... and holds so many records of one at once."""

    def __init__(self, options: dict, fetch: Callable[[WindowRequest], Iterable[dict]]):
        self.series = options.get("series", "")
        self.windows = json.loads(options["windows"])
        self.readers = int(options["readers"])
        self.fetch = fetch

    def partitions(self) -> list[InputPartition]:
        return [_Windows(self.windows[k::self.readers]) for k in range(min(self.readers, len(self.windows)))]

    def read(self, partition: _Windows) -> Iterator[pa.RecordBatch]:
        for first, last in partition.windows:
            records = iter(self.fetch(WindowRequest(self.series, date.fromisoformat(first), date.fromisoformat(last))))
            while some := list(islice(records, RECORDS_AT_ONCE)):
                yield _batch(some)


def _register(spark: SparkSession, reader: type, fetch: Callable) -> str:
    """A data source bound to one transport; its name is its own, so extracts may run side by side."""
    label = f"sondaflow_{uuid.uuid4().hex}"

    class Extract(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return "value string"

        def reader(self, schema) -> DataSourceReader:
            return reader(self.options, fetch)

    spark.dataSource.register(Extract)
    return label


def read_pages(spark: SparkSession, fetch: Callable[[PageRequest], list[dict]], *, endpoint: str,
               order_by: tuple[str, ...], filter: str = "", page_size: int = PAGE_SIZE,
               readers: int = READERS) -> DataFrame:
    """JSON records of a paged source, one per row in ``value``. Each reader asks for a page at a
    time, so the source sees at most so many requests at once, and at most one too many from each."""
    label = _register(spark, _PageReader, fetch)
    options = {"endpoint": endpoint, "order_by": ",".join(order_by), "filter": filter,
               "page_size": str(page_size), "readers": str(readers)}
    return spark.read.format(label).options(**options).load()


def page_number(row_number: Column, page_size: int = PAGE_SIZE) -> Column:
    """The page on which the n-th record (from 0) of the ordered source lies."""
    return F.floor(row_number / page_size)


def date_windows(spark: SparkSession, first: date, last: date, days: int = WINDOW_DAYS) -> DataFrame:
    """Consecutive windows without gap or overlap; the final one is clipped to ``last``."""
    starts = F.sequence(F.lit(first), F.lit(last), F.expr(f"interval {days} days"))
    return (
        spark.range(1).select(F.explode(starts).alias("first_day"))
        .withColumn("last_day", F.least(F.date_add("first_day", days - 1), F.lit(last)))
    )


def window_index(day: Column, first: date, days: int = WINDOW_DAYS) -> Column:
    """The window a day falls into, from 0."""
    return F.floor(F.datediff(day, F.lit(first)) / days)


def read_windows(spark: SparkSession, fetch: Callable[[WindowRequest], Iterable[dict]], *, series: str,
                 first: date, last: date, days: int = WINDOW_DAYS, readers: int = READERS) -> DataFrame:
    """JSON records of a date-windowed source, one per row in ``value``; so many requests at once."""
    plan = [[str(w.first_day), str(w.last_day)]
            for w in date_windows(spark, first, last, days).collect()]
    label = _register(spark, _WindowReader, fetch)
    options = {"series": series, "windows": json.dumps(plan), "readers": str(readers)}
    return spark.read.format(label).options(**options).load()
