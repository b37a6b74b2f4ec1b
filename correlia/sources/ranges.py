"""A remote search as a partitioned source: date ranges are split until each slice fits the service's cap.

The service is an injected object with count(query, first, last) and ids(query, first, last); answering with
nothing and failing to answer are different (an exception is never an empty result).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CAP, MOST_SLICES, BATCH = 10_000, 400, 200


class Service(Protocol):
    def count(self, query: str, first: date, last: date) -> int: ...
    def ids(self, query: str, first: date, last: date) -> list[str]: ...


def split_point(first: date, last: date) -> date:
    """Last day of the earlier half: the end of the middle year if there is more than one, else the middle day."""
    if first.year < last.year:
        return date((first.year + last.year - 1) // 2, 12, 31)
    return first + (last - first) // 2


def slices(service: Service, query: str, first: date, last: date, cap: int = CAP, most: int = MOST_SLICES) -> list[tuple[date, date, int]]:
    """(first, last, hits) of consecutive ranges with at most `cap` hits; empty ones are left out. A single day over the cap is an error."""
    out: list[tuple[date, date, int]] = []
    stack = [(first, last)]
    while stack:
        a, b = stack.pop()
        n = service.count(query, a, b)
        if n > cap:
            if a == b:
                raise ValueError(f"{a}: {n} hits on one day, more than {cap}")
            mid = split_point(a, b)
            stack += [(mid + timedelta(days=1), b), (a, mid)]
        elif n:
            out.append((a, b, n))
            if len(out) > most:
                raise ValueError(f"more than {most} slices")
    return out


class Slice(InputPartition):
    def __init__(self, number: int, first: date, last: date, expected: int):
        self.number, self.first, self.last, self.expected = number, first, last, expected


def search_source(name: str, make: Callable[[], Service], cap: int = CAP) -> type[DataSource]:
    """A data source class to register; options: query, first, last (ISO days). One partition per slice."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.query, self.first, self.last = options["query"], date.fromisoformat(options["first"]), date.fromisoformat(options["last"])

        def partitions(self) -> list[Slice]:
            return [Slice(i, *s) for i, s in enumerate(slices(make(), self.query, self.first, self.last, cap))] or [Slice(-1, self.first, self.first, 0)]

        def read(self, partition: Slice) -> Iterator[tuple]:
            if partition.number >= 0:
                for x in make().ids(self.query, partition.first, partition.last):
                    yield x, partition.number, partition.expected

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "pmid string, tramo int, esperados int"

        def reader(self, schema) -> DataSourceReader:
            return Reader(dict(self.options))

    return Source


def union_slices(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids under the first slice that has them, and per slice how many came against how many were promised."""
    ids = found.where("pmid is not null").groupBy("pmid").agg(F.min("tramo").alias("tramo"))
    report = found.groupBy("tramo").agg(F.count(F.lit(1)).alias("recibidos"), F.max("esperados").alias("esperados"))
    return ids, report.withColumn("estado", F.when(F.col("recibidos") < F.col("esperados"), "faltan").when(F.col("recibidos") > F.col("esperados"), "sobran").otherwise("igual"))


def fetch_records(ids: DataFrame, fetch: Callable[[list[str]], list[dict]], schema: str, key: str = "pmid", batch: int = BATCH) -> DataFrame:
    """Records of the ids, asked for in batches within each partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf[key].tolist()
            for i in range(0, len(keys), batch):
                yield pd.DataFrame(fetch(keys[i : i + batch]), columns=[c.strip().split()[0] for c in schema.split(",")])

    return ids.select(key).mapInPandas(run, schema)


def first_link(df: DataFrame, resolvers: list[tuple[str, str]]) -> DataFrame:
    """The first non-empty of the resolvers' columns, with its name."""
    url = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for _, c in resolvers])
    which = F.coalesce(*[F.when(F.nullif(F.trim(c), F.lit("")).isNotNull(), F.lit(n)) for n, c in resolvers])
    return df.withColumns({"liga": url, "origen": which})


def outdated(files: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Files whose (path, hash, version) the manifest does not hold: what is left to convert."""
    return files.join(manifest.select(*keys).distinct(), keys, "left_anti")


def with_ids(documents: DataFrame, table: DataFrame, key: str = "pmid") -> DataFrame:
    """Ids of other kinds (one row per key) beside the documents; those without stay, with nulls."""
    return documents.join(table.dropDuplicates([key]), key, "left")


def register(spark: SparkSession, source: type[DataSource]) -> None:
    spark.dataSource.register(source)


class Client:
    """Polite client over an injected opener(url) -> (status, body): waits between calls, tries again, and tells "no" from "could not ask".

    A definitive status gives None; anything else that is no success, after the last try, raises.
    """

    DEFINITIVE = frozenset({400, 404, 410})

    def __init__(self, opener: Callable[[str], tuple[int, bytes]], pause: float = 0.34, tries: int = 3, sleep: Callable[[float], None] | None = None):
        import time

        self.opener, self.pause, self.tries, self.sleep = opener, pause, tries, sleep or time.sleep

    def get(self, url: str) -> bytes | None:
        last: Exception | None = None
        for n in range(self.tries):
            if n or self.pause:
                self.sleep(self.pause * 2**n)
            try:
                status, body = self.opener(url)
            except OSError as e:
                last = e
                continue
            if 200 <= status < 300:
                return body
            if status in self.DEFINITIVE:
                return None
            last = ConnectionError(f"status {status}")
        raise ConnectionError(f"{url}: {last}") from last
