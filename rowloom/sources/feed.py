"""Sources as Spark data sources: one partition per query, failures kept apart.

A fetcher is a function from (source, query, offset, size) to a list of rows.  ``FeedSource``
runs it on the executors, pages by offset until a page comes back short, and yields a row
``failure`` instead of failing the job when one query does.
"""

from __future__ import annotations

import base64
import json
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetcher = Callable[[str, str, int, int], list[dict]]


class FeedError(RuntimeError):
    """A source could not be read."""


class _Query(InputPartition):
    def __init__(self, query: str) -> None:
        self.query = query


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        return [_Query(q) for q in json.loads(self.options.get("queries", '[""]'))]

    def read(self, partition: _Query) -> Iterator[tuple]:
        fetch: Fetcher = cloudpickle.loads(base64.b64decode(self.options["fetcher"]))
        source, size = self.options.get("source", ""), int(self.options.get("page", "100"))
        limit = int(self.options.get("limit", str(1 << 31)))
        unique, seconds = json.loads(self.options.get("unique", "[]")), float(self.options.get("seconds", "inf"))
        began, seen = time.monotonic(), {k: set() for k in unique}
        offset = kept = 0
        try:
            while kept < limit and time.monotonic() - began < seconds:
                page = fetch(source, partition.query, offset, size if unique else min(size, limit - offset))
                before = kept
                for row in page:
                    if kept >= limit or time.monotonic() - began >= seconds:
                        break
                    values = {k: str(row.get(k) or "").strip().lower() for k in unique}
                    if any(v and v in seen[k] for k, v in values.items()):
                        continue
                    for k, v in values.items():
                        seen[k].add(v)
                    kept += 1
                    yield source, partition.query, json.dumps(row, ensure_ascii=False), None
                offset += len(page)
                # A short page is the last one; a page without anything new ends the query too.
                if len(page) < size or kept == before:
                    break
        except Exception as e:  # noqa: BLE001 one failing query must not end the others
            yield source, partition.query, None, f"{type(e).__name__}: {e}"


class FeedSource(DataSource):
    """``spark.read.format("feed")`` with options ``fetcher`` (a pickled function in base 64),
    ``source``, ``queries`` (JSON list), ``page``, ``limit``, ``unique`` (JSON list) and ``seconds``;
    ``read_feed`` sets them."""

    @classmethod
    def name(cls) -> str:
        return "feed"

    def schema(self) -> str:
        return "source string, query string, payload string, failure string"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_feed(
    spark: SparkSession, fetcher: Fetcher, source: str, queries: list[str], page: int = 100, limit: int | None = None,
    unique: list[str] | None = None, seconds: float | None = None,
) -> DataFrame:
    """A feed of ``queries``.  Rows that repeat a value of one of the fields ``unique`` within their query
    are skipped; a query ends after ``limit`` rows, after ``seconds``, or with a page that brings
    nothing new."""
    spark.dataSource.register(FeedSource)
    reader = spark.read.format("feed").option("fetcher", base64.b64encode(cloudpickle.dumps(fetcher)).decode()).option("source", source).option("queries", json.dumps(queries))
    reader = reader.option("page", str(page)).option("unique", json.dumps(unique or []))
    reader = reader.option("seconds", str(seconds)) if seconds is not None else reader
    return (reader.option("limit", str(limit)) if limit is not None else reader).load()


def payloads(feed: DataFrame, schema: str) -> DataFrame:
    """The rows of a feed in the columns of ``schema``; failures are left out."""
    return feed.where(F.col("failure").isNull()).select("source", F.from_json("payload", schema).alias("r")).select("source", "r.*")


def failures(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("failure").isNotNull()).groupBy("source", "query").agg(F.max("failure").alias("failure"))


def require_answers(feed: DataFrame) -> DataFrame:
    """The feed, or a ``FeedError`` if queries failed and none answered."""
    n, failed = feed.agg(F.count("payload"), F.max("failure")).first()
    if failed and not n:
        raise FeedError(f"no query was answered: {failed}")
    return feed


def text_of_reports(binary: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """``(path, text)`` of binary files; ``extract`` turns the bytes of one report into text."""
    import pandas as pd

    @F.pandas_udf("string")
    def text(content: pd.Series) -> pd.Series:
        return content.map(lambda b: extract(bytes(b)) if b is not None else None)

    return binary.select("path", text("content").alias("text"))
