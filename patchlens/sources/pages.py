"""The event feed's pages as a streaming source.

A poller leaves every answer of the feed as ``page=<number>/etag=<tag>/<files>`` below one folder, a
page's folder renamed into place when it is whole. The source's offset is the number of the last
page, so a restarted query goes on behind it. An answer with the tag of the one before is the
same page once more: it is told by its folder's name and never opened.
"""

import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import ArrayType, StructType

from patchlens.schemas import FEED_ID, RAW_EVENT

FORMAT = "feed_pages"
PAGES = "page bigint, etag string, value string"
#: Pages that a task reads, at most.
TASK_PAGES = 32


class Pages(InputPartition):
    """Some pages (number, tag, folder) for one task."""

    def __init__(self, pages: list[tuple[int, str, str]]):
        self.pages = pages


class PageReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def _numbers(self) -> list[int]:
        names = os.listdir(self.path) if os.path.isdir(self.path) else []
        return sorted(int(n.removeprefix("page=")) for n in names if n.startswith("page="))

    def _tag(self, number: int) -> str:
        names = os.listdir(f"{self.path}/page={number}")
        return min((n.removeprefix("etag=") for n in names if n.startswith("etag=")), default="")

    def initialOffset(self) -> dict:
        return {"page": -1}

    def latestOffset(self) -> dict:
        return {"page": max(self._numbers(), default=-1)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        numbers = [n for n in self._numbers() if n <= end["page"]]
        before = [n for n in numbers if n <= start["page"]]
        last = self._tag(before[-1]) if before else None
        changed = []
        for n in numbers[len(before) :]:
            tag = self._tag(n)
            if tag != last or not tag:
                changed.append((n, tag, f"{self.path}/page={n}/etag={tag}"))
            last = tag
        return [Pages(changed[i : i + TASK_PAGES]) for i in range(0, len(changed), TASK_PAGES)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        for number, tag, folder in partition.pages:
            texts = []
            for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
                if not name.startswith(("_", ".")):
                    with open(f"{folder}/{name}", encoding="utf-8") as file:
                        texts.append(file.read())
            columns = [pa.array([number] * len(texts), pa.int64()), pa.array([tag] * len(texts), pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page", "etag", "value"])


class FeedPages(DataSource):
    """``spark.readStream.format("feed_pages")``: (page, etag, value), one row for each file of a changed page."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAGES

    def streamReader(self, schema: StructType) -> PageReader:
        return PageReader(self.options["path"].removeprefix("file:").rstrip("/"))


def read_feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """An unbounded frame (page, etag, value) of the changed pages below a folder that driver and executors share."""
    spark.dataSource.register(FeedPages)
    return spark.readStream.format(FORMAT).option("path", path).load()


def feed_events(pages: DataFrame, *extra: str) -> DataFrame:
    """Raw events of pages, each a list of events or a single one; what is not JSON gives none.

    The feed calls an event's key ``id`` and sends it as text; it becomes ``event_id``.
    """
    event = StructType([*RAW_EVENT.fields, FEED_ID])
    events = pages.select(F.explode(F.from_json("value", ArrayType(event))).alias("event"), *extra)
    key = F.coalesce("event.event_id", F.expr(f"try_cast(event.{FEED_ID.name} AS bigint)"))
    names = [n for n in RAW_EVENT.names if n != "event_id"]
    return events.filter(F.col("event").isNotNull()).select(key.alias("event_id"), *(f"event.{n}" for n in names), *extra)
