"""The event side: filter, flatten, publish and parse pushes."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from patchlens.functions.text import not_blank
from patchlens.schemas import PUSH_MESSAGE

JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "ignoreNullFields": "false"}


def _is_push() -> Column:
    return F.col("type") == "PushEvent"


def _is_signal() -> Column:
    """A push whose repository name and head commit are both present."""
    return _is_push() & not_blank(F.col("repo.name")) & not_blank(F.col("payload.head"))


def push_events(events: DataFrame) -> DataFrame:
    return events.filter(_is_push())


def flatten_push(events: DataFrame, *extra: str) -> DataFrame:
    """Raw events -> (name, head, pushed_at), pushes with a name and a head only."""
    return events.filter(_is_signal()).select(
        F.col("repo.name").alias("name"),
        F.col("payload.head").alias("head"),
        F.col("created_at").alias("pushed_at"),
        *extra,
    )


def to_messages(events: DataFrame, shape: str = "raw", key: str | None = "repo.id") -> DataFrame:
    """Queue messages (key, value).

    ``raw`` sends every push whole, keyed by repository id so that one
    repository stays in one queue partition. ``flat`` sends name, head and time
    of the pushes that have both; pass ``key=None`` for messages without a key.
    """
    if shape == "raw":
        body = F.struct("type", "repo", "payload", "created_at")
        rows = push_events(events)
    elif shape == "flat":
        body = F.struct(
            F.col("repo.name").alias("name"),
            F.col("payload.head").alias("head"),
            F.col("created_at").alias("pushed_at"),
        )
        rows = events.filter(_is_signal())
    else:
        raise ValueError(f"unknown message shape: {shape}")
    return rows.select(
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
        F.to_json(body, JSON_TIME).alias("value"),
    )


def parse_messages(messages: DataFrame, *extra: str) -> DataFrame:
    """Message value -> (name, head, pushed_at); what is not JSON gives NULLs.

    Both message shapes are read. The raw one carries its fields nested.
    """
    data = F.from_json(F.col("value").cast("string"), PUSH_MESSAGE)
    return messages.select(data.alias("data"), *extra).select(
        F.coalesce("data.name", "data.repo.name").alias("name"),
        F.coalesce("data.head", "data.payload.head").alias("head"),
        F.coalesce("data.pushed_at", "data.created_at").alias("pushed_at"),
        *extra,
    )


def _batch_counts() -> list[Column]:
    return [
        F.count("*").alias("total_events"),
        F.count_if(_is_push()).alias("push_events"),
        F.count_if(_is_signal()).alias("signals"),
    ]


def push_batch_summary(events: DataFrame) -> DataFrame:
    """How many events came, how many were pushes, how many could be sent."""
    return events.agg(*_batch_counts())


def observe_pushes(events: DataFrame, observation: Observation | str = "pushes") -> DataFrame:
    """The same counts taken in passing: the events go on, no extra job runs.

    A stream reports them with each micro-batch's progress under the given name.
    """
    return events.observe(observation, *_batch_counts())


def dedupe_pushes(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event, however often its page was delivered.

    Events without a key are nobody's re-delivery and stay.
    """
    unique = events.filter(F.col(key).isNotNull()).dropDuplicates([key])
    return unique.unionByName(events.filter(F.col(key).isNull()))
