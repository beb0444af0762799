"""The latest leak of each repository, kept by a stream in keyed state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from patchlens.streaming.jobs import ROCKSDB, STATE_STORE, _query_id, _start, started_with

FOUND = "at bigint, commit_sha string, entropy_score double"
#: Files of a micro-batch's changes.
FILES = 8
LATEST = "repo_name string, commit_sha string, entropy_score double, detected_at timestamp"


class KeepLatest(StatefulProcessor):
    """One state row for each key: its latest leak by time, then hash, then score, in whatever order they come."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", FOUND, self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.latest.get()) if self.latest.exists() else None
        best = held
        for part in rows:
            last = part.sort_values(["at", "commit_sha", "entropy_score"]).iloc[-1]
            mine = (int(last["at"]), str(last["commit_sha"]), float(last["entropy_score"]))
            best = mine if best is None or mine > best else best
        if best != held:
            self.latest.update(best)
            yield pd.DataFrame([(key[0], *best)], columns=["repo_name", "at", "commit_sha", "entropy_score"])

    def close(self) -> None:
        pass


def stream_latest(leaks: DataFrame, keep: str | None = None, salts: int = 4) -> DataFrame:
    """A stream of leaks -> a repository's latest leak whenever one part of its state changes.

    Leaks come in any order; those without a repository, commit, score or time are none. A busy repository is
    cut into ``salts`` parts by its rows, each with its own latest, so the latest of all is that of its
    parts (``latest_snapshot``). With ``keep`` (such as ``90 days``) a part's state goes when it was not
    changed for so long; what comes later is then taken as new.
    """
    part = F.pmod(F.xxhash64("commit_sha", "detected_at"), F.lit(salts)).cast("int").alias("part")
    found = leaks.dropna(subset=["repo_name", "commit_sha", "entropy_score", "detected_at"]).select(
        "repo_name", part, F.unix_micros("detected_at").alias("at"), "commit_sha", F.col("entropy_score").cast("double")
    )
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000) if keep else None
    changed = found.groupBy("repo_name", "part").transformWithStateInPandas(
        KeepLatest(keep_ms), f"repo_name string, {FOUND}", "update", "ProcessingTime" if keep else "None"
    )
    return changed.select("repo_name", "commit_sha", "entropy_score", F.timestamp_micros("at").alias("detected_at"))


def run_latest(
    leaks: DataFrame, out: str, checkpoint: str, trigger: str | None = None, keep: str | None = None
) -> StreamingQuery:
    """Keep ``out`` current: every micro-batch stores the repositories it changed.

    State that expires needs a ``trigger`` interval: its clock runs on without new leaks, so a query that is to
    stop when it has read what is there would never stop.
    """
    if keep and not trigger:
        raise ValueError("keep needs a trigger interval")

    def store(batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/stream_id={_query_id(batch.sparkSession)}/batch_id={batch_id}"
        # An exchange: coalesced, one task would go through all state partitions one after the other.
        batch.repartition(FILES, "repo_name").write.mode("overwrite").parquet(target)

    with started_with(leaks.sparkSession, {STATE_STORE: ROCKSDB}):  # the store that a stateful processor needs
        return _start(stream_latest(leaks, keep), store, checkpoint, trigger, "update")


def latest_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """One row for each repository: its latest leak. Reads changes, not all leaks."""
    newest = F.max(F.struct("detected_at", "commit_sha", "entropy_score")).alias("newest")
    rows = spark.read.schema(LATEST).parquet(out).groupBy("repo_name").agg(newest)
    return rows.select("repo_name", "newest.commit_sha", "newest.entropy_score", "newest.detected_at")
