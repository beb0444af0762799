"""Streaming jobs: pushes to leaks and trends, de-duplication, hourly entropy."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patchlens.lookups import LEAK_THRESHOLD
from patchlens.operators.commits import explode_files
from patchlens.operators.dependencies import with_libraries
from patchlens.operators.scoring import with_entropy
from patchlens.schemas import SHA_PREFIX, SHA_PREFIX_LENGTH
from patchlens.sources.sinks import few_days, write_leaks, write_lists, write_trends
from patchlens.streaming import lookup

KEEP = StorageLevel.MEMORY_AND_DISK

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State on disk, in one store for each partition of a join, with a bound on what an executor's stores hold in memory.
#: Spark's default keeps all state, in two versions, in the heap.
STATE_ON_DISK = {
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def file_findings(files: DataFrame, threshold: float, *extra: str) -> DataFrame:
    """Files that leak or are manifests, without their text: entropy, language, libraries."""
    telling = (F.col("entropy_score") > threshold) | F.col("language").isNotNull()
    return (
        with_entropy(with_libraries(files))
        .filter(telling)
        .select("repo_name", "commit_sha", "entropy_score", "language", "libraries", *extra)
    )


def leaks_in(findings: DataFrame, threshold: float, *extra: str) -> DataFrame:
    over = findings.filter(F.col("entropy_score") > threshold)
    return over.select("repo_name", "commit_sha", "entropy_score", *extra)


def manifests_in(findings: DataFrame, *extra: str) -> DataFrame:
    manifests = findings.filter(F.col("language").isNotNull())
    return manifests.select("repo_name", "commit_sha", "language", "libraries", *extra)


def commit_findings(commits: DataFrame, threshold: float = LEAK_THRESHOLD) -> DataFrame:
    """The findings of commits: some hundred bytes for each telling file instead of its text.

    Store them by ``write_findings`` when commits arrive. Micro-batches then join them, and no
    text is scored again because its commit is pushed again.
    """
    return file_findings(explode_files(commits), threshold)


def _pushed_findings(push: DataFrame, findings: DataFrame) -> DataFrame:
    """Pushes with the findings of their commits, by a plain join of narrow rows.

    Where the findings are laid out by hash prefix, the join is on the prefix as well, so that
    Spark prunes their folders by the pushed prefixes at run time.
    """
    same = (push["name"] == findings["repo_name"]) & (push["head"] == findings["commit_sha"])
    if SHA_PREFIX.name in findings.columns:
        same &= F.substring(push["head"], 1, SHA_PREFIX_LENGTH) == findings[SHA_PREFIX.name]
    return push.join(findings, same, "inner").drop("name", "head", SHA_PREFIX.name)


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def _start(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None,
    mode: str = "append",
) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


@contextmanager
def started_with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for a query that is started meanwhile: it keeps them, and the session has its own again afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _query_id(spark: SparkSession) -> str:
    """Id of the running query; it stays the same over restarts from a checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_stream(
    push: DataFrame,
    commits: DataFrame | Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    threshold: float = LEAK_THRESHOLD,
    trigger: str | None = None,
    delay: str = "1 hour",
    clustered: bool = False,
    salts: int = 8,
    arrival: tuple[str, str] = ("pushed_at", "committed_at"),
) -> StreamingQuery:
    """Start the job: pushes (name, head, pushed_at) -> ``out/leaks`` and ``out/trends``.

    ``detected_at`` is the push time, or the batch's time where a push has none.
    Without a ``trigger`` interval the query takes what is there and stops.
    Files are sorted only if ``clustered``; ``recluster`` does that for whole days.

    ``commits`` is what every micro-batch looks up: a table of findings
    (``write_findings``), or the commit table, whose texts each micro-batch then
    scores. It may also be a stream of new commits with a ``committed_at`` column.
    A frame over files keeps the file list it was made with; pass a function, such
    as ``lambda: read_findings(spark, path)``, for each micro-batch to see new files.

    The stream is the form for large volumes: files are analysed as they arrive,
    only marks of the findings are kept in state, their names in ``out/lists``, and a push meets commits that arrive up to
    ``delay`` before or after it. Name the columns of arrival times by ``arrival`` (of pushes, of
    commits); they default to the push time and ``committed_at``, and a push without
    one has its batch's. Pushes that meet none are stored in ``out/waiting``, and
    ``settle`` looks them up among the outcomes that ``run_findings`` stores.
    """

    def store(pushed: DataFrame, manifests: DataFrame, leaks: DataFrame, batch_id: int) -> None:
        stream_id = _query_id(manifests.sparkSession)
        # Pushes times names is by far the most there is: it goes from the join into files, without a shuffle.
        gathered = clustered or not few_days(pushed)
        write_trends(manifests, f"{out}/trends", batch_id, stream_id, clustered, gathered=gathered)
        write_leaks(leaks, f"{out}/leaks", batch_id, stream_id, clustered)

    def look_up(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(F.col("name").isNotNull() & F.col("head").isNotNull())
        pushed = known.select("name", "head", F.col("pushed_at").alias("detected_at")).persist(KEEP)
        table = commits() if callable(commits) else commits
        # What is kept is a row for each push and one for each file found in a pushed commit; never their product.
        findings, scored = table, None
        if "files" in table.columns:
            asked = pushed.select(F.col("name").alias("repo_name"), F.col("head").alias("commit_sha")).distinct()
            scored = commit_findings(table, threshold).join(asked, ["repo_name", "commit_sha"], "left_semi").persist(KEEP)
            findings = scored
        prefix = [SHA_PREFIX.name] if SHA_PREFIX.name in findings.columns else []
        try:
            manifests = _pushed_findings(pushed, manifests_in(findings, *prefix))
            store(pushed, manifests, _pushed_findings(pushed, leaks_in(findings, threshold, *prefix)), batch_id)
        finally:
            pushed.unpersist()
            if scored is not None:
                scored.unpersist()

    if callable(commits) or not commits.isStreaming:
        # The batch's time is kept with its offsets, so a retry gives the same one.
        timed = push.withColumn("pushed_at", F.coalesce("pushed_at", F.current_timestamp()))
        return _start(timed, look_up, checkpoint, trigger)

    pushed, arrived = arrival
    named = push.filter(F.col("name").isNotNull() & F.col("head").isNotNull())
    timed = named.withColumn("detected_at", F.coalesce("pushed_at", F.current_timestamp()))
    if pushed == "pushed_at":
        timed = timed.withColumn("pushed_at", F.col("detected_at"))
    # The state keeps what commits hold without the lists of names. These go past it, once for each commit.
    marks = lookup.commit_marks(commits, threshold, arrived).withColumnRenamed(arrived, "_arrived")
    joined = lookup.near_in_time(timed, marks, pushed, "_arrived", delay, salts)
    met = joined.select(*lookup.WAITING, "repo_name", "commit_sha", "entropy_score", "language", "text_key", "_arrived")
    lists = lookup.commit_lists(commits, arrived).withColumnRenamed(arrived, "_arrived")
    passing = met.withColumn("passing", F.lit(False)).unionByName(
        lists.withColumn("passing", F.lit(True)), allowMissingColumns=True
    )

    def split_or_wait(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id, stored = _query_id(spark), f"{out}/lists"
        batch.persist(KEEP)
        try:
            with lookup.adaptive(spark):
                write_lists(batch.filter("passing").select(*lookup.LIST_KEY, "libraries", "_arrived"), stored, "_arrived", batch_id, stream_id)
                rows = batch.filter("NOT passing")
                lookup.write_waiting(rows, out, batch_id, stream_id)
                manifests = rows.filter(F.col("language").isNotNull()).drop("libraries")
                found = lookup.with_lists(manifests, stored, "_arrived")
                store(rows, manifests_in(found, "detected_at"), leaks_in(rows, threshold, "detected_at"), batch_id)
        finally:
            batch.unpersist()

    with started_with(push.sparkSession, STATE_ON_DISK):
        return _start(passing, split_or_wait, checkpoint, trigger)


def run_facts(
    rows: DataFrame, kind: str, out: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Store a stream of fact rows as ``out/<kind>``, ``leaks`` or ``trends``; the stream outlives bad rows.

    Rows that break a required column go to ``out/rejects/<kind>`` with what they break.
    """
    write = {"leaks": write_leaks, "trends": write_trends}[kind]

    def store(batch: DataFrame, batch_id: int) -> None:
        stream_id = _query_id(batch.sparkSession)
        held = batch.persist(KEEP)  # read twice: for the table and for what is set aside
        try:
            write(held, f"{out}/{kind}", batch_id, stream_id, False, rejects=f"{out}/rejects/{kind}")
        finally:
            held.unpersist()

    timed = rows.withColumn("detected_at", F.coalesce("detected_at", F.current_timestamp()))
    return _start(timed, store, checkpoint, trigger)


def run_append(rows: DataFrame, out: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Store a stream's rows as they are, one folder per micro-batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/stream_id={_query_id(batch.sparkSession)}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    return _start(rows, store, checkpoint, trigger)


def dedupe_stream(
    push: DataFrame, key: str = "event_id", time: str = "created_at", delay: str = "1 hour"
) -> DataFrame:
    """Drop re-deliveries of an event for at least ``delay``; state older than that goes.

    Events without a key are nobody's re-delivery and stay.
    """
    timed = push.withWatermark(time, delay)
    keyed = timed.filter(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return keyed.unionByName(timed.filter(F.col(key).isNull()))


def stream_entropy_hourly(leaks: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Mean and maximum entropy per hour of a stream of leaks.

    State holds one row per hour still open; leaks later than ``delay`` are left out.
    """
    return (
        leaks.withWatermark("detected_at", delay)
        .groupBy(F.window("detected_at", "1 hour"))
        .agg(F.avg("entropy_score").alias("avg_entropy"), F.max("entropy_score").alias("max_entropy"))
        .select(F.col("window.start").alias("hr"), "avg_entropy", "max_entropy")
    )


def run_hourly(
    leaks: DataFrame, out: str, checkpoint: str, trigger: str | None = None, delay: str = "1 hour"
) -> StreamingQuery:
    """Keep ``out`` current: every micro-batch stores the few hours it changed.

    Batches are told apart by number, so ``out`` belongs to this ``checkpoint``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # An exchange: coalesced, one task would hold the aggregations of all state partitions at once.
        batch.repartition(1).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _start(stream_entropy_hourly(leaks, delay), store, checkpoint, trigger, "update")


def hourly_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The state of every hour after the newest micro-batch that changed it."""
    schema = "hr timestamp, avg_entropy double, max_entropy double, batch_id long"
    newest = F.max_by(F.struct("avg_entropy", "max_entropy"), "batch_id").alias("newest")
    rows = spark.read.schema(schema).parquet(out).groupBy("hr").agg(newest)
    return rows.select("hr", "newest.avg_entropy", "newest.max_entropy")
