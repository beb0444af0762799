"""Table sinks: day partitions, clustered files, replay-safe batches.

A stream's batch goes to ``stream_id=<query>/batch_id=<n>`` below each of its days
(or hash prefixes) and replaces what an earlier attempt at the same batch left there.
A batch that is retried therefore leaves its rows once, and a read of one day lists that
day's folders only. A query started afresh has another id and never overwrites the
batches of the one before. A table is written by batches or without, not both.

Rows that break a required column stop a write, or go to a folder of ``rejects``
with the names of the columns they break, so that the others are stored.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.operators.constraints import require_not_null, tag_not_null
from patchlens.operators.dependencies import trend_rows
from patchlens.schemas import SHA_PREFIX, SHA_PREFIX_LENGTH

TREND_COLUMNS = ("library_name", "language", "repo_name", "detected_at")
TREND_CLUSTER = ("library_name", "language")
LEAK_COLUMNS = ("repo_name", "commit_sha", "entropy_score", "detected_at")
LEAK_CLUSTER = ("entropy_score",)

# Times of rejected rows, to the microsecond.
REJECT_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# Tasks at least that may share one day's rows of a write.
DAY_PARTS = 16

# Days (and prefixes) whose files a task of an unsorted write keeps open. With more of them Spark sorts the rest.
OPEN_FILES = 32
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# What such a file may hold in memory: rows not yet written, and each column's dictionary, whose entries take ten times
# their bytes. Spark doesn't count this memory, and by default 32 files may fill the heap.
OPEN_FILE = {"parquet.block.size": str(2 << 20), "parquet.dictionary.page.size": str(128 << 10)}


def few_days(rows: DataFrame, time: str = "detected_at") -> bool:
    """Whether a task can keep a file open for each day of the rows, so that they need not be gathered by day."""
    return rows.select(F.to_date(time)).distinct().limit(OPEN_FILES + 1).count() <= OPEN_FILES


def _stamped(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The table's columns, ``detected_at`` defaulting to now, and its day."""
    known = F.col("detected_at") if "detected_at" in df.columns else F.lit(None)
    at = F.coalesce(known.cast("timestamp"), F.current_timestamp())
    return (
        df.withColumn("detected_at", at)
        .select(*columns)
        .withColumn("detected_date", F.to_date("detected_at"))
    )


def _write_facts(
    df: DataFrame,
    path: str,
    cluster: tuple[str, ...],
    batch_id: int | None,
    stream_id: str | None,
    clustered: bool,
    expand: Callable[[DataFrame], DataFrame] | None = None,
    gathered: bool = True,
) -> None:
    rows = _gathered(df) if gathered else df
    if expand:  # after the shuffle, which then moves one row instead of one for each name
        rows = expand(rows)
    if clustered:
        rows = rows.sortWithinPartitions("detected_date", *cluster)
        _put(rows, path, ["detected_date"], batch_id, stream_id)
        return
    # Spark would sort the rows by day before it writes them, all names of all manifests, and spill them.
    # With a file open for each day of a task they go out as they come.
    conf = df.sparkSession.conf
    before = conf.get(WRITERS, None)
    conf.set(WRITERS, str(OPEN_FILES))
    try:
        _put(rows, path, ["detected_date"], batch_id, stream_id, OPEN_FILE)
    finally:
        conf.unset(WRITERS) if before is None else conf.set(WRITERS, before)


def _gathered(df: DataFrame) -> DataFrame:
    """The rows with those of a day in few tasks, so that a day has few files."""
    # Rebalancing brings a day's rows together but, unlike a hash repartition,
    # lets AQE split what is too large for one task and merge what is too small.
    # AQE splits between the tasks that produced the rows. A batch is mostly one
    # day and may come from one task, so a day is cut into parts beforehand. The
    # part depends on the row alone: a recomputed task sends it to the same place.
    part = F.pmod(F.xxhash64(*df.columns), F.lit(DAY_PARTS))
    rows = df.withColumn("_part", part)
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", "detected_date", "_part")
    else:  # as below a stateful stream, where the hint has no effect
        rows = rows.repartition("detected_date", "_part")
    return rows.drop("_part")


def _put(
    rows: DataFrame,
    path: str,
    levels: list[str],
    batch_id: int | None,
    stream_id: str | None,
    options: dict[str, str] | None = None,
) -> None:
    """Append, or put the rows in the place of the batch's own below each folder of ``levels``."""
    options = {"compression": "zstd", **(options or {})}
    if batch_id is None:
        rows.write.mode("append").options(**options).partitionBy(*levels).parquet(path)
        return
    named = rows.withColumns(
        {"stream_id": F.lit(stream_id or "batch"), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    writer = named.write.mode("overwrite").options(**options).partitionBy(*levels, "stream_id", "batch_id")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _checked(
    rows: DataFrame, required: list[str], rejects: str | None, batch_id: int | None, stream_id: str | None
) -> DataFrame:
    """The rows that have all required columns; the others stop the write, or go to ``rejects``."""
    if rejects is None:
        return require_not_null(rows, required)
    tagged = tag_not_null(rows, required)
    wrong = tagged.filter(F.size("violations") > 0)
    kept = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false", **REJECT_TIME})
    _put(wrong.select(kept.alias("row"), "violations"), rejects, [], batch_id, stream_id)
    return tagged.filter(F.size("violations") == 0).drop("violations")


def write_trends(
    df: DataFrame,
    path: str,
    batch_id: int | None = None,
    stream_id: str | None = None,
    clustered: bool = True,
    rejects: str | None = None,
    gathered: bool = True,
) -> None:
    """Append trends, or put them in the place of batch ``batch_id``.

    ``df`` has a row for each name, or manifests with their ``libraries`` still unexploded.
    Rows without a name go to the folder ``rejects``; without one they stop the write.
    ``clustered`` sorts each file by library and language, for its statistics to
    prune by. A micro-batch may leave that to ``recluster``.
    ``gathered`` brings a day's rows together by a shuffle of them all. Without it each task writes
    a file for each of its days, which is meant for ``few_days``: with more of them Spark sorts the rest.
    """
    if "libraries" in df.columns:
        rows = _stamped(df, ("libraries", *TREND_COLUMNS[1:]))
        expand = lambda held: trend_rows(held, "detected_at", "detected_date")
    else:
        named = _stamped(df, TREND_COLUMNS)
        rows, expand = _checked(named, ["library_name"], rejects, batch_id, stream_id), None
    _write_facts(rows, path, TREND_CLUSTER, batch_id, stream_id, clustered, expand, gathered)


def write_leaks(
    df: DataFrame,
    path: str,
    batch_id: int | None = None,
    stream_id: str | None = None,
    clustered: bool = True,
    rejects: str | None = None,
) -> None:
    """As ``write_trends`` for leaks, clustered by score; the required column is the commit."""
    rows = _checked(_stamped(df, LEAK_COLUMNS), ["commit_sha"], rejects, batch_id, stream_id)
    _write_facts(rows, path, LEAK_CLUSTER, batch_id, stream_id, clustered)


def recluster(
    df: DataFrame, path: str, cluster: tuple[str, ...], partitions: int | None = None
) -> None:
    """Rewrite the days in ``df`` (small files of many batches) as a clustered table.

    Rows are ranged by day and cluster columns, so that a filter on those reads
    few files. The last range column is a hash of the row: it lets one value that
    holds a large share of a day be cut over several tasks. It depends on the row
    alone, so a recomputed task places its rows as the lost one did.
    Days in ``df`` replace the same days in the table, other days stay. Give the
    number of range ``partitions`` for large days; it defaults to the session's.
    """
    columns = [c for c in df.columns if c not in ("stream_id", "batch_id")]
    spread_over = F.pmod(F.xxhash64(*columns), F.lit(1024))
    ranges = ["detected_date", *cluster, spread_over]
    (
        df.select(*columns)
        .repartitionByRange(*([partitions] if partitions else []), *ranges)
        .sortWithinPartitions("detected_date", *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("detected_date")
        .parquet(path)
    )


def write_commits(commits: DataFrame, path: str, batch_id: int | None = None, stream_id: str | None = None) -> None:
    """Append commits to a table laid out for lookups by hash, or put them in the place of a batch.

    One folder per hash prefix: a micro-batch of few pushes then reads few of
    the 4,096 folders instead of every patch. Made for large, infrequent appends.
    """
    prefix = F.substring("sha", 1, SHA_PREFIX_LENGTH)
    rows = commits.select("repo_name", "sha", "files").withColumn(SHA_PREFIX.name, prefix)
    _put(rows.hint("rebalance", SHA_PREFIX.name), path, [SHA_PREFIX.name], batch_id, stream_id)


def write_findings(findings: DataFrame, path: str, batch_id: int | None = None, stream_id: str | None = None) -> None:
    """Append the findings of new commits, one folder per hash prefix, or put them in the place of a batch.

    A batch is small: it has one folder, and its files are sorted by prefix for their
    statistics to prune by. Written without a batch twice, a finding gives every
    later push of its commit twice.
    """
    prefix = F.substring("commit_sha", 1, SHA_PREFIX_LENGTH)
    rows = findings.select("repo_name", "commit_sha", "entropy_score", "language", "libraries")
    rows = rows.withColumn(SHA_PREFIX.name, prefix)
    if batch_id is None:
        _put(rows.hint("rebalance", SHA_PREFIX.name), path, [SHA_PREFIX.name], None, None)
    else:
        _put(rows.sortWithinPartitions(SHA_PREFIX.name, "commit_sha"), path, [], batch_id, stream_id)


def write_lists(lists: DataFrame, path: str, arrived: str, batch_id: int, stream_id: str) -> None:
    """Put a batch's lists of libraries below the day each commit arrived on, for later micro-batches to look up."""
    rows = lists.filter(F.col(arrived).isNotNull()).withColumn("arrived_date", F.to_date(arrived))
    _put(rows, path, ["arrived_date"], batch_id, stream_id)


def write_vibes(
    df: DataFrame,
    path: str,
    batch_id: int | None = None,
    stream_id: str | None = None,
    required: tuple[str, ...] = (),
    rejects: str | None = None,
) -> None:
    """Append report rows, or put them in the place of a batch; ``vibe_date`` defaults to today.

    No column is required, unless named; ``rejects`` as in ``write_trends``.
    """
    known = F.col("vibe_date") if "vibe_date" in df.columns else F.lit(None)
    dated = df.withColumn("vibe_date", F.coalesce(known.cast("date"), F.current_date()))
    rows = dated.select("vibe_date", "theme_name", "summary", "top_libraries")
    if required:
        rows = _checked(rows, list(required), rejects, batch_id, stream_id)
    _put(rows.hint("rebalance", "vibe_date"), path, ["vibe_date"], batch_id, stream_id)


def write_messages(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Publish (key, value) rows to a queue or any other batch sink."""
    messages.write.format(fmt).mode("append").options(**options).save()
