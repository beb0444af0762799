"""KPIs of every window of hours, from a stream of leaks in any order.

Each micro-batch stores what it adds to each hour: one row for a commit and repository in that hour, by day.
The parts merge, so nothing is held in state, no leak comes too late, and the distinct counts
are exact. ``compact_hours`` merges the batches stored since it last ran; then a day is read from one
folder for each compaction that changed it, and not from one for each micro-batch.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patchlens.lookups import LEAK_THRESHOLD
from patchlens.streaming.jobs import _start
from patchlens.streaming.lookup import _folders

KEY = ("detected_date", "hr", "commit_sha", "repo_name")
SUMS = ("leaks", "scored", "entropy_sum", "critical")
PARTS = (
    "hr timestamp, commit_sha string, repo_name string, leaks long, scored long, entropy_sum double, "
    "critical long, detected_date date"
)


def hour_parts(leaks: DataFrame, threshold: float = LEAK_THRESHOLD) -> DataFrame:
    """What some leaks add to each hour, commit and repository; leaks without a time add nothing."""
    score = F.col("entropy_score").cast("double")
    timed = leaks.filter(F.col("detected_at").isNotNull())
    return timed.withColumns({"detected_date": F.to_date("detected_at"), "hr": F.date_trunc("hour", "detected_at")}).groupBy(*KEY).agg(
        F.count("*").alias("leaks"), F.count(score).alias("scored"),
        F.coalesce(F.sum(score), F.lit(0.0)).alias("entropy_sum"), F.count_if(score > threshold).alias("critical"),
    )


def _put(parts: DataFrame, path: str) -> None:
    parts.write.mode("overwrite").partitionBy("detected_date").parquet(path)


def run_sliding(
    leaks: DataFrame, out: str, checkpoint: str, trigger: str | None = None, threshold: float = LEAK_THRESHOLD
) -> StreamingQuery:
    """Store the parts of a stream of leaks (repo_name, commit_sha, entropy_score, detected_at) below ``out``.

    A batch that is done again replaces its own rows. Batches are told apart by number, so ``out`` belongs
    to this ``checkpoint``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        _put(hour_parts(batch, threshold), f"{out}/batches/batch_id={batch_id}")

    return _start(leaks, store, checkpoint, trigger)


def _state(spark: SparkSession, out: str) -> tuple[list[int], list[int]]:
    """The last batches of the compactions done, and the whole batches since."""
    done = sorted(int(n) for n in _folders(spark, f"{out}/compacted", "upto=", "_SUCCESS"))
    whole = sorted(int(n) for n in _folders(spark, f"{out}/batches", "batch_id=", "_SUCCESS"))
    return done, [n for n in whole if not done or n > done[-1]]


def _read(spark: SparkSession, base: str, level: str, numbers: list[int]) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], PARTS)
    rows = spark.read.schema(f"{PARTS}, {level} long").option("basePath", base)
    return rows.parquet(*(f"{base}/{level}={n}" for n in numbers)).drop(level)


def stored_parts(spark: SparkSession, out: str) -> DataFrame:
    """All parts stored up to now, each once; a filter on ``detected_date`` reads those days only."""
    done, new = _state(spark, out)
    return _read(spark, f"{out}/compacted", "upto", done).unionByName(_read(spark, f"{out}/batches", "batch_id", new))


def compact_hours(spark: SparkSession, out: str) -> int | None:
    """Merge the batches stored since the last compaction; the number of the last one, None if there is none.

    Work grows with the new batches. A compaction counts once it is whole: one that failed is done again in
    its place. Only one may run at a time; the stream may go on. Batches it covers are read no more.
    """
    _, new = _state(spark, out)
    if not new:
        return None
    parts = _read(spark, f"{out}/batches", "batch_id", new)
    merged = parts.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in SUMS))
    _put(merged, f"{out}/compacted/upto={new[-1]}")
    return new[-1]


def _distinct(parts: DataFrame, key: str, hours: int, name: str) -> DataFrame:
    """(hr, name): by how much the number of different keys in the window ending with an hour changes there.

    A key is in a window from the hour it appears until it is gone for ``hours``: two changes for
    each of its hours, and not one row for each window that the hour lies in.
    """
    seen = parts.filter(F.col(key).isNotNull()).select(key, "hr").distinct()
    again = F.lead("hr").over(Window.partitionBy(key).orderBy("hr"))
    gone = F.least(F.col("hr") + F.expr(f"INTERVAL {hours} HOURS"), "again").alias("gone")
    spans = seen.select("hr", again.alias("again")).select("hr", gone)
    change = F.array(F.struct(F.col("hr"), F.lit(1).alias("by")), F.struct(F.col("gone").alias("hr"), F.lit(-1).alias("by")))
    return spans.select(F.inline(change)).groupBy("hr").agg(F.sum("by").alias(name))


def sliding_kpis(parts: DataFrame, hours: int = 24) -> DataFrame:
    """As ``kpi``, for the last ``hours`` whole hours up to each hour ``hr``, from the first one with a leak to the last.

    Windows without a leak are left out. Only sums by hour meet in one window without a partition.
    """
    sums = parts.groupBy("hr").agg(*(F.sum(c).alias(c) for c in SUMS))
    span = parts.agg(F.min("hr").alias("first"), F.max("hr").alias("last"))
    grid = span.filter("first IS NOT NULL").select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("hr"))
    rows = grid.join(sums, "hr", "left")
    for key, name in (("commit_sha", "commits"), ("repo_name", "repos")):
        rows = rows.join(_distinct(parts, key, hours, name), "hr", "left")
    in_window = Window.orderBy(F.unix_timestamp("hr")).rangeBetween(-3600 * (hours - 1), 0)
    up_to = Window.orderBy("hr").rowsBetween(Window.unboundedPreceding, 0)

    def total(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    return rows.select(
        "hr",
        total("commits", up_to).alias("total_leaks"),
        (F.sum("entropy_sum").over(in_window) / F.nullif(F.sum("scored").over(in_window), F.lit(0))).alias("avg_risk"),
        total("critical", in_window).alias("critical_count"),
        total("repos", up_to).alias("affected_repos"),
        total("leaks", in_window).alias("leaks"),
    ).filter("leaks > 0").drop("leaks")
