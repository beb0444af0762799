"""Reports over the leak table (repo_name, commit_sha, entropy_score, detected_at)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchlens.functions.masking import MIDDLE_DOT, mask_repo, mask_segments, mask_sha
from patchlens.functions.report import risk_band
from patchlens.lookups import LEAK_THRESHOLD
from patchlens.operators.filters import AsOf, since

# Day names by Spark's day of week, 1 to 7, and the report's row order.
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
WEEK_FROM_MONDAY = (2, 3, 4, 5, 6, 7, 1)


def _stable(score: Column) -> Column:
    """An average as a sort key: the order of its additions must not decide ranks."""
    return F.round(score, 9)


def kpi(
    leaks: DataFrame,
    as_of: AsOf = None,
    hours: int = 24,
    threshold: float = LEAK_THRESHOLD,
    approx: bool = False,
) -> DataFrame:
    """One row: distinct commits, mean entropy, rows over the threshold, distinct repositories.

    ``approx`` trades the exact distinct counts, which shuffle every distinct
    hash, for sketches of fixed size.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return since(leaks, f"{hours} HOURS", as_of).agg(
        distinct("commit_sha").alias("total_leaks"),
        F.avg("entropy_score").alias("avg_risk"),
        F.count_if(F.col("entropy_score") > threshold).alias("critical_count"),
        distinct("repo_name").alias("affected_repos"),
    )


def kpi_tiles(kpis: DataFrame) -> DataFrame:
    """The ``kpi`` row as display text."""
    return kpis.select(
        F.format_number("total_leaks", 0).alias("total_leaks"),
        F.format_number("avg_risk", 3).alias("avg_risk"),
        F.format_number("critical_count", 0).alias("critical_count"),
        F.format_number("affected_repos", 0).alias("affected_repos"),
    )


def entropy_hourly(leaks: DataFrame) -> DataFrame:
    """Mean and maximum entropy per hour, oldest hour first."""
    return (
        leaks.groupBy(F.date_trunc("hour", "detected_at").alias("hr"))
        .agg(F.avg("entropy_score").alias("avg_entropy"), F.max("entropy_score").alias("max_entropy"))
        .orderBy("hr")
    )


def entropy_distribution(leaks: DataFrame, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    """The scores of the last hours, one row per leak."""
    return since(leaks, f"{hours} HOURS", as_of).select("entropy_score")


def entropy_histogram(
    leaks: DataFrame,
    as_of: AsOf = None,
    hours: int = 24,
    bins: int = 25,
    threshold: float = LEAK_THRESHOLD,
) -> DataFrame:
    """Equal-width bins between the lowest and the highest score, empty bins included.

    ``is_critical`` marks the bins that reach above the threshold. The scores are
    read twice, for their range and for the bins; only bin counts are shuffled.
    """
    scores = entropy_distribution(leaks, as_of, hours).filter(F.col("entropy_score").isNotNull())
    bounds = scores.agg(F.min("entropy_score").alias("low"), F.max("entropy_score").alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    # The highest score closes the last bin; a single score fills the first one.
    bucket = F.when(F.col("entropy_score") >= high, F.when(high > low, bins).otherwise(1)).otherwise(
        F.width_bucket("entropy_score", low, high, F.lit(bins))
    )
    filled = scores.groupBy(bucket.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every_bin = leaks.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    upper = low + F.col("bin") * width
    return (
        every_bin.filter(low.isNotNull())
        .join(filled, "bin", "left")
        .select(
            "bin",
            (low + (F.col("bin") - 1) * width).alias("lo"),
            upper.alias("hi"),
            F.coalesce("n", F.lit(0)).alias("n"),
            (upper > threshold).alias("is_critical"),
        )
    )


def top_risky_repos(
    leaks: DataFrame, as_of: AsOf = None, hours: int = 24, k: int = 10
) -> DataFrame:
    """The repositories with the highest mean entropy, masked after ranking.

    The distinct count makes Spark aggregate per (repository, commit) first, so
    the rows of one busy repository are spread over all tasks.
    """
    ranked = (
        since(leaks, f"{hours} HOURS", as_of)
        .groupBy("repo_name")
        .agg(
            F.count_distinct("commit_sha").alias("leak_count"),
            F.avg("entropy_score").alias("avg_entropy"),
        )
        .orderBy(_stable(F.col("avg_entropy")).desc(), "repo_name")
        .limit(k)
    )
    return ranked.select(
        mask_repo(F.col("repo_name"), 4, 8).alias("repo_name"),
        "leak_count",
        F.round("avg_entropy", 2).alias("avg_entropy"),
    )


def activity_heatmap(leaks: DataFrame) -> DataFrame:
    """Distinct commits per day of week (1 is Sunday) and hour."""
    return (
        leaks.groupBy(
            F.dayofweek("detected_at").alias("dow"), F.hour("detected_at").alias("hour")
        )
        .agg(F.count_distinct("commit_sha").alias("leak_count"))
        .select(
            "dow",
            F.get(F.array(*map(F.lit, DAY_NAMES)), F.col("dow") - 1).alias("day_name"),
            "hour",
            "leak_count",
        )
    )


def heatmap_pivot(leaks: DataFrame) -> DataFrame:
    """The heatmap as seven rows from Monday on, columns h00 to h23.

    An hour without leaks is 0 on a day that has any; a day without any is NULL.
    The pivot runs over the at most 168 rows of the heatmap, with its columns
    given, so it needs no pass to discover them.
    """
    hours = [f"h{hour:02d}" for hour in range(24)]
    cells = activity_heatmap(leaks).withColumn("column", F.format_string("h%02d", "hour"))
    days = cells.groupBy("dow").pivot("column", hours).agg(F.sum("leak_count")).na.fill(0, hours)
    spine = leaks.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, WEEK_FROM_MONDAY))).alias("place", "dow")
    )
    day_name = F.get(F.array(*map(F.lit, DAY_NAMES)), F.col("dow") - 1)
    return (
        spine.join(days, "dow", "left")
        .orderBy("place")
        .select(day_name.alias("day_name"), *hours)
    )


def live_latest(leaks: DataFrame, k: int = 50) -> DataFrame:
    """The newest leak of each repository, the ``k`` newest of those, masked.

    The filter on the row number lets Spark keep one row per repository in every
    task before the shuffle, so a busy repository does not fill one task.
    """
    newest_first = Window.partitionBy("repo_name").orderBy(
        F.desc("detected_at"), F.desc("commit_sha"), F.desc("entropy_score")
    )
    latest = (
        leaks.select("repo_name", "commit_sha", "entropy_score", "detected_at")
        .withColumn("rn", F.row_number().over(newest_first))
        .filter(F.col("rn") == 1)
        .orderBy(F.desc("detected_at"), "repo_name")
        .limit(k)
    )
    entropy = F.round("entropy_score", 2)
    return latest.select(
        mask_repo(F.col("repo_name"), 3, 6).alias("repository"),
        mask_sha(F.col("commit_sha"), MIDDLE_DOT).alias("commit_sha"),
        entropy.alias("entropy"),
        risk_band(entropy).alias("risk"),
        F.date_format("detected_at", "yyyy-MM-dd HH:mm").alias("detected_at"),
    )


def public_security_stream(leaks: DataFrame, ordered: bool = True) -> DataFrame:
    """All leaks with repository and commit masked, newest first.

    A whole batch may carry one time. The further sort columns let Spark cut its
    rows into several ranges, and fix their order.
    """
    newest_first = F.desc("detected_at"), "commit_sha", "repo_name", "entropy_score"
    rows = leaks.orderBy(*newest_first) if ordered else leaks
    return rows.select(
        mask_segments(F.col("repo_name")).alias("masked_repo"),
        mask_sha(F.col("commit_sha")).alias("masked_sha"),
        F.round("entropy_score", 2).alias("entropy_score"),
        "detected_at",
    )
