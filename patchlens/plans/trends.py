"""Reports over the trend table (library_name, language, repo_name, detected_at).

Every report counts in two steps, per task and then per library, takes the top
of the counts, and only then drops noise: fewer rows than the limit may remain.
What follows the limit works on a few hundred rows.
"""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.lookups import NOISE_WORDS, SECTOR_SEEDS
from patchlens.operators.filters import AsOf, drop_noise, match_sectors, since


def _by_usage():
    return [F.desc("usage_count"), F.asc("library_name")]


def trend_counts(trends: DataFrame, as_of: AsOf = None, interval: str = "7 DAYS") -> DataFrame:
    """How often each library was added."""
    return (
        since(trends, interval, as_of)
        .groupBy("library_name")
        .agg(F.count("*").alias("usage_count"))
    )


def _top(trends: DataFrame, as_of: AsOf, interval: str, limit: int) -> DataFrame:
    return trend_counts(trends, as_of, interval).orderBy(*_by_usage()).limit(limit)


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    """Number the rows by usage and keep the first ``k``."""
    rank = F.row_number().over(Window.orderBy(*_by_usage()))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def tech_trends_top(
    trends: DataFrame,
    noise: DataFrame | Iterable[str] = NOISE_WORDS,
    as_of: AsOf = None,
    days: int = 7,
    limit: int = 300,
    k: int = 60,
) -> DataFrame:
    """The most used libraries; ``usage_share`` is relative to the first one."""
    first = _ranked(drop_noise(_top(trends, as_of, f"{days} DAYS", limit), noise), k)
    highest = F.first("usage_count").over(Window.orderBy(*_by_usage()))
    return first.select(
        "rank", "library_name", "usage_count", (F.col("usage_count") / highest).alias("usage_share")
    ).orderBy("rank")


def trend_radar(
    trends: DataFrame,
    noise: DataFrame | Iterable[str] = NOISE_WORDS,
    as_of: AsOf = None,
    k: int = 12,
) -> DataFrame:
    """The head of ``tech_trends_top``."""
    return tech_trends_top(trends, noise, as_of).filter(F.col("rank") <= k)


def llm_candidates(
    trends: DataFrame,
    noise: DataFrame | Iterable[str] = NOISE_WORDS,
    as_of: AsOf = None,
    hours: int = 24,
    limit: int = 300,
    k: int = 150,
) -> DataFrame:
    """The libraries of the last day that the sector report is written from."""
    top = _top(trends, as_of, f"{hours} HOURS", limit)
    return (
        _ranked(drop_noise(top, noise), k)
        .select("rank", "library_name", "usage_count")
        .orderBy("rank")
    )


def category_libs(
    trends: DataFrame,
    seeds: DataFrame | Mapping[str, Iterable[str]] = SECTOR_SEEDS,
    noise: DataFrame | Iterable[str] = NOISE_WORDS,
    as_of: AsOf = None,
    days: int = 7,
    limit: int = 500,
    per_sector: int = 20,
) -> DataFrame:
    """The most used libraries of each sector."""
    named = drop_noise(_top(trends, as_of, f"{days} DAYS", limit), noise)
    in_sector = Window.partitionBy("sector").orderBy(*_by_usage())
    return (
        match_sectors(named, seeds)
        .withColumn("rank", F.row_number().over(in_sector))
        .filter(F.col("rank") <= per_sector)
        .orderBy("sector_ord", "rank")
        .select("sector", "rank", "library_name", "usage_count")
    )
