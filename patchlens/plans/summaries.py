"""Reports from stored summaries that merge, so that a window reads hours or days and not rows.

Leaks are summarised by hour: sketches of the distinct commits and repositories and of the
scores, and exact sums. Trends are summarised by day: counters of the frequent libraries, with what
they may have missed. The first give counts and ranks within known errors, the second name
the only libraries that an exact count of the top must look at.
"""

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchlens.lookups import LEAK_THRESHOLD
from patchlens.operators.filters import AsOf, as_of_column
from patchlens.plans.trends import trend_counts

#: Registers of a distinct sketch, as a power of two; three standard errors of it are 2.5 %.
DISTINCT_LG_K = 14
#: Size of a score sketch; its ranks are off by less than this share of all scores.
SCORE_K, SCORE_ERROR = 800, 0.01
#: Libraries counted by a day's summary in one task.
COUNTERS = 2000
#: Rows a task gathers before it counts them and trims its days.
MERGED_ROWS = 1_000_000


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """Share by which an estimated distinct count may be off, at three standard errors."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def leak_summaries(leaks: DataFrame, threshold: float = LEAK_THRESHOLD, lg_k: int = DISTINCT_LG_K, k: int = SCORE_K) -> DataFrame:
    """One row for each hour with leaks: sketches of fixed size, exact sums. Only these are shuffled.

    Store them by day and add the new hours; a leak that comes late gives its hour one more row, which counts
    like a part of it.
    """
    score = F.col("entropy_score")
    return leaks.groupBy(F.date_trunc("hour", "detected_at").alias("hr")).agg(
        F.hll_sketch_agg("commit_sha", lg_k).alias("commits"),
        F.hll_sketch_agg("repo_name", lg_k).alias("repos"),
        F.kll_sketch_agg_double(score.cast("double"), k).alias("scores"),
        F.sum(score).alias("entropy_sum"),
        F.count(score).alias("scored"),
        F.count_if(score > threshold).alias("critical_count"),
    )


def last_hours(hr: Column, hours: int, as_of: AsOf) -> Column:
    """Whether an hour is one of the last whole ``hours``, that of ``as_of`` being the last."""
    this = F.date_trunc("hour", as_of_column(as_of))
    return (hr <= this) & (hr > this - F.expr(f"INTERVAL {hours} HOURS"))


def summary_kpi(summaries: DataFrame, windows: Iterable[int], as_of: AsOf = None) -> DataFrame:
    """One row for each window of hours: as ``kpi``, both distinct counts within ``distinct_error``.

    All windows come from one scan of the summaries. Sums are exact.
    """
    inside = F.array_compact(F.array(*(F.when(last_hours(F.col("hr"), h, as_of), F.lit(h)) for h in windows)))
    return (
        summaries.withColumn("hours", F.explode(inside))
        .groupBy("hours")
        .agg(
            F.hll_sketch_estimate(F.hll_union_agg("commits")).alias("total_leaks"),
            (F.sum("entropy_sum") / F.sum("scored")).alias("avg_risk"),
            F.sum("critical_count").alias("critical_count"),
            F.hll_sketch_estimate(F.hll_union_agg("repos")).alias("affected_repos"),
        )
    )


def summary_quantiles(summaries: DataFrame, ranks: Iterable[float], hours: int = 24, as_of: AsOf = None) -> DataFrame:
    """(p, entropy_score, scored): the score at each rank p of the last hours, off by at most ``SCORE_ERROR`` in rank."""
    merged = summaries.filter(last_hours(F.col("hr"), hours, as_of) & (F.col("scored") > 0)).agg(
        F.kll_merge_agg_double("scores").alias("scores"), F.sum("scored").alias("scored")
    )
    at = F.array(
        *(
            F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("scores", F.lit(float(p))).alias("entropy_score"))
            for p in ranks
        )
    )
    # Without leaks there is nothing to rank, and the sketch would raise an error.
    return merged.filter(F.col("scored") > 0).select(F.inline(at), "scored")


def summary_histogram(summaries: DataFrame, edges: list[float], hours: int = 24, as_of: AsOf = None) -> DataFrame:
    """(bin, lo, hi, n): how many scores lie in (lo, hi], from ranks; n is off by at most twice ``SCORE_ERROR`` of all."""
    merged = summaries.filter(last_hours(F.col("hr"), hours, as_of) & (F.col("scored") > 0)).agg(
        F.kll_merge_agg_double("scores").alias("scores"), F.sum("scored").alias("scored")
    )
    rank = lambda edge: F.kll_sketch_get_rank_double("scores", F.lit(float(edge)))
    bins = F.array(
        *(
            F.struct(
                F.lit(i + 1).alias("bin"),
                F.lit(float(lo)).alias("lo"),
                F.lit(float(hi)).alias("hi"),
                F.round((rank(hi) - rank(lo)) * F.col("scored")).cast("bigint").alias("n"),
            )
            for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
        )
    )
    return merged.filter(F.col("scored") > 0).select(F.inline(bins))


# --- frequent libraries -------------------------------------------------------------


class FrequentCounts:
    """Misra-Gries counters: a count may be too small by ``missed`` at most, and never too large."""

    def __init__(self, size: int):
        self.size, self.counts, self.missed = size, Counter(), 0

    def add(self, counts: dict[str, int]) -> None:
        self.counts.update(counts)
        if len(self.counts) > 2 * self.size:
            self.trim()

    def trim(self) -> None:
        if len(self.counts) <= self.size:
            return
        # What the first counter beyond the size holds is taken off all of them.
        cut = sorted(self.counts.values(), reverse=True)[self.size]
        self.missed += cut
        self.counts = Counter({name: n - cut for name, n in self.counts.items() if n > cut})


def trend_summaries(trends: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(day, library_name, n, missed): each day's frequent libraries; the row without a name has what counts may lack.

    A task keeps ``counters`` names a day; rare names are never shuffled.
    """

    def merged(parts: list[pa.Table]) -> pa.Table:
        both = pa.concat_tables(parts).group_by(["day", "library_name"]).aggregate([("n", "sum")])
        return both.rename_columns(["day", "library_name", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counted and merged in Arrow; Python sees only the names that a day's counters keep.
        held, fresh, rows, missed = None, [], 0, Counter()

        def trimmed(table: pa.Table) -> pa.Table:
            kept = []
            for day, names in ((c["values"].as_py(), c["counts"].as_py()) for c in pc.value_counts(table.column("day"))):
                at = table.column("day")
                own = table.filter(pc.is_null(at) if day is None else pc.equal(at, pa.scalar(day, pa.date32())))
                if names > counters:
                    # What the first counter beyond the size holds is taken off all of them.
                    cut = int(np.partition(own.column("n").to_numpy(), names - counters - 1)[names - counters - 1])
                    missed[day] += cut
                    own = own.filter(pc.greater(own.column("n"), cut))
                    own = own.set_column(2, "n", pc.subtract(own.column("n"), cut))
                kept.append(own)
            return pa.concat_tables(kept) if kept else table

        days: set = set()
        for batch in batches:
            ones = pa.repeat(pa.scalar(1, pa.int64()), len(batch))
            fresh.append(pa.table([batch.column("day"), batch.column("library_name"), ones], names=["day", "library_name", "n"]))
            rows += len(batch)
            if rows >= MERGED_ROWS:
                held = trimmed(merged([*([held] if held is not None else []), *fresh]))
                days.update(held.column("day").unique().to_pylist())
                fresh, rows = [], 0
        if fresh or held is not None:
            held = trimmed(merged([*([held] if held is not None else []), *fresh]))
            days.update(held.column("day").unique().to_pylist())
            days.update(missed)
            zero = pa.repeat(pa.scalar(0, pa.int64()), held.num_rows)
            for part in held.append_column("missed", zero).to_batches():
                yield part
            at = list(days)
            columns = [pa.array(at, pa.date32()), pa.nulls(len(at), pa.string()), pa.array([0] * len(at), pa.int64()), pa.array([missed[d] for d in at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["day", "library_name", "n", "missed"])

    named = trends.filter(F.col("library_name").isNotNull()).select(F.to_date("detected_at").alias("day"), "library_name")
    parts = named.mapInArrow(count, "day date, library_name string, n bigint, missed bigint")
    return parts.groupBy("day", "library_name").agg(F.sum("n").alias("n"), F.sum("missed").alias("missed"))


def top_from_summaries(
    trends: DataFrame, summaries: DataFrame, as_of: AsOf = None, days: int = 7, limit: int = 300
) -> DataFrame:
    """(library_name, usage_count): the exact top of the last days, counting only libraries that can be in it.

    A library's true count lies between that of the whole days in the window and that of all its days plus
    what the summaries missed. If ``limit`` libraries surely reach a count that an unlisted one cannot,
    the others are out; if the summaries are too small to tell, every library is counted.
    """
    at = as_of_column(as_of)
    start = at - F.expr(f"INTERVAL {days} DAYS")
    touched = summaries.filter((F.col("day") >= F.to_date(start)) & (F.col("day") <= F.to_date(at)))
    whole = (F.col("day") > F.to_date(start)) & (F.col("day") < F.to_date(at))
    counts = (
        touched.groupBy("library_name")
        .agg(F.sum(F.when(whole, F.col("n")).otherwise(0)).alias("least"), F.sum("n").alias("most"), F.sum("missed").alias("missed"))
        .persist()
    )
    try:
        missed = counts.filter(F.col("library_name").isNull()).agg(F.sum("missed")).first()[0] or 0
        names = counts.filter(F.col("library_name").isNotNull())
        sure = names.orderBy(F.desc("least")).limit(limit).agg(F.min("least"), F.count("*")).first()
        reached = sure[0] if sure[1] == limit else 0
        found = trends
        if reached > missed:
            able = names.filter(F.col("most") + F.lit(missed) >= F.lit(reached)).select("library_name")
            found = trends.join(able, "library_name", "left_semi")
    finally:
        counts.unpersist()
    return trend_counts(found, as_of, f"{days} DAYS").orderBy(F.desc("usage_count"), "library_name").limit(limit)
