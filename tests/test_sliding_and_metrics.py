"""KPIs of sliding windows from parts in any order, and the counts of micro-batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patchlens.operators import flatten_push, observe_pushes
from patchlens.schemas import DETECTED_LEAKS, RAW_EVENT
from patchlens.streaming import BatchMetrics, batch_metrics, compact_hours, run_append, run_sliding, sliding_kpis, stored_parts

T0 = datetime(2024, 1, 1)


def finish(query):
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive


def made(n=300, seed=3):
    rng = random.Random(seed)
    at = lambda: T0 + timedelta(minutes=rng.choice([rng.randrange(400), 4000 + rng.randrange(4000)]))
    rows = [(rng.choice(["a/b", "c/d", None]), f"s{rng.randrange(12)}", rng.choice([None, 3.5, 4.0, 5.0]), at()) for _ in range(n)]
    # A commit seen exactly one window later, and one seen again while it is still in the window.
    edge = T0 + timedelta(hours=200)
    return rows + [("x/y", "edge", 4.75, edge + timedelta(hours=h, minutes=m)) for h, m in ((0, 0), (5, 59), (6, 0), (11, 0), (17, 30))]


def expected(rows, hours):
    whole = [r[3].replace(minute=0, second=0) for r in rows]
    out, hr = [], min(whole)
    while hr <= max(whole):
        held = [r for r, h in zip(rows, whole) if hr - timedelta(hours=hours) < h <= hr]
        scores = [r[2] for r in held if r[2] is not None]
        if held:
            out.append((
                hr, len({r[1] for r in held}), round(sum(scores) / len(scores), 9) if scores else None,
                sum(s > 4.5 for s in scores), len({r[0] for r in held} - {None}),
            ))
        hr += timedelta(hours=1)
    return out


def shown(kpis):
    return [
        (r.hr, r.total_leaks, None if r.avg_risk is None else round(r.avg_risk, 9), r.critical_count, r.affected_repos)
        for r in kpis.orderBy("hr").collect()
    ]


def test_sliding_windows_equal_brute_force_over_batches_out_of_order(spark, tmp_path):
    out, checkpoint, rows = f"{tmp_path}/out", f"{tmp_path}/checkpoint", made()
    shuffled = random.Random(4).sample(rows, len(rows))

    def run(part):
        spark.createDataFrame(part, DETECTED_LEAKS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        finish(run_sliding(spark.readStream.schema(DETECTED_LEAKS).parquet(f"{tmp_path}/in"), out, checkpoint))
        return stored_parts(spark, out)

    assert shown(sliding_kpis(stored_parts(spark, out))) == [] and compact_hours(spark, out) is None
    run(shuffled[:100] + [("a/b", "none", 4.0, None)])
    run(shuffled[100:200])
    before = shown(sliding_kpis(stored_parts(spark, out), 6))
    assert before == expected(shuffled[:200], 6)
    assert compact_hours(spark, out) == 1
    assert shown(sliding_kpis(stored_parts(spark, out), 6)) == before
    parts = run(shuffled[200:])
    for hours in (1, 6, 24):
        assert shown(sliding_kpis(parts, hours)) == expected(rows, hours)
    # A compaction that did not end counts for nothing: the batches are still read.
    assert compact_hours(spark, out) == 2
    (tmp_path / "out" / "compacted" / "upto=2" / "_SUCCESS").unlink()
    assert shown(sliding_kpis(stored_parts(spark, out))) == expected(rows, 24)
    assert compact_hours(spark, out) == 2 and compact_hours(spark, out) is None
    assert shown(sliding_kpis(stored_parts(spark, out))) == expected(rows, 24)


def test_a_day_is_read_from_its_own_folders(spark, tmp_path):
    spark.createDataFrame(made(), DETECTED_LEAKS).write.parquet(f"{tmp_path}/in")
    leaks = spark.readStream.schema(DETECTED_LEAKS).parquet(f"{tmp_path}/in")
    finish(run_sliding(leaks, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    compact_hours(spark, f"{tmp_path}/out")
    one = stored_parts(spark, f"{tmp_path}/out").filter(F.col("detected_date") == "2024-01-01")
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(detected_date" in plan
    assert {r.hr.date() for r in one.collect()} == {T0.date()}


def events(spark, ids):
    rows = [
        (i, "PushEvent" if i % 3 else "WatchEvent", (1, "a/b" if i % 4 else ""), ("h",), T0) for i in ids
    ]
    return spark.createDataFrame(rows, RAW_EVENT)


def test_counts_of_each_batch_are_stored_over_a_restart(spark, tmp_path):
    read = lambda: spark.readStream.schema(RAW_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def run():
        with BatchMetrics(spark, f"{tmp_path}/metrics") as metrics:
            query = run_append(flatten_push(observe_pushes(read())), f"{tmp_path}/rows", f"{tmp_path}/checkpoint")
            finish(query)
            metrics.wait(query)
        return batch_metrics(spark, f"{tmp_path}/metrics")

    for ids in (range(5), range(5, 20)):
        events(spark, ids).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    first = run()
    assert sorted(r.batch_id for r in first.select("batch_id").distinct().collect()) == [0, 1]
    events(spark, range(20, 30)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    totals = {r.metric: r.value for r in run().groupBy("metric").agg(F.sum("value").alias("value")).collect()}
    assert totals == {
        "total_events": 30,
        "push_events": sum(i % 3 > 0 for i in range(30)),
        "signals": sum(i % 3 > 0 and i % 4 > 0 for i in range(30)),
    }
    rows = batch_metrics(spark, f"{tmp_path}/metrics")
    assert rows.count() == 9 and rows.filter("metric = 'total_events' AND value = rows_read").count() == 3


def test_a_batch_that_is_not_reported_is_told(spark, tmp_path):
    class Query:
        id, lastProgress = "none", {"batchId": 0}

    with pytest.raises(TimeoutError):
        BatchMetrics(spark, str(tmp_path)).wait(Query(), seconds=0.2)
