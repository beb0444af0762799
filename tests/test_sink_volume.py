"""What sinks and jobs keep, sort and shuffle on the way."""

from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from patchlens import schemas, sources
from patchlens.sources import sinks
from patchlens.streaming import run_stream
from patchlens.streaming.jobs import STATE_ON_DISK, hourly_snapshot, run_hourly
from patchlens.streaming.latest import latest_snapshot, run_latest

T0 = datetime(2024, 1, 1)


def test_names_are_not_sorted_for_their_day(spark, tmp_path, monkeypatch):
    spark.conf.set(sinks.WRITERS, "1")
    put, seen = sinks._put, []

    def spied(rows, *rest):
        seen.append(spark.conf.get(sinks.WRITERS))
        put(rows, *rest)

    monkeypatch.setattr(sinks, "_put", spied)
    days = sinks.OPEN_FILES + 9  # more than a task keeps open
    rows = [("o/r", "Python", [f"lib{d}", "flask"], T0 + timedelta(days=d)) for d in range(days)] * 2
    manifests = spark.createDataFrame(rows, "repo_name string, language string, libraries array<string>, detected_at timestamp")
    try:
        for batch in (0, 0, 1):
            sources.write_trends(manifests.coalesce(1), f"{tmp_path}/t", batch, "q", clustered=False)
        assert spark.conf.get(sinks.WRITERS) == "1"
    finally:
        spark.conf.unset(sinks.WRITERS)
    assert seen == [str(sinks.OPEN_FILES)] * 3
    stored = sources.trends(spark, f"{tmp_path}/t")
    assert stored.count() == 8 * days
    assert stored.filter("detected_date <> to_date(detected_at)").isEmpty()
    assert stored.filter("library_name <> 'flask'").groupBy("library_name").count().filter("count <> 4").isEmpty()


def test_an_open_file_holds_few_rows(spark, tmp_path):
    """Names that neither a dictionary nor zstd makes short: a file's rows go out by megabytes, whatever its size."""
    days = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 2 * 86_400)
    rows = spark.range(400_000).repartition(1).select(
        F.sha1(F.col("id").cast("string")).alias("library_name"), F.lit("Python").alias("language"),
        F.lit("o/r").alias("repo_name"), days.alias("detected_at"),
    )
    sources.write_trends(rows, f"{tmp_path}/t", 0, "q", clustered=False, gathered=False)
    files = [pq.ParquetFile(f).metadata for f in Path(tmp_path, "t").rglob("*.parquet")]
    assert len(files) == 2 and sum(f.num_rows for f in files) == 400_000
    for file in files:
        held = [sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in map(file.row_group, range(file.num_row_groups))]
        assert sum(held) > 3 << 20 and max(held) < 3 << 20


def test_a_lookup_keeps_no_names_by_push(spark, tmp_path, monkeypatch):
    frame = type(spark.range(1))
    kept, persist = [], frame.persist

    def spied(self, *level):
        kept.append((set(self.columns), self.count()))
        return persist(self, *level)

    monkeypatch.setattr(frame, "persist", spied)
    commits = spark.createDataFrame(
        [("o/r", "x", [("requirements.txt", "+flask\n+numpy")]), ("o/r", "y", [("requirements.txt", "+other")])], schemas.COMMIT
    )
    pushes = spark.createDataFrame([("o/r", "x", T0 + timedelta(hours=h)) for h in range(50)], "name string, head string, pushed_at timestamp")
    pushes.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(pushes.schema).parquet(f"{tmp_path}/in")
    run_stream(stream, commits, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sources.trends(spark, f"{tmp_path}/out/trends").count() == 100
    wide = [n for columns, n in kept if "libraries" in columns]
    assert wide == [1] and not any({"libraries", "detected_at"} <= columns for columns, _ in kept)


def test_state_partitions_stay_apart(spark, tmp_path, monkeypatch):
    """One file is not made by one task over all state partitions."""
    frame = type(spark.range(1))
    merged = []
    monkeypatch.setattr(frame, "coalesce", lambda self, n: merged.append(n) or self)
    rows = [(f"o/r{k % 9}", f"c{k}", 4.6 + k % 3, T0 + timedelta(minutes=17 * k)) for k in range(60)]
    leaks = spark.createDataFrame(rows, "repo_name string, commit_sha string, entropy_score double, detected_at timestamp")
    leaks.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(leaks.schema).parquet(f"{tmp_path}/in")
    run_hourly(stream, f"{tmp_path}/hours", f"{tmp_path}/cp1").awaitTermination()
    run_latest(stream, f"{tmp_path}/latest", f"{tmp_path}/cp2").awaitTermination()
    assert not merged
    assert hourly_snapshot(spark, f"{tmp_path}/hours").count() == 17
    found = {r.repo_name: r.commit_sha for r in latest_snapshot(spark, f"{tmp_path}/latest").collect()}
    assert found == {f"o/r{k % 9}": f"c{k}" for k in range(51, 60)}


def test_names_go_from_the_join_into_files(spark, tmp_path, monkeypatch):
    """The rows of a lookup with their names are shuffled by day only if a task cannot keep a file open for each day."""
    plans, put = {}, sinks._put

    def spied(rows, path, *rest):
        plans[path.removeprefix(f"{tmp_path}/")] = rows._jdf.queryExecution().analyzed().toString()
        put(rows, path, *rest)

    monkeypatch.setattr(sinks, "_put", spied)
    commits = spark.createDataFrame([("o/r", "x", [("requirements.txt", "+flask\n+numpy")])], schemas.COMMIT)
    for name, days in (("few", 3), ("many", sinks.OPEN_FILES + 1)):
        pushes = spark.createDataFrame([("o/r", "x", T0 + timedelta(days=d)) for d in range(days)] * 2, "name string, head string, pushed_at timestamp")
        pushes.write.parquet(f"{tmp_path}/{name}/in")
        stream = spark.readStream.schema(pushes.schema).parquet(f"{tmp_path}/{name}/in")
        run_stream(stream, commits, f"{tmp_path}/{name}", f"{tmp_path}/{name}/cp").awaitTermination()
        stored = sources.trends(spark, f"{tmp_path}/{name}/trends")
        assert stored.count() == 4 * days and stored.filter("detected_date <> to_date(detected_at)").isEmpty()
    assert "Repartition" not in plans["few/trends"] and "Rebalance" not in plans["few/trends"]
    assert "Rebalance" in plans["many/trends"]


def test_a_stream_join_keeps_its_state_on_disk(spark, tmp_path):
    pushes = spark.createDataFrame([("o/r", "x", T0), ("o/r", "gone", T0)], "name string, head string, pushed_at timestamp")
    commits = spark.createDataFrame(
        [("o/r", "x", [("requirements.txt", "+flask\n+numpy")], T0)],
        "repo_name string, sha string, files array<struct<filename: string, patch: string>>, committed_at timestamp",
    )
    pushes.write.parquet(f"{tmp_path}/p")
    commits.write.parquet(f"{tmp_path}/c")
    before = {name: spark.conf.get(name, None) for name in STATE_ON_DISK}
    query = run_stream(
        spark.readStream.schema(pushes.schema).parquet(f"{tmp_path}/p"),
        spark.readStream.schema(commits.schema).parquet(f"{tmp_path}/c"),
        f"{tmp_path}/out", f"{tmp_path}/cp",
    )
    query.awaitTermination()
    assert {name: spark.conf.get(name, None) for name in STATE_ON_DISK} == before
    joins = [o for p in query.recentProgress for o in p.stateOperators]
    assert joins and all(any(m.startswith("rocksdb") for m in o.customMetrics) for o in joins)
    assert sources.trends(spark, f"{tmp_path}/out/trends").count() == 2
