"""Sinks, layouts and scans."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from patchlens import sources
from patchlens.operators import since
from patchlens.schemas import DETECTED_LEAKS, TECH_TRENDS, WEEKLY_VIBES


@pytest.fixture
def leaks(spark):
    rows = [
        ("a/b", f"c{i}", 4.0 + i / 10, datetime(2024, 1, 1 + i % 3, 6)) for i in range(30)
    ]
    return spark.createDataFrame(rows, DETECTED_LEAKS)


def test_appended_leaks_come_back(spark, leaks, tmp_path):
    path = f"{tmp_path}/leaks"
    sources.write_leaks(leaks, path)
    sources.write_leaks(leaks, path)
    back = sources.leaks(spark, path, streamed=False)
    assert back.count() == 60
    assert sorted(p.name for p in (tmp_path / "leaks").glob("detected_date=*")) == [
        "detected_date=2024-01-01", "detected_date=2024-01-02", "detected_date=2024-01-03",
    ]


def test_a_batch_written_again_replaces_itself(spark, leaks, tmp_path):
    path = f"{tmp_path}/leaks"
    sources.write_leaks(leaks, path, batch_id=0, stream_id="q")
    sources.write_leaks(leaks.limit(3), path, batch_id=1, stream_id="q")
    sources.write_leaks(leaks, path, batch_id=0, stream_id="q")
    sources.write_leaks(leaks, path, batch_id=0, stream_id="other")
    back = sources.leaks(spark, path)
    assert back.filter("stream_id = 'q'").count() == 33
    assert back.count() == 63


def test_a_time_bound_prunes_days(spark, leaks, tmp_path):
    path = f"{tmp_path}/leaks"
    sources.write_leaks(leaks, path, batch_id=0, stream_id="q")
    recent = since(sources.leaks(spark, path), "24 HOURS", datetime(2024, 1, 3, 6))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(detected_date" in plan
    assert "PushedFilters: [IsNotNull(detected_at), GreaterThan(detected_at" in plan
    assert recent.count() == 10


def test_defaults(spark, tmp_path):
    bare = spark.createDataFrame([("flask", "Python", "a/b")], "library_name string, language string, repo_name string")
    sources.write_trends(bare, f"{tmp_path}/trends")
    row = sources.trends(spark, f"{tmp_path}/trends", streamed=False).first()
    assert row.detected_at is not None and row.detected_date == row.detected_at.date()
    vibe = spark.createDataFrame([("[A] t", "s", ["x"])], "theme_name string, summary string, top_libraries array<string>")
    sources.write_vibes(vibe, f"{tmp_path}/vibes")
    stored = sources.vibes(spark, f"{tmp_path}/vibes").withColumn("today", F.current_date()).first()
    assert stored.vibe_date == stored.today and stored.top_libraries == ["x"]


def test_given_report_dates_are_kept(spark, tmp_path):
    rows = spark.createDataFrame([(date(2024, 1, 2), "[A] t", "s", ["x"])], WEEKLY_VIBES)
    sources.write_vibes(rows, f"{tmp_path}/vibes")
    sources.write_vibes(rows, f"{tmp_path}/vibes")
    assert [r.vibe_date for r in sources.vibes(spark, f"{tmp_path}/vibes").collect()] == [date(2024, 1, 2)] * 2


def test_required_columns(spark, tmp_path):
    bad = spark.createDataFrame([("a/b", None, 4.0)], "repo_name string, commit_sha string, entropy_score double")
    with pytest.raises(PySparkException, match="NULL in required column commit_sha"):
        sources.write_leaks(bad, f"{tmp_path}/leaks")


def test_empty_writes_add_nothing(spark, leaks, tmp_path):
    path = f"{tmp_path}/leaks"
    sources.write_leaks(leaks, path, batch_id=0)
    sources.write_leaks(leaks.limit(0), path, batch_id=1)
    assert sources.leaks(spark, path).count() == 30


def test_recluster_replaces_days_and_splits_a_hot_value(spark, tmp_path):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("lib"), F.col("id") % 500)).alias("library_name"),
        F.lit("Python").alias("language"),
        F.concat(F.lit("r"), F.col("id")).alias("repo_name"),
        F.lit(datetime(2024, 1, 1)).alias("detected_at"),
        F.lit(date(2024, 1, 1)).alias("detected_date"),
    )
    path = f"{tmp_path}/trends"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sources.recluster(hot, path, ("library_name", "language"))
        sources.recluster(hot, path, ("library_name", "language"))
        sources.recluster(hot.limit(5).withColumn("detected_date", F.lit(date(2024, 1, 2))), path, ("library_name", "language"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = sources.trends(spark, path, streamed=False)
    assert back.count() == 20_005
    holding = back.filter("library_name = 'hot' AND detected_date = '2024-01-01'").select(F.input_file_name()).distinct().count()
    every = back.filter("detected_date = '2024-01-01'").select(F.input_file_name()).distinct().count()
    assert 1 < holding < every


def test_views(spark, leaks):
    trends = spark.createDataFrame([("flask", "Python", "a/b", datetime(2024, 1, 1))], TECH_TRENDS)
    vibes = spark.createDataFrame([(date(2024, 1, 2), "[A] t", "s", ["x"])], WEEKLY_VIBES)
    sources.register_views(leaks, trends, vibes)
    assert spark.sql("SELECT masked_sha FROM v_public_security_stream").first()[0].endswith("*" * 16)
    assert spark.sql("SELECT count(*) FROM detected_leaks").first()[0] == 30
    assert spark.sql("SELECT count(*) FROM tech_trends, weekly_vibes").first()[0] == 1


def test_event_and_commit_files(spark, tmp_path):
    (tmp_path / "events.json").write_text(
        '{"event_id": 1, "type": "PushEvent", "repo": {"id": 7, "name": "a/b"}, '
        '"payload": {"head": "x", "size": 1}, "created_at": "2024-01-01T00:00:00Z"}\n'
        '{"event_id": 2, "type": "WatchEvent"}\n'
    )
    events = sources.read_events(spark, f"{tmp_path}/events.json").orderBy("event_id").collect()
    assert events[0].repo.name == "a/b" and events[0].created_at == datetime(2024, 1, 1)
    assert events[1].payload is None
    (tmp_path / "commits.json").write_text(
        '{"repo_name": "a/b", "sha": "x", "files": [{"filename": "f", "patch": "+p"}, {"filename": "g"}]}\n'
    )
    commit = sources.read_commits(spark, f"{tmp_path}/commits.json", "json").first()
    assert [f.patch for f in commit.files] == ["+p", None]


def test_messages_to_a_sink(spark, tmp_path):
    rows = spark.createDataFrame([("7", "{}")], "key string, value string")
    sources.write_messages(rows, "json", path=f"{tmp_path}/queue")
    assert spark.read.json(f"{tmp_path}/queue").count() == 1


def test_kafka_options():
    options = sources.kafka_options("host:9092", "pushes", "me", 'se"cret')
    assert options["subscribe"] == "pushes" and options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.jaas.config"].endswith('username="me" password="se\\"cret";')


def test_one_day_from_one_task_is_written_by_several(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 1).select(
        F.concat(F.lit("r"), F.col("id")).alias("repo_name"),
        F.sha1(F.col("id").cast("string").cast("binary")).alias("commit_sha"),
        F.lit(4.6).alias("entropy_score"),
        F.lit(datetime(2024, 1, 1)).alias("detected_at"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "500k")
    try:
        sources.write_leaks(rows, f"{tmp_path}/cut", batch_id=0)
    finally:
        spark.conf.unset(size)
    cut = len(list((tmp_path / "cut").rglob("part-*.parquet")))
    assert cut > 1
    assert sources.leaks(spark, f"{tmp_path}/cut").count() == 200_000
