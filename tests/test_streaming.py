"""Streams: equal to the batch result, safe to restart and to replay."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patchlens import sources
from patchlens.operators import commits as commit_ops
from patchlens.operators import dedupe_pushes, detect_leaks, enrich, parse_messages
from patchlens.operators.dependencies import trend_rows, with_libraries
from patchlens.schemas import COMMIT, DETECTED_LEAKS
from patchlens.streaming import (
    dedupe_stream,
    hourly_snapshot,
    jobs,
    run_hourly,
    run_append,
    run_stream,
)

T0 = datetime(2024, 1, 1)
SECRET = "".join(chr(c) for c in range(0x30, 0x7B))


@pytest.fixture
def commits(spark):
    rows = [
        ("a/b", "s1", [("src/x.py", SECRET), ("requirements.txt", "+flask\n+pip")]),
        ("c/d", "s2", [("package.json", '+ "react": "1"'), ("blank", "  ")]),
    ]
    return spark.createDataFrame(rows, COMMIT)


def put(spark, folder, rows):
    schema = "name string, head string, pushed_at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, schema="name string, head string, pushed_at timestamp"):
    return sources.read_push_stream(spark, "parquet", schema, str(folder), maxFilesPerTrigger="1")


def finish(query):
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive


def batch_result(push, commits, threshold):
    push = push.withColumnRenamed("pushed_at", "detected_at")
    files = commit_ops.explode_files(commits)
    manifests = with_libraries(files).filter("language IS NOT NULL")
    found = manifests.select("repo_name", "commit_sha", "language", "libraries")
    return enrich(push, detect_leaks(files, threshold)), trend_rows(enrich(push, found), "detected_at")


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


LEAK = "repo_name", "commit_sha", "entropy_score", "detected_at"
TREND = "library_name", "language", "repo_name", "detected_at"


@pytest.mark.parametrize("stored", [False, True])
def test_stream_equals_batch_over_restarts(spark, commits, tmp_path, stored):
    known = commits
    if stored:
        sources.write_findings(jobs.commit_findings(commits), f"{tmp_path}/findings")
        known = sources.read_findings(spark, f"{tmp_path}/findings")
    inbox, out, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    first = [("a/b", "s1", T0), ("a/b", "s1", T0), ("c/d", "s2", T0), ("gone", "s9", T0), (None, None, None)]
    put(spark, inbox, first)
    put(spark, inbox, [("a/b", "s1", T0 + timedelta(days=1))])

    def run():
        finish(run_stream(stream(spark, inbox), known, out, checkpoint))

    def check():
        leaks, trends = batch_result(spark.read.parquet(str(inbox)), commits, 4.5)
        assert bag(sources.leaks(spark, f"{out}/leaks"), *LEAK) == bag(leaks, *LEAK)
        assert bag(sources.trends(spark, f"{out}/trends"), *TREND) == bag(trends, *TREND)

    run()
    check()
    assert sources.leaks(spark, f"{out}/leaks").count() == 3
    run()  # nothing new
    check()
    put(spark, inbox, [("c/d", "s2", T0 + timedelta(days=2))])
    run()
    check()
    ids = sources.trends(spark, f"{out}/trends").select("stream_id").distinct().count()
    assert ids == 1


def test_a_new_checkpoint_does_not_overwrite_the_old_output(spark, commits, tmp_path):
    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    put(spark, inbox, [("a/b", "s1", T0)])
    for run in ("one", "two"):
        finish(run_stream(stream(spark, inbox), commits, out, f"{tmp_path}/{run}"))
    assert sources.leaks(spark, f"{out}/leaks").count() == 2


def test_stored_findings_are_joined_without_their_texts(spark, tmp_path):
    hashes = [f"{i:03x}0" for i in range(20)]
    rows = [("a/b", h, [("requirements.txt", f"+lib{h}")]) for h in hashes]
    sources.write_findings(jobs.commit_findings(spark.createDataFrame(rows, COMMIT)), f"{tmp_path}/findings")
    findings = sources.read_findings(spark, f"{tmp_path}/findings")
    schema = "name string, head string, pushed_at timestamp"
    push = spark.createDataFrame([("a/b", hashes[3], T0), ("a/b", "fff", T0)], schema)
    found = jobs._pushed_findings(push, findings)
    assert [r.commit_sha for r in found.collect()] == [hashes[3]]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "patch" not in text and "sha_prefix" in text
    assert jobs._pushed_findings(push.limit(0), findings).count() == 0

    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    put(spark, inbox, [("a/b", hashes[3], T0), ("a/b", hashes[4], T0), ("x/y", hashes[5], T0)])
    finish(run_stream(stream(spark, inbox), findings, out, f"{tmp_path}/checkpoint"))
    found = bag(sources.trends(spark, f"{out}/trends"), "library_name")
    assert found == [(f"lib{hashes[3]}",), (f"lib{hashes[4]}",)]


def test_events_without_a_key_stay(spark, tmp_path):
    page = [{"id": "7", "type": "PushEvent"}, {"id": "7", "type": "PushEvent"}, {"type": "A"}, {"type": "A"}, {"id": "x", "type": "B"}]
    import json

    (tmp_path / "page.json").write_text(json.dumps(page))
    read = sources.read_events(spark, str(tmp_path), multiLine="true")
    assert bag(dedupe_pushes(read).fillna(0), "event_id", "type") == [(0, "A"), (0, "A"), (0, "B"), (7, "PushEvent")]


def test_pushes_without_a_time_meet_the_stream_of_commits(spark, tmp_path):
    arrived, inbox, out = tmp_path / "commits", tmp_path / "in", f"{tmp_path}/out"
    fields = "repo_name string, sha string, files array<struct<filename: string, patch: string>>, committed_at timestamp"
    now = datetime.now()
    spark.createDataFrame([("a/b", "s1", [("src/x.py", SECRET)], now)], fields).write.parquet(str(arrived))
    put(spark, inbox, [("a/b", "s1", None), ("a/b", "s1", now)])
    finish(run_stream(stream(spark, inbox), stream(spark, arrived, fields), out, f"{tmp_path}/checkpoint"))
    assert sources.leaks(spark, f"{out}/leaks").count() == 2


def test_each_batch_sees_the_commits_of_its_time(spark, commits, tmp_path):
    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    put(spark, inbox, [("a/b", "s1", T0)])
    put(spark, inbox, [("a/b", "s1", T0)])
    seen = []

    def table():
        seen.append(1)
        return commits.limit(0) if len(seen) == 1 else commits

    finish(run_stream(stream(spark, inbox), table, out, f"{tmp_path}/checkpoint"))
    assert len(seen) == 2
    assert [r.batch_id for r in sources.leaks(spark, f"{out}/leaks").collect()] == [1]


def test_stream_of_commits(spark, tmp_path):
    arrived, inbox, out = tmp_path / "commits", tmp_path / "in", f"{tmp_path}/out"
    rows = [
        ("a/b", "s1", [("src/x.py", SECRET), ("requirements.txt", "+flask")], T0 + timedelta(minutes=5)),
        ("c/d", "s2", [("package.json", '+ "react": "1"')], T0 + timedelta(hours=5)),
    ]
    fields = "repo_name string, sha string, files array<struct<filename: string, patch: string>>, committed_at timestamp"
    spark.createDataFrame(rows, fields).write.parquet(str(arrived))
    put(spark, inbox, [("a/b", "s1", T0), ("a/b", "s1", T0), ("c/d", "s2", T0)])
    commits = stream(spark, arrived, fields)
    finish(run_stream(stream(spark, inbox), commits, out, f"{tmp_path}/checkpoint"))
    assert bag(sources.leaks(spark, f"{out}/leaks"), "repo_name", "detected_at") == [("a/b", T0)] * 2
    # The other commit came five hours after its push, outside the delay.
    assert bag(sources.trends(spark, f"{out}/trends"), "library_name") == [("flask",)] * 2


def test_parsed_messages_are_stored(spark, tmp_path):
    inbox = tmp_path / "in"
    rows = [('{"name":"a/b","head":"x"}',), ("garbage",)]
    spark.createDataFrame(rows, "value string").write.parquet(str(inbox))
    messages = parse_messages(stream(spark, inbox, "value string"))
    finish(run_append(messages, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert bag(stored.fillna(""), "name", "head") == [("", ""), ("a/b", "x")]


def test_redelivered_pages_are_dropped_across_batches(spark, tmp_path):
    inbox = tmp_path / "in"
    page = spark.createDataFrame([(i, T0) for i in range(5)], "event_id long, created_at timestamp")
    for _ in range(3):
        page.coalesce(1).write.mode("append").parquet(str(inbox))
    events = stream(spark, inbox, page.schema)
    finish(run_append(dedupe_stream(events), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_hours_follow_the_stream(spark, tmp_path):
    inbox, out = tmp_path / "in", f"{tmp_path}/out"

    def add(*rows):
        leaks = [("a/b", "c", score, T0 + timedelta(minutes=m)) for score, m in rows]
        spark.createDataFrame(leaks, DETECTED_LEAKS).coalesce(1).write.mode("append").parquet(str(inbox))
        leaks = stream(spark, inbox, DETECTED_LEAKS)
        finish(run_hourly(leaks, out, f"{tmp_path}/checkpoint"))
        rows = hourly_snapshot(spark, out).orderBy("hr").collect()
        return [(r.hr.hour, r.avg_entropy, r.max_entropy) for r in rows]

    assert add((4.0, 1), (5.0, 2)) == [(0, 4.5, 5.0)]
    assert add((6.0, 3), (5.0, 61)) == [(0, 5.0, 6.0), (1, 5.0, 5.0)]
    assert add((4.0, 299)) == [(0, 5.0, 6.0), (1, 5.0, 5.0), (4, 4.0, 4.0)]
    # Too late: the watermark is an hour behind the newest leak.
    assert add((9.0, 4)) == [(0, 5.0, 6.0), (1, 5.0, 5.0), (4, 4.0, 4.0)]


def test_a_failed_batch_leaves_its_rows_once(spark, commits, tmp_path, monkeypatch):
    inbox, out, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    put(spark, inbox, [("a/b", "s1", T0)])
    real = jobs.write_leaks

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "write_leaks", fail)
    broken = run_stream(stream(spark, inbox), commits, out, checkpoint)
    with pytest.raises(Exception, match="lost"):
        broken.awaitTermination(300)
    assert sources.trends(spark, f"{out}/trends").count() == 1  # the first sink had written
    monkeypatch.setattr(jobs, "write_leaks", real)
    finish(run_stream(stream(spark, inbox), commits, out, checkpoint))
    assert sources.trends(spark, f"{out}/trends").count() == 1
    assert sources.leaks(spark, f"{out}/leaks").agg(F.count("*")).first()[0] == 1
