"""Pages as a source, rows set aside, and state by repository."""

import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patchlens import sources
from patchlens.schemas import DETECTED_LEAKS
from patchlens.sources.pages import PageReader, read_feed_pages
from patchlens.streaming import dedupe_stream, latest_snapshot, run_append, run_facts, run_latest

T0 = datetime(2024, 1, 1)


def finish(query):
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive


def page(folder, number, tag, events):
    at = folder / f"page={number}" / f"etag={tag}"
    at.mkdir(parents=True)
    (at / "body.json").write_text(json.dumps(events))


def event(i, kind="PushEvent"):
    return {"id": str(i), "type": kind, "repo": {"id": 1, "name": "a/b"}, "payload": {"head": f"h{i}"}, "created_at": f"2024-01-01T00:00:{i:02d}Z"}


def test_pages_are_read_once_and_unchanged_ones_never(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "pages", f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def run():
        events = sources.feed_events(read_feed_pages(spark, str(folder)), "page")
        finish(run_append(dedupe_stream(events), out, checkpoint))
        return sorted(((r.event_id, r.page) for r in spark.read.schema("event_id long, page long").parquet(out).collect()), key=str)

    page(folder, 1, "x", [event(1), event(2)])
    page(folder, 2, "x", [event(9)])  # says it is page 1 again, so its text is not looked at
    page(folder, 10, "y", [event(2), event(3), {"type": "none"}])
    (folder / "page=10" / "etag=y" / "bad.json").write_text("oops")
    first = sorted(run(), key=str)
    assert [p for p in first if p[0] and p[0] != 2] == [(1, 1), (3, 10)]
    assert sorted(e for e, _ in first if e) == [1, 2, 3]
    assert run() == first  # a restart reads nothing again
    (folder / "page=10" / "etag=y" / "body.json").unlink()  # not even if it could
    page(folder, 11, "y", [event(8)])
    page(folder, 12, "z", [event(3), event(4)])
    assert sorted(e for e, _ in run() if e) == [1, 2, 3, 4]


def test_offsets_and_parts(tmp_path):
    reader = PageReader(str(tmp_path / "none"))
    assert reader.latestOffset() == reader.initialOffset() == {"page": -1}
    reader = PageReader(str(tmp_path))
    for n in range(70):
        page(tmp_path, n, n // 2, [event(1)])
    assert reader.latestOffset() == {"page": 69}
    parts = reader.partitions({"page": -1}, {"page": 69})
    assert [len(p.pages) for p in parts] == [32, 3] and [n for p in parts for n, _, _ in p.pages] == list(range(0, 70, 2))
    # Page 4 opens a pair, page 5 repeats it: whether it is read does not depend on where a batch begins.
    assert [n for p in reader.partitions({"page": 4}, {"page": 7}) for n, _, _ in p.pages] == [6]
    assert reader.partitions({"page": 69}, {"page": 69}) == []
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 35


def test_bad_rows_are_set_aside_and_can_be_mended(spark, tmp_path):
    inbox, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    rows = [("a", "c1", 5.0, T0), ("b", None, 6.5, T0 + timedelta(microseconds=7)), (None, None, None, None), (None, "c2", 5.0, T0)]
    loose = "repo_name string, commit_sha string, entropy_score double, detected_at timestamp"
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, loose).coalesce(1).write.mode("append").parquet(inbox)
    stream = lambda: sources.read_push_stream(spark, "parquet", loose, inbox, maxFilesPerTrigger="1")
    finish(run_facts(stream(), "leaks", out, checkpoint))
    finish(run_facts(stream(), "leaks", out, checkpoint))
    assert sorted(r.commit_sha for r in sources.leaks(spark, f"{out}/leaks").collect()) == ["c1", "c2"]
    aside = f"{out}/rejects/leaks"
    assert [tuple(r) for r in sources.reject_counts(spark, aside).collect()] == [("commit_sha", 2)]
    mended = sources.rejected_rows(spark, aside, loose).filter("repo_name = 'b'")
    assert [tuple(r) for r in mended.collect()] == [("b", None, 6.5, rows[1][3], ["commit_sha"])]
    # A batch that is tried again leaves its rows, good and bad, once.
    stored = sources.leaks(spark, f"{out}/leaks").first()
    again = spark.createDataFrame(rows[:2] if stored.batch_id == 0 else rows[2:], loose)
    sources.write_leaks(again, f"{out}/leaks", stored.batch_id, stored.stream_id, rejects=aside)
    assert sources.leaks(spark, f"{out}/leaks").count() == 2 and sources.rejects(spark, aside).count() == 2
    # Trends and reports have the same way out.
    trends = spark.createDataFrame([("flask", "Python", "a"), (None, "Python", "b")], "library_name string, language string, repo_name string")
    sources.write_trends(trends, f"{out}/trends", 0, rejects=f"{out}/rejects/trends")
    assert sources.trends(spark, f"{out}/trends").count() == 1
    vibes = spark.createDataFrame([(None, "s", ["x"]), ("[A] t", "s", ["x"])], "theme_name string, summary string, top_libraries array<string>")
    sources.write_vibes(vibes, f"{out}/vibes", 0, required=("theme_name",), rejects=f"{out}/rejects/vibes")
    assert sources.vibes(spark, f"{out}/vibes").count() == 1
    assert [r.violation for r in sources.reject_counts(spark, f"{out}/rejects/vibes").collect()] == ["theme_name"]


def test_a_day_is_read_from_its_own_folders(spark, tmp_path):
    path = f"{tmp_path}/leaks"
    rows = [("a", f"c{i}", 5.0, T0 + timedelta(days=i % 3)) for i in range(9)]
    for batch in range(3):
        sources.write_leaks(spark.createDataFrame(rows[batch::2], DETECTED_LEAKS), path, batch, "q")
    day = sources.leaks(spark, path, days=[T0.date()])
    files = [r[0] for r in day.select(F.input_file_name()).distinct().collect()]
    assert day.count() == sources.leaks(spark, path).filter("detected_date = '2024-01-01'").count() > 0
    assert files and all("/leaks/detected_date=2024-01-01/stream_id=q/batch_id=" in f for f in files)


def test_the_latest_leak_survives_disorder_and_restarts(spark, tmp_path):
    inbox, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    rng = random.Random(1)
    rows = [(f"r{rng.randrange(9)}" if i % 3 else "busy", f"c{rng.randrange(50)}", float(rng.randrange(4, 8)), T0 + timedelta(minutes=rng.randrange(90))) for i in range(300)]
    loose = DETECTED_LEAKS.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    for k in range(4):
        part = rows[k::4] + [(None, "c", 9.0, T0 + timedelta(days=9)), ("busy", None, 9.0, T0 + timedelta(days=9)), ("none", "c", 9.0, None)]
        spark.createDataFrame(part, loose).coalesce(1).write.mode("append").parquet(inbox)
        if k % 2:
            leaks = sources.read_push_stream(spark, "parquet", loose, inbox, maxFilesPerTrigger="1")
            finish(run_latest(leaks, out, checkpoint))
    want = {}
    for repo, sha, score, at in rows:
        want[repo] = max(want.get(repo, (T0 - timedelta(days=1), "", 0.0)), (at, sha, score))
    got = {r.repo_name: (r.detected_at, r.commit_sha, r.entropy_score) for r in latest_snapshot(spark, out).collect()}
    assert got == want
    assert spark.read.parquet(out).count() < len(rows)  # changes only
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "HDFS").find("RocksDB") < 0


def test_state_can_expire(spark, tmp_path):
    inbox, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([("a", "c1", 5.0, T0)], DETECTED_LEAKS).write.parquet(inbox)
    leaks = sources.read_push_stream(spark, "parquet", DETECTED_LEAKS, inbox)
    with pytest.raises(ValueError, match="trigger"):
        run_latest(leaks, out, f"{tmp_path}/none", keep="90 days")
    query = run_latest(leaks, out, f"{tmp_path}/checkpoint", trigger="1 second", keep="90 days")
    try:
        waited = time.time()
        while not query.recentProgress and query.isActive and time.time() < waited + 120:
            time.sleep(0.5)
    finally:
        query.stop()
    assert [r.commit_sha for r in latest_snapshot(spark, out).collect()] == ["c1"]
