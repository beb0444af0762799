"""Operators on literal rows."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from patchlens import operators as ops
from patchlens.schemas import COMMIT, RAW_EVENT

NOON = datetime(2024, 1, 2, 12)


def raw(event_id, kind="PushEvent", name="a/b", head="x", repo_id=7, at=NOON):
    return (event_id, kind, (repo_id, name), (head,), at)


@pytest.fixture
def events(spark):
    rows = [
        raw(1),
        raw(2, kind="WatchEvent"),
        raw(3, name=""),
        raw(4, head=None),
        raw(5, head=""),
        raw(6, name="c/d", head="y"),
    ]
    return spark.createDataFrame(rows, RAW_EVENT)


def patches(spark, *rows):
    return spark.createDataFrame(
        [("a/b", "x", name, patch) for name, patch in rows],
        "repo_name string, commit_sha string, filename string, patch string",
    )


def names(df):
    return [r.library_name for r in df.collect()]


def test_pushes_without_name_or_head_are_no_signals(events):
    assert [r.name for r in ops.flatten_push(events).collect()] == ["a/b", "c/d"]
    summary = ops.push_batch_summary(events).first()
    assert (summary.total_events, summary.push_events, summary.signals) == (6, 5, 2)


def test_counts_in_passing(events):
    seen = Observation()
    assert ops.observe_pushes(events, seen).count() == 6
    assert seen.get == {"total_events": 6, "push_events": 5, "signals": 2}


def test_both_message_shapes_come_back(events):
    flat = ops.to_messages(events, "flat", key=None)
    assert {r.key for r in flat.collect()} == {None}
    whole = ops.to_messages(events.filter("event_id IN (1, 6)"))
    assert {r.key for r in whole.collect()} == {"7"}
    for messages in (flat, whole):
        parsed = ops.parse_messages(messages).orderBy("name").collect()
        assert [tuple(r) for r in parsed] == [("a/b", "x", NOON), ("c/d", "y", NOON)]
    with pytest.raises(ValueError):
        ops.to_messages(events, "other")


def test_messages_as_bytes_and_garbage(spark):
    rows = spark.createDataFrame(
        [(b'{"name":"a/b","head":"x"}',), (b"garbage",), (b"[1]",), (b"",), (None,)], "value binary"
    )
    parsed = [(r.name, r.head) for r in ops.parse_messages(rows).collect()]
    assert parsed == [("a/b", "x")] + [(None, None)] * 4


@pytest.mark.parametrize(
    "message",
    [
        '{"name":"a/b","head":"x","pushed_at":"nonsense"}',
        '{"name":"a/b","head":"x","pushed_at":{"at":1}}',
        '{"name":"a/b","head":"x","repo":"text","payload":[1]}',
        '{"repo":{"id":7,"name":"a/b","url":"u"},"payload":{"head":"x","size":[1]},"actor":{}}',
    ],
)
def test_a_bad_field_does_not_lose_the_message(spark, message):
    row = ops.parse_messages(spark.createDataFrame([(message,)], "value string")).first()
    assert (row.name, row.head, row.pushed_at) == ("a/b", "x", None)


def test_dedupe(events):
    assert ops.dedupe_pushes(events.unionByName(events)).count() == 6


def test_files_of_a_commit(spark):
    files = [("A.py", "+x"), (None, "+y"), ("b", ""), ("c", None)]
    commits = spark.createDataFrame(
        [("a/b", "x", files), ("c/d", "y", None), ("e/f", "z", [])], COMMIT
    )
    rows = [tuple(r) for r in ops.explode_files(commits).collect()]
    assert rows == [("a/b", "x", "a.py", "+x"), ("a/b", "x", "", "+y")]


def test_lookup_keeps_every_push_and_reports_the_unknown(spark):
    push = spark.createDataFrame(
        [("a/b", "x", NOON), ("a/b", "x", NOON), ("a/b", "gone", NOON), ("other", "x", NOON)],
        "name string, head string, pushed_at timestamp",
    )
    commits = spark.createDataFrame([("a/b", "x", [])], COMMIT)
    assert ops.enrich(push, commits).count() == 2
    missing = ops.commit_missing(push, commits)
    assert {(r.name, r.head) for r in missing.collect()} == {("a/b", "gone"), ("other", "x")}


def test_python_dependencies(spark):
    patch = "+requests==2\n+-e .\n+zope.interface\n+ flask\n-old\n+pip==1\n+Django\n+Django\n+WHEEL"
    found = ops.py_deps(patches(spark, ("requirements.txt", patch)))
    assert names(found) == ["requests", "-e", "zope", "django", "django"]


def test_only_newlines_start_a_line(spark):
    patch = "ctx\r+cr +ls\u0085+nel\x0b+vt"
    assert names(ops.py_deps(patches(spark, ("requirements.txt", patch)))) == []


def test_javascript_dependencies(spark):
    patch = '+\n   "ctx": 2\n-  "gone": 3\n+  "React": "1",\n+ "wide":1\n+"pip": 1\n "same": 1'
    found = ops.js_deps(patches(spark, ("package.json", patch)))
    assert names(found) == ["ctx", "react", "wide", "pip"]


def test_one_pass_is_the_union_of_both_languages(spark):
    files = patches(
        spark,
        ("requirements.txt", "+a\n+b"),
        ("x/package.json", '+"c": 1'),
        ("requirements.txt/package.json", '+"d": 1\n+e'),
        ("readme.md", "+f"),
    )
    both = ops.py_deps(files).unionByName(ops.js_deps(files))
    once = ops.extract_trends(files)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, both.collect()))
    assert names(once) == ["a", "b", "c", "e"]


def test_leak_threshold_is_strict_and_short_texts_lose_nothing(spark):
    four_bits = "0123456789abcdef"
    files = patches(spark, ("a", four_bits), ("b", four_bits + "g"), ("c", "ab"), ("d", "  \n"))
    assert ops.detect_leaks(files, 4.0).count() == 1
    assert ops.detect_leaks(files, 3.999).count() == 2
    assert ops.detect_leaks(files, 0.5).count() == 3


def test_tokens(spark):
    secret = "AKz9Qw8Er7Ty6Ui5Op4As3Df2Gh1Jk0LxCvBnM"
    files = patches(spark, ("a", f'key = "{secret}"; x={secret}\nshort text and aaaaaaaaaaaaaaaaaaaaaaaaaaaa'))
    assert [r.token for r in ops.token_entropy(files).collect()] == [secret, secret]


def test_not_null(spark):
    rows = spark.createDataFrame([("a", "b"), (None, "b"), (None, None)], "x string, y string")
    valid, rejected = ops.split_not_null(rows, ["x", "y"])
    assert [tuple(r) for r in valid.collect()] == [("a", "b")]
    assert [r.violations for r in rejected.collect()] == [["x"], ["x", "y"]]
    assert ops.require_not_null(valid, ["x"]).count() == 1
    with pytest.raises(PySparkException, match="NULL in required column x"):
        ops.require_not_null(rows, ["x"]).collect()


def test_time_bound_is_strict(spark):
    at = [datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 12, 0, 0, 1), NOON]
    rows = spark.createDataFrame([(t,) for t in at], "detected_at timestamp")
    recent = ops.since(rows, "24 HOURS", NOON)
    assert [r[0] for r in recent.collect()] == at[1:]
    assert ops.since(rows, "24 HOURS").count() == 0


def test_noise_as_list_and_as_table(spark):
    rows = spark.createDataFrame([("React",), ("Name",), ("name",)], "library_name string")
    table = spark.createDataFrame([("name",)], "word string")
    for noise in (["name"], table):
        assert names(ops.drop_noise(rows, noise)) == ["React"]
    assert ops.drop_noise(rows, []).count() == 3


def test_a_library_may_be_in_several_sectors_once_each(spark):
    rows = spark.createDataFrame([("React-Native-Auth",), ("none",), ("vitest",)], "library_name string")
    seeds = {"A": ["react", "native"], "B": ["auth", "vite"], "C": ["test"]}
    table = spark.createDataFrame(
        [(s, i, k) for i, (s, words) in enumerate(seeds.items()) for k in words],
        "sector string, sector_ord int, keyword string",
    )
    expected = {
        ("React-Native-Auth", "A", 0), ("React-Native-Auth", "B", 1), ("vitest", "B", 1), ("vitest", "C", 2),
    }
    for given in (seeds, table):
        rows_ = ops.match_sectors(rows, given).select("library_name", "sector", "sector_ord").collect()
        assert len(rows_) == 4 and {tuple(r) for r in rows_} == expected


def test_lower_is_applied_to_names(spark):
    found = ops.js_deps(patches(spark, ("package.json", '+"Ünï": 1')))
    assert names(found.select(F.col("library_name"))) == ["ünï"]
