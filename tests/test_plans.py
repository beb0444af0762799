"""Reports on literal tables."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patchlens import plans
from patchlens.schemas import DETECTED_LEAKS, TECH_TRENDS

NOW = datetime(2024, 1, 10, 12)


def ago(**units):
    return NOW - timedelta(**units)


@pytest.fixture
def leaks(spark):
    rows = [
        ("owner1/project1", "c1", 4.5, ago(hours=1)),
        ("owner1/project1", "c1", 4.7, ago(hours=2)),
        ("owner2/project2", "c2", 5.0, ago(hours=3)),
        ("solo", "c3", 3.6, ago(hours=4)),
        ("solo", "c4", 3.2, ago(hours=23, minutes=59)),
        ("old/repo", "c5", 6.0, ago(hours=24)),
        ("old/repo", "c6", 4.6, ago(days=7)),
    ]
    return spark.createDataFrame(rows, DETECTED_LEAKS)


def trend_table(spark, counts, at):
    rows = [(name, "Python", "a/b", at) for name, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, TECH_TRENDS)


def test_kpi(leaks):
    row = plans.kpi(leaks, NOW).first()
    assert (row.total_leaks, row.critical_count, row.affected_repos) == (4, 2, 3)
    assert row.avg_risk == pytest.approx((4.5 + 4.7 + 5.0 + 3.6 + 3.2) / 5)
    sketched = plans.kpi(leaks, NOW, approx=True).first()
    assert (sketched.total_leaks, sketched.affected_repos) == (4, 3)


def test_kpi_without_rows(leaks):
    row = plans.kpi(leaks, datetime(2025, 1, 1)).first()
    assert tuple(row) == (0, None, 0, 0)


def test_entropy_hourly(leaks):
    rows = plans.entropy_hourly(leaks).collect()
    assert [r.hr for r in rows] == sorted(r.hr for r in rows)
    assert len(rows) == 6 and rows[0].hr == datetime(2024, 1, 3, 12)
    # 12:00 and 12:01 of the day before fall in one hour.
    assert [r for r in rows if r.hr == datetime(2024, 1, 9, 12)][0].max_entropy == 6.0


def test_histogram_closes_its_last_bin_and_shows_empty_ones(leaks):
    rows = plans.entropy_histogram(leaks, NOW, bins=7, threshold=4.5).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 1, 0, 0, 0, 2, 1]
    assert rows[0].lo == pytest.approx(3.2) and rows[-1].hi == pytest.approx(5.0)
    assert [r.is_critical for r in rows] == [False] * 5 + [True] * 2


def test_histogram_of_one_score_and_of_none(leaks):
    one = leaks.filter("commit_sha = 'c2'")
    rows = plans.entropy_histogram(one, NOW).orderBy("bin").collect()
    assert [r.n for r in rows] == [1] + [0] * 24
    assert plans.entropy_histogram(one, datetime(2025, 1, 1)).count() == 0


def test_top_risky_repos(leaks):
    rows = [tuple(r) for r in plans.top_risky_repos(leaks, NOW, k=2).collect()]
    assert rows == [("owne**/proj**", 1, 5.0), ("owne**/proj**", 1, 4.6)]


def test_rank_ties_follow_the_name(spark):
    rows = [(f"repo{i}", "c", 4.6, NOW) for i in (3, 1, 2)]
    table = spark.createDataFrame(rows, DETECTED_LEAKS)
    assert [r.repo_name for r in plans.top_risky_repos(table, NOW, k=2).collect()] == ["repo1**", "repo2**"]


def test_heatmap_counts_commits_and_names_days(leaks):
    rows = {(r.dow, r.hour): (r.day_name, r.leak_count) for r in plans.activity_heatmap(leaks).collect()}
    # 10 January 2024 is a Wednesday.
    assert rows[(4, 11)] == ("Wed", 1) and rows[(3, 12)] == ("Tue", 2)


def test_heatmap_pivot(leaks):
    rows = plans.heatmap_pivot(leaks).collect()
    assert [r.day_name for r in rows] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert rows[1].h12 == 2 and rows[1].h00 == 0 and rows[0].h00 is None
    assert len(rows[0]) == 25


def test_live_latest(leaks):
    rows = plans.live_latest(leaks).collect()
    assert [tuple(r) for r in rows] == [
        ("own**/pro**", "c1" + "·" * 16, 4.5, "HIGH", "2024-01-10 11:00"),
        ("own**/pro**", "c2" + "·" * 16, 5.0, "CRITICAL", "2024-01-10 09:00"),
        ("solo**", "c3" + "·" * 16, 3.6, "HIGH", "2024-01-10 08:00"),
        ("old**/rep**", "c5" + "·" * 16, 6.0, "CRITICAL", "2024-01-09 12:00"),
    ]
    assert plans.live_latest(leaks, k=2).count() == 2


def test_public_view(leaks):
    rows = plans.public_security_stream(leaks).collect()
    assert [r.detected_at for r in rows] == sorted((r.detected_at for r in rows), reverse=True)
    assert rows[0].masked_repo == "own***/pro***" and rows[0].masked_sha == "c1" + "*" * 16


def test_noise_leaves_after_the_limit(spark):
    trends = trend_table(spark, {"name": 5, "flask": 4, "react": 3, "vue": 2}, ago(hours=1))
    rows = plans.tech_trends_top(trends, as_of=NOW, limit=3).collect()
    assert [tuple(r) for r in rows] == [(1, "flask", 4, 1.0), (2, "react", 3, 0.75)]
    assert plans.trend_radar(trends, as_of=NOW, k=1).count() == 1


def test_candidates_look_back_one_day(spark):
    trends = trend_table(spark, {"flask": 2}, ago(days=2)).unionByName(
        trend_table(spark, {"react": 1, "vue": 1, "type": 9}, ago(hours=2))
    )
    candidates = plans.llm_candidates(trends, as_of=NOW)
    assert [tuple(r) for r in candidates.collect()] == [(1, "react", 1), (2, "vue", 1)]
    assert plans.llm_candidate_list(candidates).first().libraries == "react, vue"
    assert plans.llm_candidate_list(candidates.limit(0)).first().libraries == ""


def test_category_libs(spark):
    trends = trend_table(
        spark, {"react": 3, "react-auth": 5, "flask": 3, "name": 9, "zzz": 8}, ago(days=6)
    )
    rows = [tuple(r) for r in plans.category_libs(trends, as_of=NOW, per_sector=1).collect()]
    assert rows == [("Frontend & UI", 1, "react-auth", 5), ("Backend & API", 1, "react-auth", 5)]


def test_every_sector_is_reported(spark):
    candidates = spark.createDataFrame(
        [(1, "react", 9), (2, "vue", 8), (3, "react-auth", 7)],
        "rank int, library_name string, usage_count long",
    )
    rows = plans.sector_top_libraries(candidates, k=2).collect()
    assert [(r.sector, r.top_libraries) for r in rows] == [
        ("Frontend & UI", ["react", "vue"]),
        ("Backend & API", ["react-auth"]),
        ("Data Science & Database", []),
        ("Developer Experience & Testing", []),
    ]


GOOD = '{"sector": "A", "theme": "t", "summary": "s", "top_libs": ["x", "y"]}'


@pytest.mark.parametrize(
    ("answer", "rows"),
    [
        (f"[{GOOD}, {GOOD}]", 2),
        (f"```json\n[{GOOD}]\n```\n", 1),
        (f"[{GOOD}, {{\"sector\": \"A\", \"theme\": \"t\", \"summary\": \"s\"}}]", 0),
        (f"[{GOOD}] as asked", 0),
        (f"[{GOOD}]]", 0),
        (f"Here: [{GOOD}]", 0),
        (GOOD, 0),
        (f"[{GOOD}, 3]", 0),
        ("[]", 0),
        ("oops", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_answers_count_whole_or_not_at_all(spark, answer, rows):
    parsed = plans.parse_responses(spark.createDataFrame([(1, answer)], "id int, response string"), "id")
    assert parsed.count() == rows
    for row in parsed.collect():
        assert tuple(row) == ("A", "t", "s", ["x", "y"], 1)


def test_vibe_rows(spark):
    answer = spark.createDataFrame([(f"[{GOOD}]",)], "response string")
    parsed = plans.parse_responses(answer)
    day = date(2024, 1, 2)
    row = plans.vibe_rows(parsed, F.lit(day)).first()
    assert tuple(row) == (day, "[A] t", "s", ["x", "y"])
    dated = plans.vibe_rows(parsed).withColumn("today", F.current_date()).first()
    assert dated.vibe_date == dated.today


def test_latest_reports(spark):
    rows = [(date(2024, 1, d), f"[A] {d}", "s", ["x"]) for d in range(1, 7)]
    table = spark.createDataFrame(rows, "vibe_date date, theme_name string, summary string, top_libraries array<string>")
    assert [r.vibe_date.day for r in plans.vibe_latest(table).collect()] == [6, 5, 4, 3]
