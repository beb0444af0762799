"""Column functions on literal edge cases."""

import pytest
from pyspark.sql import functions as F

from patchlens.functions import (
    entropy_udf,
    manifest_kind,
    mask_repo,
    mask_segments,
    mask_sha,
    register_sql_functions,
    risk_band,
    strip_fences,
    strip_ws,
    theme_label,
    vibe_sector,
)
from patchlens.lookups import NOISE_WORDS, SECTOR_SEEDS, WHITESPACE_CHARACTERS


def test_entropy_edges(column):
    texts = ["aabb", "a b", "abcd", "é漢", " \n\t", "", None, "漢字", "aaaa"]
    assert column(entropy_udf, *texts) == [1.0, 1.0, 2.0, 0.5, None, 0.0, 0.0, 0.0, 0.0]


def test_entropy_in_sql(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT shannon_entropy('aabb') AS h").first().h == 1.0


def test_whitespace_is_what_python_calls_whitespace(column):
    every = [chr(c) for c in range(1, 0x3100)]
    assert WHITESPACE_CHARACTERS == "".join(c for c in every if c.isspace())
    text = "".join(f"{c}x" for c in every)
    assert column(strip_ws, text) == ["".join(text.split())]


def test_manifest_kind(column):
    paths = [
        "requirements.txt", "Dev-Requirements.TXT", "web/package.json",
        "requirements.txt/package.json", "package.json/requirements.txt", "setup.py", None,
    ]
    expected = ["Python", "Python", "JavaScript", "Python", "Python", None, None]
    assert column(manifest_kind, *paths) == expected


def test_view_mask(column):
    names = ["abcd/ef/ghijk", "ab/cde", "owner1/project22", "solo", None]
    expected = ["abc***/ef/ghi***", "ab/cde", "own***/pro***", "sol***", None]
    assert column(mask_segments, *names) == expected


@pytest.mark.parametrize(
    ("segment", "whole", "expected"),
    [
        (4, 8, ["owne**/proj**", "verylong**", "ab**/cde**", "a**/b**", "**/**"]),
        (3, 6, ["own**/pro**", "verylo**", "ab**/cde**", "a**/b**", "**/**"]),
    ],
)
def test_repo_masks(column, segment, whole, expected):
    names = ["owner1/project22", "verylongname", "ab/cde", "a/b/c", "/"]
    assert column(lambda c: mask_repo(c, segment, whole), *names) == expected


def test_sha_masks(column):
    sha = "0123456789abcdef"
    assert column(mask_sha, sha, "abc") == ["01234567" + "*" * 16, "abc" + "*" * 16]
    assert column(lambda c: mask_sha(c, "·"), sha) == ["01234567" + "·" * 16]


def test_risk_bands_are_strict(spark):
    rows = spark.createDataFrame([(4.51,), (4.5,), (3.51,), (3.5,), (0.0,)], "h double")
    risks = [r[0] for r in rows.select(risk_band(F.col("h"))).collect()]
    assert risks == ["CRITICAL", "HIGH", "HIGH", "LOW", "LOW"]


def test_risk_is_banded_after_rounding(spark):
    row = spark.range(1).select(risk_band(F.round(F.lit(4.504), 2)).alias("r")).first()
    assert row.r == "HIGH"


def test_sector_of_a_theme(column):
    themes = ["[Backend & API] Speed", "Speed", "[[A] x] y", "x [B] y", None]
    assert column(vibe_sector, *themes) == ["Backend & API", "Speed", "A", "x B", None]


def test_theme_label(spark):
    row = spark.range(1).select(theme_label(F.lit("A"), F.lit("t")).alias("v")).first()
    assert row.v == "[A] t"


def test_fences(column):
    answers = ["```json\n[1]\n```", "  [1] ", "　[1] ", "```[1]```"]
    assert column(strip_fences, *answers) == ["[1]"] * 4


def test_lookup_sizes():
    assert len(set(NOISE_WORDS)) == len(NOISE_WORDS) == 55
    assert all(w == w.lower() for w in NOISE_WORDS)
    assert [len(set(words)) for words in SECTOR_SEEDS.values()] == [10] * 4
