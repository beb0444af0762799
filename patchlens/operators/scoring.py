"""Entropy of patches and tokens, and the leaks found by it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.functions.entropy import entropy_udf
from patchlens.functions.text import strip_ws
from patchlens.lookups import LEAK_THRESHOLD

TOKEN_BREAKS = r"[\s\"'=:,;()]+"


def with_entropy(df: DataFrame, text: str = "patch") -> DataFrame:
    """Add ``entropy_score``, computed once per row.

    As a plain column, a later filter on the score would move below it and score
    every text a second time. It cannot move below a generator, whereas filters
    on other columns still can.
    """
    score = F.array(entropy_udf(F.col(text)))
    return df.select("*", F.explode_outer(score).alias("entropy_score"))


def patch_entropy(
    df: DataFrame, key: list[str], text: str = "patch", method: str = "arrow"
) -> DataFrame:
    """Entropy per row: the key columns and ``entropy_score``.

    ``arrow`` scores each text where it is read, without a shuffle. ``native``
    stays in the JVM but sends some sixty (key, character, count) rows per text
    through a shuffle, and needs a key that is unique per row.
    """
    if method == "arrow":
        return with_entropy(df, text).select(*key, "entropy_score")
    if method == "native":
        return _entropy_by_character_counts(df, key, text)
    raise ValueError(f"unknown entropy method: {method}")


def _entropy_by_character_counts(df: DataFrame, key: list[str], text: str) -> DataFrame:
    empty = F.coalesce(F.length(text) == 0, F.lit(True)).alias("_empty")
    characters = F.explode_outer(F.split(strip_ws(F.col(text)), "")).alias("_char")
    counts = (
        df.select(*key, empty, characters)
        .groupBy(*key, "_empty", "_char")
        .agg(F.count(F.when(F.length("_char") > 0, 1)).alias("_n"))
    )
    n, latin = F.col("_n"), F.ascii("_char") < 256
    sums = counts.groupBy(*key, "_empty").agg(
        F.sum(n).alias("_total"),
        F.sum(F.when(latin, n).otherwise(0)).alias("_latin"),
        F.sum(F.when(latin & (n > 1), n * F.log2(n)).otherwise(0.0)).alias("_n_log_n"),
    )
    # -sum(p log p) over counts n of a total N is (L log N - sum(n log n)) / N.
    score = (F.col("_latin") * F.log2("_total") - F.col("_n_log_n")) / F.col("_total")
    return sums.select(
        *key,
        F.when(F.col("_empty"), 0.0)
        .when(F.col("_total") > 0, F.abs(score))
        .alias("entropy_score"),
    )


def detect_leaks(files: DataFrame, threshold: float = LEAK_THRESHOLD) -> DataFrame:
    """The files whose patch scores above the threshold: repo_name, commit_sha, entropy_score.

    A text of n characters cannot score above log2(n), so short patches are left
    out before scoring.
    """
    scored = patch_entropy(
        files.filter(F.length("patch") > 2.0**threshold),
        ["repo_name", "commit_sha"],
    )
    return scored.filter(F.col("entropy_score") > threshold)


def token_entropy(
    files: DataFrame, threshold: float = LEAK_THRESHOLD, min_len: int = 0
) -> DataFrame:
    """Single tokens of a patch that score above the threshold, one row per occurrence."""
    tokens = files.select(
        "repo_name",
        "commit_sha",
        F.explode_outer(F.split("patch", TOKEN_BREAKS)).alias("token"),
    ).filter((F.length("token") >= min_len) & (F.length("token") > 2.0**threshold))
    scored = patch_entropy(tokens, ["repo_name", "commit_sha", "token"], text="token")
    return scored.filter(F.col("entropy_score") > threshold)
