"""Commits as the JSON texts they arrive in: typed columns for what is known, VARIANT for the rest.

A field that nobody knows yet is neither lost nor an error, and a text that is no commit is
listed with the reason.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchlens.functions.text import not_blank
from patchlens.functions.variants import fields_of, step, whole_json

COMMIT_FIELDS = ("repo_name", "sha", "files")
FILE_FIELDS = ("filename", "patch")


def _rest(fields: Column, known: tuple[str, ...]) -> Column:
    return F.map_filter(fields, lambda name, _: ~name.isin(*known))


def _read(messages: DataFrame, *extra: str) -> DataFrame:
    """commit (VARIANT of the text ``value``) and its files as VARIANTs; NULL where it has none."""
    # The text is parsed in a step of its own, as it is used more than once.
    text = messages.select(step(F.col("value").cast("string")).alias("value"), *extra)
    parsed = text.select(step(whole_json(F.col("value"))).alias("commit"), *extra)
    files = F.try_variant_get("commit", "$.files", "array<variant>")
    return parsed.select("commit", files.alias("files"), *extra)


def commit_files(messages: DataFrame, *extra: str) -> DataFrame:
    """JSON commits (value) -> as ``explode_files``, and maps of the fields beyond: commit_rest, file_rest.

    A file without a patch, or that is no object, gives no row; nor does what ``commit_reasons`` lists.
    """
    text = lambda c, path: F.try_variant_get(c, path, "string")
    commits = _read(messages, *extra).select(
        text("commit", "$.repo_name").alias("repo_name"),
        text("commit", "$.sha").alias("commit_sha"),
        _rest(fields_of(F.col("commit")), COMMIT_FIELDS).alias("commit_rest"),
        "files",
        *extra,
    )
    known = commits.filter(F.col("repo_name").isNotNull() & F.col("commit_sha").isNotNull())
    files = known.select("repo_name", "commit_sha", "commit_rest", F.explode("files").alias("file"), *extra)
    return files.select(
        "repo_name",
        "commit_sha",
        F.lower(F.coalesce(text("file", "$.filename"), F.lit(""))).alias("filename"),
        text("file", "$.patch").alias("patch"),
        "commit_rest",
        _rest(fields_of(F.col("file")), FILE_FIELDS).alias("file_rest"),
        *extra,
    ).filter(not_blank(F.col("patch")))


def commit_reasons(messages: DataFrame, *extra: str) -> DataFrame:
    """``reason`` of each message that is no commit: no JSON, no object, lacks a field, files are no list."""
    missing = F.lit(None).cast("string")
    for field in ("sha", "repo_name"):
        absent = F.try_variant_get("commit", f"$.{field}", "string").isNull()
        missing = F.coalesce(missing, F.when(absent, F.lit(f"lacks {field}")))
    reason = (
        F.when(F.col("commit").isNull(), "no JSON")
        .when(fields_of(F.col("commit")).isNull(), "no object")
        .otherwise(F.coalesce(missing, F.when(F.col("files").isNull(), "files are no list")))
    )
    return _read(messages, *extra).select(step(reason).alias("reason"), *extra).filter(F.col("reason").isNotNull())
