"""The commit side: unnest files and look commits up for pushes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.functions.text import not_blank


def explode_files(commits: DataFrame, *extra: str) -> DataFrame:
    """One row per file that has a patch: repo_name, commit_sha, filename (lowercase), patch."""
    # The outer form makes Spark skip a guard on the array's size, for which it
    # would compute a derived array a second time. The filter drops its NULL rows.
    return (
        commits.select("repo_name", "sha", F.explode_outer("files").alias("file"), *extra)
        .filter(not_blank(F.col("file.patch")))
        .select(
            "repo_name",
            F.col("sha").alias("commit_sha"),
            F.lower(F.coalesce("file.filename", F.lit(""))).alias("filename"),
            "file.patch",
            *extra,
        )
    )


def _same_commit(push: DataFrame, commits: DataFrame):
    sha = "commit_sha" if "commit_sha" in commits.columns else "sha"
    return (push["name"] == commits["repo_name"]) & (push["head"] == commits[sha])


def enrich(push: DataFrame, commits: DataFrame) -> DataFrame:
    """Pushes with what is known about their commit; pushes of unknown commits drop out.

    ``commits`` may be the commit table or anything computed per commit file.
    Give it the narrow result (scores, names) rather than patch texts: each file
    is then analysed once and no text goes through the join's shuffle. The join
    is a plain equi join: Spark broadcasts a side only below its own size bound,
    and AQE splits the partition of a commit that is pushed over and over.
    """
    return push.join(commits, _same_commit(push, commits), "inner").drop("name", "head")


def commit_missing(push: DataFrame, commits: DataFrame) -> DataFrame:
    """The pushes whose commit is unknown."""
    return push.join(commits, _same_commit(push, commits), "left_anti")
