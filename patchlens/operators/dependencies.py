"""Dependency names added in manifest files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.functions.text import manifest_kind
from patchlens.lookups import JAVASCRIPT_DEPENDENCY, PACKAGING_TOOLS, PYTHON_DEPENDENCY


def with_libraries(files: DataFrame) -> DataFrame:
    """Add ``language`` and ``libraries``, the names a manifest's patch adds.

    Names come in the order found, as written, repeats included. Both columns
    are NULL for files that are no manifest.
    """
    python = F.regexp_extract_all("patch", F.lit(PYTHON_DEPENDENCY), F.lit(1))
    javascript = F.regexp_extract_all("patch", F.lit(JAVASCRIPT_DEPENDENCY), F.lit(1))
    language = F.col("language")
    return files.withColumn("language", manifest_kind(F.col("filename"))).withColumn(
        "libraries", F.when(language == "Python", python).when(language == "JavaScript", javascript)
    )


def trend_rows(files: DataFrame, *extra: str) -> DataFrame:
    """Files with ``libraries`` -> one row per name: library_name, language, repo_name."""
    tool = (F.col("language") == "Python") & F.col("library_name").isin(*PACKAGING_TOOLS)
    # Outer, so that Spark adds no guard that would search every patch twice.
    return (
        files.select(F.explode_outer("libraries").alias("library"), "language", "repo_name", *extra)
        .filter(F.col("library").isNotNull())
        .select(F.lower("library").alias("library_name"), "language", "repo_name", *extra)
        .filter(~tool)
    )


def extract_trends(files: DataFrame) -> DataFrame:
    """Python and JavaScript dependencies of the files, one row per added name.

    A file has one language, so one pass gives the union of ``py_deps`` and
    ``js_deps`` without reading the files twice.
    """
    return trend_rows(with_libraries(files).filter(F.col("language").isNotNull()))


def py_deps(files: DataFrame) -> DataFrame:
    return trend_rows(with_libraries(files).filter(F.col("language") == "Python"))


def js_deps(files: DataFrame) -> DataFrame:
    return trend_rows(with_libraries(files).filter(F.col("language") == "JavaScript"))
