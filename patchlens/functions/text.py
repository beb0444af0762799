"""Text column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchlens.lookups import WHITESPACE, WHITESPACE_CHARACTERS


def strip_ws(c: Column) -> Column:
    """The text without any whitespace, by Python's definition of it."""
    return F.regexp_replace(c, WHITESPACE, "")


def trim_ws(c: Column) -> Column:
    """The text without whitespace at its ends, by the same definition."""
    return F.trim(c, F.lit(WHITESPACE_CHARACTERS))


def not_blank(c: Column) -> Column:
    """Neither NULL nor empty."""
    return F.length(c) > 0


def manifest_kind(filename: Column) -> Column:
    """Language of a dependency manifest, NULL for any other file.

    A substring test on the lowercased path; a path holding both names is Python.
    """
    path = F.lower(filename)
    return F.when(path.contains("requirements.txt"), "Python").when(
        path.contains("package.json"), "JavaScript"
    )
