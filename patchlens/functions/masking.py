"""Three maskings of repository names and one of commit hashes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MIDDLE_DOT = "·"


def mask_segments(c: Column) -> Column:
    """First three characters of each path segment of four or more, then ``***``."""
    return F.regexp_replace(c, r"([^/]{3})[^/]+", r"$1***")


def mask_sha(c: Column, fill: str = "*") -> Column:
    """First eight characters, then sixteen fill characters."""
    return F.concat(F.substring(c, 1, 8), F.lit(fill * 16))


def mask_repo(c: Column, segment: int, whole: int) -> Column:
    """``owner/project`` cut to ``segment`` characters each; other names to ``whole``."""
    parts = F.split(c, "/")
    pair = F.concat(
        F.substring(F.get(parts, F.lit(0)), 1, segment),
        F.lit("**/"),
        F.substring(F.get(parts, F.lit(1)), 1, segment),
        F.lit("**"),
    )
    return F.when(c.contains("/"), pair).otherwise(
        F.concat(F.substring(c, 1, whole), F.lit("**"))
    )
