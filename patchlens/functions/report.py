"""Column functions of the risk and sector reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchlens.functions.text import trim_ws
from patchlens.lookups import HIGH_RISK_THRESHOLD, LEAK_THRESHOLD


def risk_band(
    c: Column, critical: float = LEAK_THRESHOLD, high: float = HIGH_RISK_THRESHOLD
) -> Column:
    """CRITICAL above one bound, HIGH above the other, else LOW."""
    return F.when(c > critical, "CRITICAL").when(c > high, "HIGH").otherwise("LOW")


def theme_label(sector: Column, theme: Column) -> Column:
    return F.concat(F.lit("["), sector, F.lit("] "), theme)


def vibe_sector(c: Column) -> Column:
    """The sector inside a ``[sector] theme`` label; the whole text without one."""
    inside = F.replace(F.substring_index(c, "]", 1), F.lit("["), F.lit(""))
    return F.when(c.contains("]"), trim_ws(inside)).otherwise(c)


def strip_fences(c: Column) -> Column:
    """A model's answer without its markdown code fences and outer whitespace."""
    bare = F.replace(F.replace(c, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    return trim_ws(bare)
