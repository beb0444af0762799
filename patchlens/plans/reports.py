"""Sector reports: their input, the parsing of answers, and the report table."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from patchlens.functions.report import strip_fences, theme_label
from patchlens.functions.variants import fields_of, step, whole_json
from patchlens.lookups import SECTOR_SEEDS
from patchlens.operators.filters import match_sectors
from patchlens.schemas import REPORT_ITEM


def llm_candidate_list(candidates: DataFrame) -> DataFrame:
    """The candidates as one comma-separated text in rank order."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "library_name")))
    names = F.transform(pairs, lambda pair: pair["library_name"])
    return candidates.agg(F.array_join(names, ", ").alias("libraries"))


def sector_top_libraries(
    candidates: DataFrame, seeds: Mapping[str, Iterable[str]] = SECTOR_SEEDS, k: int = 10
) -> DataFrame:
    """Every sector with its first ``k`` candidates, in rank order, as an array."""
    in_sector = Window.partitionBy("sector").orderBy("rank")
    top = (
        match_sectors(candidates, seeds)
        .withColumn("place", F.row_number().over(in_sector))
        .filter(F.col("place") <= k)
        .groupBy("sector")
        .agg(F.array_sort(F.collect_list(F.struct("place", "library_name"))).alias("pairs"))
        .select("sector", F.transform("pairs", lambda p: p["library_name"]).alias("found"))
    )
    sectors = candidates.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, seeds))).alias("sector_ord", "sector")
    )
    nothing = F.array().cast("array<string>")
    return (
        sectors.join(top, "sector", "left")
        .orderBy("sector_ord")
        .select("sector", F.coalesce("found", nothing).alias("top_libraries"))
    )


def parse_responses(df: DataFrame, *extra: str) -> DataFrame:
    """Answers (``response``) -> one row per report item.

    An answer counts only as a whole: text that is not exactly one JSON list, or
    a list with an item that lacks a field, gives no row at all.
    """
    # from_json ignores what follows a complete value. Inside an object, trailing
    # text or a value that is no list makes the whole text invalid.
    wrapped = F.concat(F.lit('{"items":'), strip_fences(F.col("response")), F.lit("}"))
    schema = StructType([StructField("items", ArrayType(REPORT_ITEM))])
    items = F.from_json(wrapped, schema)["items"]
    fields = REPORT_ITEM.fieldNames()

    def complete(item: Column) -> Column:
        present = F.lit(True)
        for field in fields:
            present = present & item[field].isNotNull()
        return present

    # One expression from text to items: as a filter on a column, the check would
    # parse every answer again.
    whole = F.transform(F.array(items), lambda found: F.when(F.forall(found, complete), found))
    return df.select(F.inline_outer(F.flatten(whole)).alias(*fields), *extra).filter(
        F.col("sector").isNotNull()
    )


def response_reasons(df: DataFrame, *extra: str) -> DataFrame:
    """Answers (``response``) that give no row, each with the first ``reason`` for it.

    ``no JSON`` (or more than one value), ``no list``, ``no items``, ``item 2 is no object``,
    ``item 2 lacks summary``: missing, null, or for a list of names anything else.
    """
    kinds = {f.name: f.dataType.simpleString() for f in REPORT_ITEM.fields}
    # Read in steps of their own, as text and answer are used more than once.
    bare = df.select(step(strip_fences(F.col("response"))).alias("text"), *extra)
    read = bare.select(step(whole_json(F.col("text"))).alias("answer"), *extra)
    listed = read.select("answer", step(F.try_variant_get("answer", "$", "array<variant>")).alias("items"), *extra)

    def wrong(item: Column, place: Column) -> Column:
        found = F.when(fields_of(item).isNull(), "is no object")
        for name, kind in kinds.items():
            found = found.when(F.try_variant_get(item, f"$.{name}", kind).isNull(), f"lacks {name}")
        return F.concat(F.lit("item "), (place + 1).cast("string"), F.lit(" "), found)

    faults = F.filter(F.transform("items", wrong), lambda fault: fault.isNotNull())
    reason = (
        F.when(F.col("answer").isNull(), "no JSON")
        .when(F.col("items").isNull(), "no list")
        .when(F.size("items") == 0, "no items")
        .otherwise(F.get(faults, F.lit(0)))
    )
    return listed.select(step(reason).alias("reason"), *extra).filter(F.col("reason").isNotNull())


def vibe_rows(parsed: DataFrame, vibe_date: Column | None = None) -> DataFrame:
    """Report items -> rows of the report table, dated today unless a date is given."""
    return parsed.select(
        (F.current_date() if vibe_date is None else vibe_date).alias("vibe_date"),
        theme_label(F.col("sector"), F.col("theme")).alias("theme_name"),
        "summary",
        F.col("top_libs").alias("top_libraries"),
    )


def vibe_latest(vibes: DataFrame, k: int = 4) -> DataFrame:
    """The newest report rows."""
    return vibes.orderBy(F.desc("vibe_date"), "theme_name", "summary").limit(k)
