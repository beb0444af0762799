"""Time, noise and sector filters shared by the reports."""

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = Column | datetime | str | None


def as_of_column(as_of: AsOf) -> Column:
    """The reference instant: now, unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def since(df: DataFrame, interval: str, as_of: AsOf = None) -> DataFrame:
    """Rows detected later than ``interval`` (such as ``24 HOURS``) before ``as_of``.

    Tables are partitioned by day. Spark cannot derive the day bound from the
    time bound, so it is added where the table has the day column.
    """
    start = as_of_column(as_of) - F.expr(f"INTERVAL {interval}")
    recent = df.filter(F.col("detected_at") > start)
    if "detected_date" in df.columns:
        recent = recent.filter(F.col("detected_date") >= F.to_date(start))
    return recent


def drop_noise(
    df: DataFrame, noise: DataFrame | Iterable[str], col: str = "library_name"
) -> DataFrame:
    """Remove names that are noise words, whatever their case.

    A word list becomes a set test inside the scan's stage. A table of words is
    anti-joined; Spark broadcasts it only while it is small.
    """
    name = F.lower(F.col(col))
    if isinstance(noise, DataFrame):
        return df.join(noise, name == noise["word"], "left_anti")
    words = sorted(set(noise))
    return df.filter(~name.isin(*words)) if words else df


#: Characters of the pieces by which keywords of a table are looked up.
PIECE = 3


def _pieces(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters; none if the text is shorter."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.coalesce(F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(size)))), F.array())


def keyword_matches(names: DataFrame, keywords: DataFrame) -> DataFrame:
    """(name, keyword) for every keyword that is part of a name, from tables of distinct names and keywords.

    An inverted index of pieces: names are listed by their pieces of three characters, a keyword is looked
    up by the one of its pieces that the fewest names have, and what meets is verified. Keywords
    shorter than that are pieces of their own length. An empty keyword is part of every name.
    """
    name, keyword = F.col("name"), F.col("keyword")
    size = F.least(F.length(keyword), F.lit(PIECE))
    # The lengths that occur decide which pieces of the names are listed; there are four at most.
    sizes = [r.size for r in keywords.select(size.alias("size")).distinct().collect() if r.size is not None]
    if not sizes:
        return names.select("name", F.lit(None).cast("string").alias("keyword")).limit(0)
    of_name = F.flatten(F.array(*(_pieces(name, n) if n else F.array(F.lit("")) for n in sizes)))
    listed = names.select("name", F.explode(of_name).alias("piece"))
    shared = listed.groupBy("piece").agg(F.count("*").alias("names"))
    of_keyword = F.when(F.length(keyword) >= PIECE, _pieces(keyword, PIECE)).otherwise(F.array(keyword))
    rarest = (
        keywords.select("keyword", F.explode(of_keyword).alias("piece"))
        .join(shared, "piece", "left")
        .groupBy("keyword")
        # A piece that no name has ends the search for its keyword.
        .agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "piece")).alias("first"))
        .filter(F.col("first.names") > 0)
        .select("keyword", F.col("first.piece").alias("piece"))
    )
    return listed.join(rarest, "piece").filter(F.contains(name, keyword)).select("name", "keyword")


def match_sectors(
    df: DataFrame, seeds: DataFrame | Mapping[str, Iterable[str]], col: str = "library_name"
) -> DataFrame:
    """Each row once per sector it belongs to, with ``sector`` and ``sector_ord``.

    A row belongs to a sector when any of the sector's keywords is part of the
    lowercased name, so it may belong to several. A mapping becomes a row-level
    expression. A table of (sector, sector_ord, keyword), of any size, is looked
    up by ``keyword_matches``; rows without a keyword are no seeds.
    """
    name = F.lower(F.col(col))
    if isinstance(seeds, DataFrame):
        sown = seeds.filter(F.col("keyword").isNotNull())
        names = df.select(name.alias("name")).filter(F.col("name").isNotNull()).distinct()
        matches = keyword_matches(names, sown.select("keyword").distinct())
        of_name = matches.join(sown, "keyword").select("name", "sector", "sector_ord").distinct()
        return df.join(of_name, name == of_name["name"], "inner").drop(of_name["name"])
    memberships = [
        F.when(
            _any(name.contains(keyword) for keyword in keywords),
            F.struct(F.lit(sector).alias("sector"), F.lit(ord_).alias("sector_ord")),
        )
        for ord_, (sector, keywords) in enumerate(seeds.items())
    ]
    return df.select("*", F.inline(F.array_compact(F.array(*memberships))))


def _any(tests: Iterable[Column]) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | test
    return result
