"""Nearest neighbours by cosine from a hash-prefix forest.

A hash string is CODE_BITS signs of random projections; a tree is the sorted array of its hash
strings. A query descends each tree to its longest-prefix match and then ascends all trees at
once, one bit at a time, taking every row that shares the shorter prefix, until it has enough
candidates. These are scored exactly.

The rows are dealt in shards of SHARD_ROWS with a forest each, and the stated query set visits
the shards in blocks of BLOCK_QUERIES; only each visit's best few rows leave it. Equal vectors
are one point: they would share every prefix, so that no prefix could part them.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
TREES = 40
CODE_BITS = 64
#: Candidates of a query in a shard: this share of its points, and at least so many.
SHARE = 0.5
LEAST = 1500


def hash_strings(points: np.ndarray, trees: int = TREES) -> np.ndarray:
    """[tree, point] hash strings, first projection in the highest bit; the projections depend on the dimension only."""
    rng = np.random.default_rng(points.shape[1])
    out = np.empty((trees, len(points)), np.uint64)
    for t in range(trees):
        planes = rng.normal(size=(points.shape[1], CODE_BITS))
        out[t] = np.packbits(points @ planes > 0, axis=1).view(">u8").ravel()
    return out


class Forest:
    """Sorted arrays of the hash strings of some points."""

    def __init__(self, points: np.ndarray, trees: int = TREES):
        codes = hash_strings(points, trees)
        self.size = len(points)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, 1)

    def longest(self, asked: np.ndarray) -> np.ndarray:
        """[query] length of the longest prefix that any tree shares with each of asked [tree, query]."""
        best = np.zeros(asked.shape[1], np.int64)
        for codes, mine in zip(self.codes, asked):
            at = np.searchsorted(codes, mine)
            for near in (np.maximum(at - 1, 0), np.minimum(at, self.size - 1)):
                differ = codes[near] ^ mine
                # The highest differing bit, found by halving.
                length = np.zeros(len(mine), np.int64)
                for step in (32, 16, 8, 4, 2, 1):
                    same = (differ >> np.uint64(CODE_BITS - step)) == 0
                    length += np.where(same, step, 0)
                    differ = np.where(same, differ << np.uint64(step), differ)
                best = np.maximum(best, length + (differ == 0))
        return best

    def ranges(self, asked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """[tree, query] first and last+1 sorted places that share the first ``length`` bits."""
        low = np.uint64(2**64 - (1 << (CODE_BITS - length))) if length else np.uint64(0)
        first = np.stack([np.searchsorted(c, a & low) for c, a in zip(self.codes, asked)])
        last = np.stack([np.searchsorted(c, a | ~low, side="right") for c, a in zip(self.codes, asked)])
        return first, last

    def candidates(self, asked: np.ndarray, enough: int) -> list[np.ndarray]:
        """For each query the points met by descending and synchronously ascending, at least ``enough`` if there are."""
        found: list[np.ndarray | None] = [None] * asked.shape[1]
        longest = self.longest(asked)
        for length in range(int(longest.max(initial=0)), -1, -1):
            open_ = np.flatnonzero((longest >= length) & np.array([f is None for f in found]))
            if not len(open_):
                continue
            first, last = self.ranges(asked[:, open_], length)
            # Ranges of all trees together bound the distinct points from above.
            for k in np.flatnonzero((last - first).sum(axis=0) >= min(enough, self.size)):
                met = np.zeros(self.size, bool)
                for tree in range(len(self.order)):
                    met[self.order[tree, first[tree, k] : last[tree, k]]] = True
                if met.sum() >= min(enough, self.size):
                    found[open_[k]] = np.flatnonzero(met)
        return found


FOUND = "query bigint, point bigint, score double"


def _visits(rows: DataFrame, k: int, trees: int, share: float, least: int) -> DataFrame:
    """The best k + 1 points of each query in each visit (dim, shard, block) of rows (..., asks, key, embedding)."""

    def visit(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        keys = table.column("key").to_numpy()
        dim = table.column("dim")[0].as_py()
        vectors = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        # Powers of two change no sign and no cosine, and keep squares from overflow and underflow.
        vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        order = np.argsort(keys, kind="stable")  # the result does not depend on the order of arrival
        points, queries = order[~asks[order]], order[asks[order]]
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(points) and len(queries):
            x, q = vectors[points], vectors[queries]
            forest = Forest(x, trees)
            met = forest.candidates(hash_strings(q, trees), max(least, int(share * len(points))))
            norm = np.sqrt((x * x).sum(axis=1))
            parts = []
            for j, near in enumerate(met):
                score = x[near] @ q[j] / (norm[near] * np.sqrt((q[j] * q[j]).sum()))
                best = np.argpartition(-score, k)[: k + 1] if len(near) > k + 1 else np.arange(len(near))
                # Keep whatever ties with the last of the best.
                best = np.flatnonzero(score >= score[best].min())
                parts.append((np.full(len(best), keys[queries[j]]), keys[points[near[best]]], score[best]))
            out = [np.concatenate(p) for p in zip(*parts)]
        return pa.table({"query": out[0], "point": out[1], "score": out[2]})

    return rows.groupBy("dim", "shard", "block").applyInArrow(visit, FOUND)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, share: float = SHARE, least: int = LEAST
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of vectors for each row of queries, but for itself.

    Both have (vec_id, embedding). Nearness is the cosine in double precision; ties go to the
    smaller vec_id; vectors of another length are no neighbours. Finite vectors of any size take part. Rows without a vec_id, and
    vectors that are null, empty, zero or hold null or non-finite components, take no part.
    Repeated rows count once. An empty table gives no rows; a query with fewer than k other rows
    gets them all.
    """

    def valid(df: DataFrame) -> DataFrame:
        e = F.col("embedding")
        fine = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(e, lambda c: c != 0)
        typed = df.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
        return typed.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn(
            "key", F.xxhash64("embedding")
        )

    of_key = Window.partitionBy("key").orderBy("vec_id")
    rows = valid(vectors)
    # Of equal vectors the k + 1 smallest ids can be results; the limit applies before the shuffle.
    members = (
        rows.withColumn("place", F.dense_rank().over(of_key)).where(F.col("place") <= k + 1).dropDuplicates(["key", "vec_id"])
    )
    points = members.where("place = 1").select("key", "embedding", F.size("embedding").alias("dim"))
    asking = valid(queries)
    asked = asking.dropDuplicates(["key"]).select("key", "embedding", F.size("embedding").alias("dim"))
    shards = -(-rows.count() // SHARD_ROWS) or 1
    blocks = -(-asking.count() // BLOCK_QUERIES) or 1
    shard, block = F.pmod(F.col("key"), F.lit(shards)), F.pmod(F.xxhash64("key"), F.lit(blocks))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    dealt = points.select("dim", shard.alias("shard"), each(blocks).alias("block"), F.lit(False).alias("asks"), "key", "embedding")
    visiting = asked.select("dim", each(shards).alias("shard"), block.alias("block"), F.lit(True).alias("asks"), "key", "embedding")
    found = _visits(dealt.unionByName(visiting), k, trees, share, least)
    # Points, at first: k + 1 of them hold the k nearest rows and the query's own. rank() keeps ties whole.
    short = found.withColumn("r", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("r") <= k + 1)
    ids = members.select(F.col("key").alias("point"), "vec_id")
    named = short.select("query", "point", "score").join(ids, "point")
    per_query = asking.select("key", F.col("vec_id").alias("query_id")).distinct()
    pairs = per_query.join(named, F.col("key") == F.col("query")).where(F.col("vec_id") != F.col("query_id"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
