"""Whitening of embeddings by a covariance over distinct vectors and their multiplicities.

Equal vectors are grouped first. A vector counts as often as it occurs, or once, in the fit: the
weighted sums give the mean, and weighted centred products of blocks of vectors give the
covariance. Each distinct vector is whitened once, and the result is joined back to its rows.

The driver gets one matrix of the vectors' dimension squared. The products of all tasks are added
up in Spark, entry by entry, so the driver never holds a matrix for each task.
"""

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchlens.llm.scratch import saved

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Vectors multiplied at once in a task.
BLOCK_ROWS = 4096
#: Larger whole numbers would not all be exact in double precision.
MOST = 2.0**50
#: An eigenvalue up to this share of the greatest is no direction, but rounding.
LEAST_SHARE = 1e-12


def whole_numbers(vector: Column, scale: int = SCALE, shift: int = SHIFT, most: float = MOST) -> Column:
    """floor(scale * c) + shift of each entry; null for a null vector, and where an entry is null, not finite or beyond ``most``."""
    grown = F.transform(vector, lambda c: F.lit(float(scale)) * c.cast("double"))
    fine = F.forall(grown, lambda g: g.isNotNull() & ~F.isnan(g) & (F.abs(g) <= most))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(grown, lambda g: F.floor(g) + F.lit(shift)))


def vector_key(x: Column) -> Column:
    """SHA-256 of a vector of whole numbers."""
    return F.unhex(F.sha2(F.array_join(x.cast("array<string>"), ","), 256))


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batches: Iterable[pa.RecordBatch], column: str, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vectors, weights) of bounded size."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield _rows(part.column(column), dim), part.column("weight").to_numpy()


def exact_sums(vectors: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Weighted number and sum by dimension of vectors (x array<bigint>, weight)."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dim
        for x, w in _blocks(batches, "x", dim):
            n += int(w.sum())
            # In two halves, so that neither sum leaves 64 bits.
            high, low = w @ (x >> 25), w @ (x & ((1 << 25) - 1))
            sums = [s + (int(h) << 25) + int(v) for s, h, v in zip(sums, high, low)]
        text = pa.array([str(s) for s in [n, *sums]])
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), text], ["k", "part"])

    parts = vectors.mapInArrow(add, "k int, part string")
    total = parts.groupBy("k").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()
    of = {r.k: int(r.s) for r in total}
    return of.get(-1, 0), [of.get(k, 0) for k in range(dim)]


def summed(rows: DataFrame, make: Callable, width: int) -> np.ndarray:
    """The sum over all tasks of the matrix that make(batches) gives for each; ``width`` columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = make(batches)
        number = pa.array(range(len(matrix)), pa.int32())
        yield pa.RecordBatch.from_arrays([number, pa.array(list(matrix), pa.list_(pa.float64()))], ["i", "entries"])

    entries = rows.mapInArrow(run, "i int, entries array<double>").select("i", F.posexplode("entries").alias("j", "v"))
    total = entries.groupBy("i", "j").agg(F.sum("v").alias("v")).groupBy("i").agg(F.collect_list(F.struct("j", "v")).alias("row"))
    found = total.collect()
    out = np.zeros((1 + max((r.i for r in found), default=-1), width))
    for r in found:
        for j, v in r.row:
            out[r.i, j] = v
    return out


def centred_products(vectors: DataFrame, column: str, dim: int, centre: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of weight * c c^T, c = centre(vector)."""

    def multiply(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((dim, dim))
        for x, w in _blocks(batches, column, dim):
            c = centre(x)
            out += (c * w[:, None]).T @ c
        return out

    return summed(vectors, multiply, dim)


def _means(vectors: DataFrame, column: str, dim: int) -> np.ndarray:
    def add(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        return sum((w @ z for z, w in _blocks(batches, column, dim)), np.zeros(dim))[None]

    def count(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        return np.array([[float(sum(w.sum() for _, w in _blocks(batches, column, dim)))]])

    return summed(vectors, add, dim)[0] / summed(vectors, count, 1)[0, 0]


def whiten_fit(rows: DataFrame, dim: int, components: int, weights: str) -> DataFrame:
    """As `whiten` for rows (vec_id, key, x) of one dimension."""
    grouped = rows.groupBy("key").agg(F.first("x").alias("x"), F.count("*").alias("copies"))
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("bigint")
    distinct = saved(grouped.select("key", "x", weight.alias("weight")))
    n, sums = exact_sums(distinct, dim)
    # The mean as a whole number and a rest, so that centring loses nothing.
    base = np.array([s // n for s in sums], np.int64)
    over = np.array([s - n * int(b) for s, b in zip(sums, base)], np.int64)
    rest = over / n

    def centre(x: np.ndarray) -> np.ndarray:
        return (x - base) - rest

    covariance = centred_products(distinct, "x", dim, centre) / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[: min(components, dim)]
    values, axes = values[order], axes[:, order]
    trace = float(np.trace(covariance))
    good = values > max(LEAST_SHARE * values[0], 0.0)
    projection = axes / np.sqrt(np.where(good, values, 1.0))

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column("x"), dim)
            away = x - base
            size = n * max(1, int(np.abs(away).max(initial=0)) + 1)
            if dim * size * size < 1 << 62:
                off = n * away - over
                deviation = (off * off).sum(axis=1).tolist()
            else:
                deviation = [sum((n * int(a) - int(o)) ** 2 for a, o in zip(r, over)) for r in away]
            z = centre(x) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("weight"),
                    pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()),
                    pa.array(list(z), pa.list_(pa.float64())),
                ],
                ["key", "weight", "deviation", "z"],
            )

    white = saved(distinct.mapInArrow(project, "key binary, weight bigint, deviation bigint, z array<double>"))
    error = None
    if good.any():
        mean = _means(white, "z", len(order))
        second = centred_products(white, "z", len(order), lambda z: z - mean) / n
        error = float(np.abs((second - np.eye(len(order)))[np.ix_(good, good)]).max())

    each = F.array(
        *(
            F.struct(
                F.lit(k + 1).alias("component"),
                (F.col("z")[k] if good[k] else F.lit(None).cast("double")).alias("whitened"),
                F.lit(float(values[k]) / trace if trace > 0 else None).cast("double").alias("explained"),
            )
            for k in range(len(order))
        )
    )
    found = rows.select("vec_id", "key").join(white.select("key", "deviation", "z"), "key")
    return found.select("vec_id", "deviation", F.inline(each)).select(
        "vec_id",
        "component",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )


RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """For each row of vectors (vec_id, embedding) and each of the first ``components`` directions: where it lies, whitened.

    Entries c become x = floor(64 c) + 1000000. The fit list is all x-vectors, each as often as it occurs
    (``weights="counts"``), or each distinct one once (``"one"``). ``n`` is its length, ``deviation`` the sum over
    dimensions of (n x - S)^2 with S its sums, ``whitened`` x minus the mean, projected on the unit
    eigenvector of its covariance and divided by the root of the eigenvalue e, ``explained`` e by the
    trace, ``identity_error`` the largest entry of |covariance of whitened - identity|.

    Vectors that are null, or hold a null, non-finite or (beyond 2^50 when scaled) inexact entry give no rows,
    nor do empty ones. Vectors of each length are a fit list of their own. Rows without a vec_id and
    repeated rows are rows like any other. Where the vectors do not vary, along a direction or at all,
    ``whitened`` is null, ``explained`` is null if the trace is 0, and ``identity_error`` covers the other directions
    (null without any). A ``deviation`` beyond 64 bits is null. Other columns are ignored; an
    empty table gives no rows.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"unknown weights: {weights}")
    x = vectors.select(F.col("vec_id").cast("bigint"), whole_numbers(F.col("embedding")).alias("x")).where("size(x) > 0")
    rows = saved(x.select("vec_id", "x", F.size("x").alias("dim"), vector_key(F.col("x")).alias("key")))
    dims = sorted(r.dim for r in rows.select("dim").distinct().collect())
    fits = [whiten_fit(rows.where(F.col("dim") == d), d, components, weights) for d in dims]
    return reduce(DataFrame.unionByName, fits) if fits else vectors.sparkSession.createDataFrame([], RESULT)
