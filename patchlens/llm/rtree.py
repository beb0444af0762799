"""Hard negatives from an STR-packed R-tree over embeddings.

Sort-tile-recursive packing orders points by one coordinate, cuts them in slabs, orders each slab
by the next coordinate, and so on. A box (least and greatest value of each coordinate) bounds the
inner product of an anchor with all it holds: coordinate by coordinate it lies between the products
with the two ends. A search takes boxes by their upper bound from a queue and leaves out those
whose interval misses the score window, and those strictly below the kth score found so far; boxes
level with it stay, as ties go to the smaller vec_id.

The upper level is a packing of all points in tiles, placed by a bounded sample. A tile's box is
that of all its rows. Each tile is packed once, stored as one row, and searched by the
anchors whose windows and bounds its box can meet: first each anchor's most promising tile, then,
with the kth score found there, the others.
"""

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.llm.scratch import saved
from patchlens.llm.whitening import vector_key, whole_numbers

SCALE = 256
#: Rows that place the tiles, about, at most.
SAMPLE = 16_384
#: Rows of a part of a tile, about. Parts are what a task holds at once.
TILE_ROWS = 8192
#: Tiles at most; beyond, a tile is cut in several parts. Every task that routes anchors holds their boxes.
MAX_TILES = 2048
LEAF = 128
FANOUT = 16
#: Vectors longer than this when scaled take no part: their scores, and in up to 2^14 dimensions the
#: bounds of these, are whole numbers that double precision adds up exactly.
LONGEST = 2.0**23

LOWEST, HIGHEST = -(2**63), 2**63 - 1


def str_order(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The points, by number, so that each ``leaf`` of them in a row are a leaf: sort, tile, recurse.

    Coordinates are taken by falling spread. With m of them left, a slab of P leaves is cut in
    the mth root of P, rounded up, so of many coordinates each is halved.
    """
    coordinates = np.argsort(-points.std(axis=0), kind="stable")
    out = []

    def tile(at: np.ndarray, depth: int) -> None:
        leaves = -(-len(at) // leaf)
        if leaves <= 1 or depth == len(coordinates):
            out.append(at)
            return
        slabs = max(2, int(np.ceil(leaves ** (1 / (len(coordinates) - depth)) - 1e-9)))
        at = at[np.argsort(points[at, coordinates[depth]], kind="stable")]
        each = -(-leaves // slabs) * leaf
        for i in range(0, len(at), each):
            tile(at[i : i + each], depth + 1)

    tile(np.arange(len(points)), 0)
    return np.concatenate(out)


def bounds(asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[asked, box] least and greatest inner product with anything in the boxes."""
    up, down = np.maximum(asked, 0).astype(np.float64), np.minimum(asked, 0).astype(np.float64)
    low, high = low.T.astype(np.float64), high.T.astype(np.float64)
    return up @ low + down @ high, up @ high + down @ low


@dataclass
class Wanted:
    """What one anchor asks: its label, whether it wants the same, and score windows with a known kth score each."""

    label: int
    same: bool
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray


class RTree:
    """Points (ids, labels, vectors) packed in leaves of LEAF and nodes of FANOUT."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, packed: bool = False):
        if not packed:
            order = str_order(vectors)
            ids, labels, vectors = ids[order], labels[order], vectors[order]
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.exact = vectors.astype(np.float64)  # products of vectors within LONGEST are exact in it
        # Level by level, leaves first: boxes, least and greatest label, and the span of children.
        lows, highs, least, greatest, spans = [], [], [], [], []
        edges = np.append(np.arange(0, len(ids), LEAF), len(ids))
        below_low = below_high = vectors
        below_least = below_greatest = labels
        base = previous = -1
        while True:
            cut = edges[:-1]
            below_low = np.minimum.reduceat(below_low, cut, axis=0)
            below_high = np.maximum.reduceat(below_high, cut, axis=0)
            below_least = np.minimum.reduceat(below_least, cut)
            below_greatest = np.maximum.reduceat(below_greatest, cut)
            lows.append(below_low)
            highs.append(below_high)
            least.append(below_least)
            greatest.append(below_greatest)
            shift = 0 if base < 0 else base
            spans.append(np.stack([edges[:-1] + shift, edges[1:] + shift], axis=1))
            if base < 0:
                self.leaves, base = len(cut), 0
            else:
                base += previous
            previous = len(cut)
            if previous == 1:
                break
            edges = np.append(np.arange(0, previous, FANOUT), previous)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.least, self.greatest = np.concatenate(least), np.concatenate(greatest)
        self.span = np.concatenate(spans)

    def search(self, vector: np.ndarray, lows: np.ndarray, highs: np.ndarray, wanted: Wanted, k: int) -> list[list[tuple[int, int, int]]]:
        """For each window the first k (score, -vec_id, place), in no order; lows and highs bound each node's scores.

        Scores below a window's floor may be left out.
        """
        found: list[list[tuple[int, int, int]]] = [[] for _ in wanted.low]
        floor = np.maximum(wanted.low, wanted.floor)
        asked = np.flatnonzero(floor <= wanted.high)
        if not len(asked):
            return found
        if wanted.same:
            fits = (self.least <= wanted.label) & (wanted.label <= self.greatest)
        else:
            fits = (self.least != wanted.label) | (self.greatest != wanted.label)
        # Boxes outside all windows are out from the start; the kth scores rise as leaves are read.
        fits &= ((highs[:, None] >= floor[asked]) & (lows[:, None] <= wanted.high[asked])).any(axis=1)
        alive, most = fits.tolist(), int(wanted.high.max())
        mine, vector = (self.labels == wanted.label) == wanted.same, vector.astype(np.float64)
        upper, span = np.minimum(highs, most).tolist(), self.span.tolist()
        window, reach = wanted.high.tolist(), floor.tolist()
        least = min(reach[w] for w in asked)

        root = len(span) - 1
        queue = [(-upper[root], root)] if alive[root] else []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break  # no box left reaches any window's kth score
            a, b = span[node]
            if node >= self.leaves:
                for child in range(a, b):
                    if alive[child] and upper[child] >= least:
                        heapq.heappush(queue, (-upper[child], child))
                continue
            scores = self.exact[a:b] @ vector
            for at in ((scores >= least) & (scores <= most) & mine[a:b]).nonzero()[0].tolist():
                score = int(scores[at])
                entry = (score, -int(self.ids[a + at]), a + at)
                for w in asked:
                    if not reach[w] <= score <= window[w]:
                        continue
                    heap = found[w]
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k and heap[0][0] > reach[w]:
                        reach[w] = heap[0][0]
                        least = min(reach[v] for v in asked)
        return found
        if wanted.same:
            fits = (self.least <= wanted.label) & (wanted.label <= self.greatest)
        else:
            fits = (self.least != wanted.label) | (self.greatest != wanted.label)
        most, least = int(wanted.high.max()), int(floor.min())

        def useful(node: int) -> bool:
            return bool(fits[node]) and lows[node] <= most and highs[node] >= least and bool(((highs[node] >= floor) & (lows[node] <= wanted.high)).any())

        root = len(self.span) - 1
        queue = [(-min(int(highs[root]), most), root)] if useful(root) else []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break  # no box left reaches any window's kth score
            if not useful(node):
                continue
            a, b = self.span[node]
            if node >= self.leaves:
                for child in range(a, b):
                    if useful(child):
                        heapq.heappush(queue, (-min(int(highs[child]), most), child))
                continue
            scores = self.vectors[a:b] @ vector
            mine = (scores >= least) & (scores <= most) & ((self.labels[a:b] == wanted.label) == wanted.same)
            for at in np.flatnonzero(mine):
                score = int(scores[at])
                entry = (score, -int(self.ids[a + at]), int(a + at))
                for w in np.flatnonzero((floor <= score) & (score <= wanted.high)):
                    heap = found[w]
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        floor[w] = max(floor[w], heap[0][0])
            least = int(floor[floor <= wanted.high].min(initial=HIGHEST))
        return found


# --- tiles -----------------------------------------------------------------------------


@dataclass
class Tiling:
    """A packing of a sample as nested cuts: a coordinate, its cut values and what lies between; or a tile's number."""

    coordinate: int = -1
    cuts: np.ndarray | None = None
    children: "list[Tiling] | None" = None
    tile: int = 0

    def place(self, points: np.ndarray, out: np.ndarray, at: np.ndarray) -> None:
        if self.children is None:
            out[at] = self.tile
            return
        slab = np.searchsorted(self.cuts, points[at, self.coordinate], side="right")
        for s, child in enumerate(self.children):
            child.place(points, out, at[slab == s])


def tiling(sample: np.ndarray, tiles: int) -> tuple[Tiling, int]:
    """STR cuts for about ``tiles`` tiles of equal share, and how many there are."""
    coordinates = np.argsort(-sample.std(axis=0), kind="stable") if len(sample) else np.arange(sample.shape[1])
    count = 0

    def cut(at: np.ndarray, groups: int, depth: int) -> Tiling:
        nonlocal count
        if groups <= 1 or depth == len(coordinates):
            count += 1
            return Tiling(tile=count - 1)
        slabs = max(2, int(np.ceil(groups ** (1 / (len(coordinates) - depth)) - 1e-9)))
        c = int(coordinates[depth])
        values = np.sort(sample[at, c])
        cuts = np.unique(values[[len(values) * s // slabs for s in range(1, slabs)]]) if len(values) else np.zeros(0)
        slab = np.searchsorted(cuts, sample[at, c], side="right")
        children = [cut(at[slab == s], -(-groups // slabs), depth + 1) for s in range(len(cuts) + 1)]
        return Tiling(c, cuts, children)

    root = cut(np.arange(len(sample)), tiles, 0)
    return root, count


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


@dataclass
class Index:
    """Packed parts of tiles (dim, tile, part, ids, labels, vectors) of one dimension, and the tiles' boxes."""

    packed: DataFrame
    dim: int
    low: np.ndarray
    high: np.ndarray
    parts: np.ndarray


def build_index(points: DataFrame, dim: int, tile_rows: int, max_tiles: int, sample: int) -> Index:
    """Index of points (vec_id, label, x) of one dimension."""
    n = points.count()
    share = -(-n // sample) or 1
    chosen = points.where(F.pmod(F.xxhash64("vec_id", "x"), F.lit(share)) == 0).select("x").collect()
    some = np.array(sorted(r.x for r in chosen), np.int64).reshape(len(chosen), dim)
    root, tiles = tiling(some, max(1, min(max_tiles, -(-n // tile_rows))))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("x"), dim)
            out = np.zeros(len(x), np.int32)
            root.place(x, out, np.arange(len(x)))
            yield pa.RecordBatch.from_arrays([pa.array(out), *batch.columns], ["tile", *batch.schema.names])

    def box(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(tiles, np.int64)
        low, high = np.full((tiles, dim), HIGHEST), np.full((tiles, dim), LOWEST)
        for batch in batches:
            x, tile = _vectors(batch.column("x"), dim), batch.column("tile").to_numpy()
            np.add.at(count, tile, 1)
            np.minimum.at(low, tile, x)
            np.maximum.at(high, tile, x)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(list(low[met]), pa.list_(pa.int64())), pa.array(list(high[met]), pa.list_(pa.int64()))],
            ["tile", "n", "low", "high"],
        )

    placed = saved(points.select("vec_id", "label", "x").mapInArrow(place, "tile int, vec_id bigint, label bigint, x array<bigint>"))
    of_task = placed.mapInArrow(box, "tile int, n bigint, low array<bigint>, high array<bigint>")
    ends = of_task.select("tile", "n", F.inline(F.arrays_zip(F.sequence(F.lit(0), F.size("low") - 1).alias("k"), "low", "high"))) if dim else of_task.select("tile", "n", F.lit(None).cast("int").alias("k"), F.lit(0).alias("low"), F.lit(0).alias("high"))
    least = ends.groupBy("tile", "k").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    low, high, parts = np.zeros((tiles, dim), np.int64), np.zeros((tiles, dim), np.int64), np.zeros(tiles, np.int64)
    for r in least.collect():
        if r.k is not None:
            low[r.tile, r.k], high[r.tile, r.k] = r.low, r.high
        parts[r.tile] = -(-r.n // tile_rows)
    number = F.array(*(F.lit(int(p)) for p in parts)) if len(parts) else None
    salted = placed.withColumn("part", F.pmod(F.xxhash64("vec_id", "x"), F.greatest(number[F.col("tile")], F.lit(1))).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        vectors = _vectors(table.column("x").combine_chunks(), dim)
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        # The packing does not depend on the order in which rows arrive.
        order = np.lexsort((labels, ids))
        tree = RTree(ids[order], labels[order], vectors[order])
        return pa.table(
            {
                "tile": pa.array(table.column("tile").to_numpy()[:1]),
                "part": pa.array(table.column("part").to_numpy()[:1]),
                "ids": pa.array([tree.ids.astype("<i8").tobytes()]),
                "labels": pa.array([tree.labels.astype("<i8").tobytes()]),
                "vectors": pa.array([tree.vectors.astype("<i4").tobytes()]),
            }
        )

    packed = salted.groupBy("tile", "part").applyInArrow(pack, "tile int, part int, ids binary, labels binary, vectors binary")
    return Index(saved(packed), dim, low, high, parts)


# --- searches ---------------------------------------------------------------------------

ASK = "key binary, label bigint, x array<bigint>, lows array<bigint>, highs array<bigint>, floors array<bigint>"
FOUND = "key binary, high bigint, score bigint, vec_id bigint, equal boolean"


def _windows(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.array(batch.column(c)[i].as_py(), np.int64) for c in ("lows", "highs", "floors"))


def _routed(index: Index, asks: DataFrame, first: bool) -> DataFrame:
    """Asks with the (tile, part) to visit: those of the best tile, or those of all others that they can need."""
    dim, parts, tile_low, tile_high = index.dim, index.parts, index.low, index.high

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                low, high = bounds(_vectors(some.column("x"), dim), tile_low, tile_high)
                row, tile = [], []
                for i in range(some.num_rows):
                    lows, highs, floors = _windows(some, i)
                    least = np.maximum(lows, floors)
                    useful = ((low[i][:, None] <= highs) & (high[i][:, None] >= least) & (least <= highs)).any(axis=1)
                    useful &= parts > 0
                    # Chosen alike in both visits: it depends on the windows, not on the floors.
                    best = int(np.argmax(np.where(parts > 0, np.minimum(high[i], highs.max(initial=LOWEST)), LOWEST)))
                    chosen = np.flatnonzero(useful)
                    chosen = chosen[chosen == best] if first else chosen[chosen != best]
                    row.append(np.full(len(chosen), i))
                    tile.append(chosen)
                row, tile = np.concatenate(row).astype(np.int64), np.concatenate(tile).astype(np.int64)
                times = parts[tile]
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                sent = some.take(pa.array(np.repeat(row, times)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(tile, times).astype(np.int32)), pa.array(part.astype(np.int32)), *sent.columns],
                    ["tile", "part", *sent.schema.names],
                )

    return asks.mapInArrow(route, f"tile int, part int, {ASK}")


def _visited(index: Index, visits: DataFrame, same: bool, k: int) -> DataFrame:
    """What each visit finds. A task holds one packed part at a time, and streams the asks past it."""
    dim = index.dim
    trees = index.packed.withColumn("asks", F.lit(False))
    both = trees.unionByName(visits.withColumn("asks", F.lit(True)), allowMissingColumns=True)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            out: list[tuple] = []
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(asks[1:] != asks[:-1]) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(asks)]):
                if i == j:
                    continue
                if not asks[i]:  # the last of several trees is the one that has asks
                    ids, labels = (np.frombuffer(batch.column(c)[j - 1].as_py(), "<i8") for c in ("ids", "labels"))
                    vectors = np.frombuffer(batch.column("vectors")[j - 1].as_py(), "<i4").reshape(len(ids), dim)
                    tree = RTree(ids, labels, vectors.astype(np.int64), packed=True)
                    continue
                for start in range(i, j, 256):
                    some = batch.slice(start, min(256, j - start))
                    asked = _vectors(some.column("x"), dim)
                    low, high = bounds(asked, tree.low, tree.high)
                    for q in range(some.num_rows):
                        lows, highs, floors = _windows(some, q)
                        wanted = Wanted(some.column("label")[q].as_py(), same, lows, highs, floors)
                        key = some.column("key")[q].as_py()
                        for h, heap in zip(highs, tree.search(asked[q], low[q], high[q], wanted, k)):
                            out.extend((key, int(h), score, -minus, bool((tree.vectors[at] == asked[q]).all())) for score, minus, at in heap)
            columns = list(zip(*out)) or [[]] * 5
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "high", "score", "vec_id", "equal"])

    dealt = both.repartition(max(1, int(index.parts.sum())), "tile", "part").sortWithinPartitions("tile", "part", "asks")
    return dealt.mapInArrow(search, FOUND)


def best(index: Index, asks: DataFrame, same: bool, k: int) -> DataFrame:
    """(key, high, rank, score, vec_id, equal): the first k points of each window of asks (``ASK``), by score, then by vec_id.

    A window is named by its upper end. ``same`` wants points of the ask's label, otherwise those of others.
    ``equal`` tells a point with the ask's own vector.
    """
    asks = saved(asks)
    near = saved(_visited(index, _routed(index, asks, first=True), same, k))
    order = Window.partitionBy("key", "high").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    # At most one entry for each window of an ask.
    known = kth.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("high", "score"))).alias("known"))
    floors = F.transform("highs", lambda h: F.coalesce(F.try_element_at(F.col("known"), h), F.lit(LOWEST)))
    told = asks.join(known, "key", "left").withColumn("floors", floors).drop("known")
    far = _visited(index, _routed(index, told, first=False), same, k)
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint, positive_rank int"
)


def _mine(points: DataFrame, anchors: DataFrame, dim: int, positives: int, negatives: int, percent: int, tile_rows: int, max_tiles: int, sample: int) -> DataFrame:
    """As `hard_negatives`, for points and anchors (vec_id, label, x, key) of one dimension."""
    # Of rows with one vector and label only so many can be results; the limit applies before the shuffle.
    among = Window.partitionBy("key", "label").orderBy("vec_id")
    deep = max(positives + 1, negatives)
    members = points.withColumn("place", F.row_number().over(among)).where(F.col("place") <= deep)
    index = build_index(members, dim, tile_rows, max_tiles, sample)

    asked_by = saved(anchors.select(F.col("vec_id").alias("anchor_id"), "label", "x", F.sha2(F.concat_ws(":", F.hex("key"), "label"), 256).cast("binary").alias("key")))
    asks = asked_by.groupBy("key").agg(F.first("label").alias("label"), F.first("x").alias("x"))
    one = lambda v: F.array(F.lit(v).cast("bigint"))
    open_ = asks.select("key", "label", "x", one(LOWEST).alias("lows"), one(HIGHEST).alias("highs"), one(LOWEST).alias("floors"))
    near = saved(best(index, open_, same=True, k=positives + 1))
    # An anchor's own row is the one of its vec_id among those of its vector and label.
    own = (F.col("vec_id") == F.col("anchor_id")) & F.col("equal")
    of_anchor = Window.partitionBy("anchor_id", "key").orderBy("rank")
    positive = (
        asked_by.select("anchor_id", "key")
        .join(near.select("key", "rank", "vec_id", "score", "equal"), "key")
        .where(~own)
        .withColumn("positive_rank", F.row_number().over(of_anchor))
        .where(F.col("positive_rank") <= positives)
        .select("key", "anchor_id", "positive_rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    positive = saved(positive)
    # Rounded up: the quotient of a negative number is rounded towards zero.
    share, high = F.lit(percent) * F.col("positive_score"), F.col("positive_score")
    low = F.when(share > 0, F.call_function("div", share + F.lit(99), F.lit(100))).otherwise(F.call_function("div", share, F.lit(100)))
    windows = (
        positive.where(F.lit(percent) * F.col("positive_score") <= F.lit(100) * F.col("positive_score"))
        .select("key", low.cast("bigint").alias("low"), high.alias("high"))
        .distinct()
        .groupBy("key")
        .agg(F.collect_list(F.struct("low", "high")).alias("w"))  # one for each positive of the ask, at most
    )
    windowed = asks.join(windows, "key").select(
        "key", "label", "x", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"), F.transform("w", lambda w: F.lit(LOWEST)).alias("floors")
    )
    negative = best(index, windowed, same=False, k=negatives)
    return positive.join(negative.withColumnRenamed("high", "positive_score"), ["key", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
        F.col("positive_rank").cast("int"),
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    tile_rows: int = TILE_ROWS,
    max_tiles: int = MAX_TILES,
    sample: int = SAMPLE,
) -> DataFrame:
    """For each of anchors and its first ``positives`` others of its label: the first ``negatives`` rows of other labels within reach.

    Both have (vec_id, label, embedding). Components become floor(256 c); a score is the whole-number inner
    product with the anchor. Higher scores come first, ties by smaller vec_id. A negative is within reach of a
    positive if percent * positive_score <= 100 * negative_score <= 100 * positive_score. Gives (anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score, positive_rank); a positive without negatives gives no row.

    Rows without a vec_id or label, with a null vector, a null or non-finite component, or a vector longer than
    2^23 when scaled take no part. Vectors of another length are not compared. Rows equal in vec_id, label
    and vector count once; rows that share only the vec_id are different rows. Other columns are
    ignored; an empty table gives no rows.
    """

    def valid(df: DataFrame) -> DataFrame:
        x = whole_numbers(F.col("embedding"), SCALE, 0, LONGEST)
        typed = df.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), x.alias("x"))
        length = F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
        fine = typed.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (length <= LONGEST**2))
        return fine.withColumn("key", vector_key(F.col("x"))).dropDuplicates(["vec_id", "label", "key"]).withColumn("dim", F.size("x"))

    points, asked = saved(valid(vectors)), saved(valid(anchors))
    found = [
        _mine(points.where(F.col("dim") == d), asked.where(F.col("dim") == d), d, positives, negatives, percent, tile_rows, max_tiles, sample)
        for d in sorted(r.dim for r in asked.select("dim").distinct().collect())
    ]
    if not found:
        return vectors.sparkSession.createDataFrame([], RESULT)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
