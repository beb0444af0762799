"""Near duplicates by SimHash fingerprints, linked through vantage-point trees.

A fingerprint has 64 bits. Two that differ in at most ``distance`` bits differ in at most half as
many within one of their two 32-bit halves, so each half has a tree over the Hamming distance
within it, of radius ``distance // 2``. A node of a tree is a vantage point and a bound: what lies
within the bound of the vantage point is inside, the rest outside. By the triangle inequality a
query needs a side only if its own distance to the vantage point is within the radius of it.

The upper levels of both trees cut all fingerprints in shards. A fingerprint is stored in one
shard, its home, and asks in every shard that its ball overlaps. Each shard builds the lower levels
over its homes, and compares what is left in all 64 bits.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.components import components
from patchlens.llm.scratch import saved
from patchlens.llm.textblocks import text_bytes

SEED = 42
#: Fingerprints that place the vantage points and bounds of the upper levels, about, at most.
SAMPLE = 65_536
#: Home fingerprints of a shard, about.
SHARD = 16_384
#: Fingerprints of a leaf of the lower levels, at most, if the vantage points still part them.
LEAF = 48
#: A split that leaves more than this share of queries on both sides prunes too little.
FUTILE = 0.7
#: Hashes, or comparisons, done at once in a task.
STEP = 1 << 20

U64 = np.uint64
HALVES = (U64(0xFFFFFFFF00000000), U64(0x00000000FFFFFFFF))


# --- fingerprints ---------------------------------------------------------------


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of the word shingles of a text, repeats included; of all words if they are fewer."""
    parts = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not parts:
        return []
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(words, len(parts)) - 1 :].tolist()
    of = xxhash.xxh64_intdigest
    return [of(line[a:b], SEED) for a, b in zip(starts.tolist(), last)]


_LOW_BITS = U64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """[bit] how many hashes have the bit, lowest first. Eight counters of one byte share a word."""
    rows = -(-len(hashes) // 255)
    padded = np.zeros((rows, 255), U64)
    padded.ravel()[: len(hashes)] = hashes
    out = np.zeros(64, np.int64)
    for j in range(8):
        sums = ((padded >> U64(j)) & _LOW_BITS).sum(axis=1, dtype=U64)
        out[j::8] = sums.astype("<u8").view(np.uint8).reshape(rows, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: bytes, words: int) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; 0 without words."""
    hashes = shingle_hashes(text, words)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), STEP):
        counts += bit_counts(np.array(hashes[at : at + STEP], U64))
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, bits) for each row of docs (doc_id, text); bits is the fingerprint as a signed number."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            bits = np.array([fingerprint(t, words) for t in texts], U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits)], ["doc_id", "bits"])

    typed = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return typed.mapInArrow(measure, "doc_id bigint, bits bigint")


# --- trees ------------------------------------------------------------------------


def _apart(a: np.ndarray, b: np.ndarray, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask).astype(np.int16)


@dataclass
class Node:
    """A vantage point with its inside and outside, or, without one, a leaf."""

    vantage: np.uint64 | None = None
    bound: int = 0
    inside: "Node | None" = None
    outside: "Node | None" = None
    #: Of a leaf: its number, and which of the given points it holds.
    leaf: int = -1
    points: np.ndarray | None = None


def grow(points: np.ndarray, mask: np.uint64, radius: int, most: int) -> tuple[Node, list[Node]]:
    """A vantage-point tree over distinct points whose leaves hold at most ``most``, and its leaves.

    A vantage point is the one of eight that leaves the fewest points in reach of both sides. Where even
    that leaves more than FUTILE of them, the node stays a larger leaf.
    """
    leaves: list[Node] = []
    rng = np.random.default_rng(len(points))

    def build(at: np.ndarray) -> Node:
        best = None
        if len(at) > most:
            mine = points[at]
            for v in mine[rng.integers(0, len(mine), 8)]:
                d = _apart(mine, v, mask)
                count = np.bincount(d, minlength=66)
                upto = np.cumsum(count)
                bound = int(np.searchsorted(upto, len(mine) / 2))
                for b in {max(bound - 1, 0), bound}:
                    if 0 < upto[b] < len(mine):
                        # Queries are taken to lie as the points do.
                        both = upto[min(b + radius, 65)] - (upto[b - radius] if b >= radius else 0)
                        uneven = max(upto[b], len(mine) - upto[b]) / len(mine)
                        found = (both / len(mine) + uneven, both / len(mine), v, b, d)
                        if best is None or found[0] < best[0]:
                            best = found
        if best is None or best[1] > FUTILE:
            node = Node(leaf=len(leaves), points=at)
            leaves.append(node)
            return node
        _, _, v, b, d = best
        return Node(v, b, build(at[d <= b]), build(at[d > b]))

    return build(np.arange(len(points))), leaves


def descend(root: Node, asked: np.ndarray, mask: np.uint64, radius: int) -> Iterator[tuple[Node, np.ndarray]]:
    """(leaf, indices of asked) for each leaf that some balls of ``radius`` overlap; 0 gives the home leaf."""
    open_ = [(root, np.arange(len(asked)))]
    while open_:
        node, at = open_.pop()
        if not len(at):
            continue
        if node.vantage is None:
            yield node, at
            continue
        d = _apart(asked[at], node.vantage, mask)
        open_.append((node.inside, at[d <= node.bound + radius]))
        open_.append((node.outside, at[d > node.bound - radius]))


class Shard:
    """The homes of a shard, their lower tree, and which of them are linked."""

    def __init__(self, homes: np.ndarray, mask: np.uint64, distance: int):
        self.homes, self.mask, self.distance = homes, mask, distance
        self.root, _ = grow(homes, mask, distance // 2, LEAF)
        self.label = np.arange(len(homes))

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.label[at]
        while (self.label[up] != up).any():
            up = self.label[up]
        return up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))

    def ask(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked, home) fingerprints of the first home linked to each of asked; its other homes are united.

        A pair is met from its greater fingerprint only.
        """
        first = np.full(len(asked), -1)
        for leaf, at in descend(self.root, asked, self.mask, self.distance // 2):
            mine = self.homes[leaf.points]
            # A leaf that no vantage point could part is met in bounded tiles as well.
            for h in range(0, len(mine), STEP >> 8):
                some = mine[h : h + (STEP >> 8)]
                wide = max(1, STEP // len(some))
                for i in range(0, len(at), wide):
                    block = at[i : i + wide]
                    q = asked[block][:, None]
                    met, k = np.nonzero((np.bitwise_count(q ^ some) <= self.distance) & (some < q))
                    if len(met):
                        who, home = block[met], leaf.points[h + k]
                        new = first[who] < 0
                        first[who[new]] = home[new]  # of several, one
                        self.unite(first[who], home)
        has = np.flatnonzero(first >= 0)
        return asked[has], self.homes[first[has]]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        every = np.arange(len(self.homes))
        up = self.roots(every)
        joined = up != every
        return self.homes[joined], self.homes[up[joined]]


# --- linking at scale ----------------------------------------------------------------


def upper_trees(points: DataFrame, n: int, distance: int, shard: int, sample: int) -> tuple[list[tuple[Node, list[int]]], int]:
    """For each half a tree and the parts of each of its leaves, so that a part holds about ``shard`` of the n points.

    Built on the driver from about ``sample`` points at most, chosen by their hash. Where the
    points lie so close that no vantage point parts them, the leaf is cut in several parts.
    """
    share = -(-n // sample) or 1
    rows = points.where(F.pmod(F.xxhash64("bits", F.lit(1)), F.lit(share)) == 0).select("bits").collect()
    some = np.sort(np.array([r.bits for r in rows], np.int64)).view(U64)
    stands_for = n / max(len(some), 1)
    each = max(8, int(shard / max(stands_for, 1)))
    trees, parts = [], 0
    for mask in HALVES:
        root, leaves = grow(some, mask, distance // 2, each)
        of = [max(1, round(len(x.points) * stands_for / shard)) for x in leaves]
        for x in leaves:
            x.points = None
        trees.append((root, (np.cumsum([0, *of]) + parts).tolist()))
        parts += sum(of)
    return trees, parts


def _dealt(points: DataFrame, trees: list[tuple[Node, list[int]]], distance: int) -> DataFrame:
    """(shard, asks, bits): each point once for each half as a home, and once for each part its ball overlaps."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy().view(U64)
            spread = bits * U64(0x9E3779B97F4A7C15) >> U64(32)
            for (root, first), mask in zip(trees, HALVES):
                for asks, radius in ((False, 0), (True, distance // 2)):
                    for leaf, at in descend(root, bits, mask, radius):
                        a, b = first[leaf.leaf], first[leaf.leaf + 1]
                        where = [a + (spread[at] % U64(b - a)).astype(np.int32)] if not asks else [np.full(len(at), s) for s in range(a, b)]
                        for shard in where:
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(shard.astype(np.int32)),
                                    pa.array(np.full(len(at), asks)),
                                    pa.array(bits[at].view(np.int64)),
                                ],
                                ["shard", "asks", "bits"],
                            )

    return points.mapInArrow(deal, "shard int, asks boolean, bits bigint")


def fingerprint_links(points: DataFrame, distance: int = 3, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(a, b): links between distinct fingerprints (bits) that connect whatever is within ``distance`` bits.

    Not every linked pair is listed: a shard gives each asking fingerprint one partner and joins the
    others to that one, so a group of any size gives about as many rows as it has members.
    """
    n = points.count()
    trees, shards = upper_trees(points, n, distance, shard, sample)
    first_of_second = trees[1][1][0]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        current, homes, here = None, [], None
        for batch in batches:
            number = batch.column("shard").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            bits = batch.column("bits").to_numpy().view(U64)
            # Rows come sorted by shard, homes first.
            edges = np.flatnonzero((number[1:] != number[:-1]) | (asks[1:] != asks[:-1])) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(bits)]):
                if i == j:
                    continue
                if number[i] != current:
                    if here is not None:
                        yield rows(*here.links())
                    current, homes, here = number[i], [], None
                if not asks[i]:
                    homes.append(bits[i:j])
                    continue
                if here is None and homes:
                    here = Shard(np.concatenate(homes), HALVES[int(current >= first_of_second)], distance)
                if here is not None:
                    yield rows(*here.ask(bits[i:j]))
        if here is not None:
            yield rows(*here.links())

    dealt = _dealt(points, trees, distance)
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard", "asks").mapInArrow(search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text); other columns are ignored.

    Two rows are linked if their fingerprints differ in at most ``distance`` bits; component_id is the
    smallest doc_id that links reach. Words are runs of anything but ASCII white space, A-Z lowered.
    A null or empty text has fingerprint zero and is linked like any other. Rows without a doc_id
    link too; component_id is null where all of a component lack one. Repeated rows give repeated
    results; an empty table gives no rows.
    """
    measured = saved(fingerprints(docs, words))
    # Copies are one point, cut to one row in each task before the shuffle.
    points = saved(measured.groupBy("bits").agg(F.min("doc_id").alias("least")))
    label = components(saved(fingerprint_links(points.select("bits"), distance, shard, sample)))
    named = points.join(label.withColumnRenamed("node", "bits"), "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = saved(named.join(smallest, "component").select("bits", "component_id"))
    return measured.join(of, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
