import math

import numpy as np
import pytest

from patchlens.llm import rtree

SCHEMA = "vec_id bigint, label bigint, embedding array<double>"


def expected(rows, asked, positives=5, negatives=5, percent=80):
    """Rows by scoring everything, in whole numbers."""

    def fine(r):
        i, label, v = r
        return i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)

    pool = sorted({(i, label, tuple(math.floor(256 * c) for c in v)) for i, label, v in filter(fine, rows)})
    out = []
    for a in pool:
        if a[0] not in asked:
            continue
        scored = [(-sum(p * q for p, q in zip(a[2], b[2])), b[0], b[1] == a[1]) for b in pool if b != a and len(b[2]) == len(a[2])]
        first = sorted((s, i) for s, i, same in scored if same)[:positives]
        for p, (minus, i) in enumerate(first):
            ps = -minus
            near = sorted((s, j) for s, j, same in scored if not same and percent * ps <= -100 * s <= 100 * ps)[:negatives]
            out += [(a[0], i, r + 1, j, ps, -s, p + 1) for r, (s, j) in enumerate(near)]
    return sorted(out)


def found(spark, rows, asked, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = rtree.hard_negatives(df, df.where(df.vec_id.isin(list(asked))), **kw)
    assert out.schema.simpleString() == "struct<" + rtree.RESULT.replace(", ", ",").replace(" ", ":") + ">"
    return sorted(tuple(r) for r in out.collect())


def vectors(seed, n, dim, labels=4, around=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(around, dim))
    return [
        (i, int(rng.integers(labels)), (centres[rng.integers(around)] + rng.normal(size=dim) * 0.4).round(2).tolist())
        for i in range(n)
    ]


@pytest.mark.parametrize("dim, tiles", [(1, {}), (3, {"tile_rows": 90, "sample": 200}), (24, {"tile_rows": 60, "max_tiles": 3})])
def test_equals_all_pairs(spark, dim, tiles):
    rows = vectors(dim, 700, dim)
    rows += [(1000 + i, rows[i % 4][1] if i % 3 else 9, rows[i % 4][2]) for i in range(60)]  # equal vectors, many ties
    asked = {0, 1, 2, 3, 77, 500, 1000, 1004, 1030}
    want = expected(rows, asked)
    assert len(want) > 20
    assert found(spark, rows, asked, **tiles) == want


def test_other_sizes_and_windows(spark):
    rows = vectors(9, 400, 6, labels=2)
    asked = {5, 10, 399}
    for kw in ({"positives": 1, "negatives": 9}, {"positives": 3, "negatives": 1, "percent": 95}, {"percent": 0}):
        assert found(spark, rows, asked, tile_rows=100, **kw) == expected(rows, asked, **kw)


def test_packing_and_bounds():
    rng = np.random.default_rng(3)
    points = rng.integers(-500, 500, (1000, 3))
    order = rtree.str_order(points, 10)
    assert sorted(order.tolist()) == list(range(1000))
    leaves = order.reshape(100, 10)
    # Of three coordinates, 100 leaves make slabs of 5 x 5 x 4: boxes are far smaller than those of rows in any order.
    size = lambda groups: np.mean([np.ptp(points[g], axis=0).prod() for g in groups])
    assert size(leaves) < 0.1 * size(np.arange(1000).reshape(100, 10))
    tree = rtree.RTree(np.arange(1000), rng.integers(0, 5, 1000), points)
    asked = rng.integers(-500, 500, (20, 3))
    low, high = rtree.bounds(asked, tree.low, tree.high)
    scores = asked @ tree.vectors.T
    for node in range(tree.leaves):
        a, b = tree.span[node]
        assert (low[:, node] <= scores[:, a:b].min(axis=1)).all() and (high[:, node] >= scores[:, a:b].max(axis=1)).all()
    assert (high[:, -1] >= scores.max(axis=1)).all() and tree.leaves == 8 and len(tree.span) == 9


def test_search_prunes_boxes(monkeypatch):
    rng = np.random.default_rng(4)
    points = rng.integers(-500, 500, (4000, 2))
    monkeypatch.setattr(rtree, "LEAF", 32)
    tree = rtree.RTree(np.arange(4000), np.zeros(4000, int), points[(order := rtree.str_order(points, 32))], packed=True)
    assert sorted(order.tolist()) == list(range(4000)) and len(tree.span) == 125 + 8 + 1
    taken = []
    real = rtree.heapq.heappop
    monkeypatch.setattr(rtree.heapq, "heappop", lambda q: taken.append(1) or real(q))
    low, high = rtree.bounds(np.array([[3, 4]]), tree.low, tree.high)
    one = lambda v: np.array([v])
    scores = tree.vectors @ np.array([3, 4])
    for top in (10_000, 700, -900):
        taken.clear()
        heap = tree.search(np.array([3, 4]), low[0], high[0], rtree.Wanted(0, True, one(rtree.LOWEST), one(top), one(rtree.LOWEST)), 5)
        assert sorted((-s, -i) for s, i, _ in heap[0]) == sorted((-s, i) for s, i in zip(scores.tolist(), tree.ids.tolist()) if s <= top)[:5]
        assert len(taken) < 0.4 * len(tree.span)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    bad = [
        (None, 1, [1.0, 1.0]), (20, None, [1.0, 1.0]), (21, 1, None), (22, 1, [nan, 1.0]), (23, 1, [inf, 1.0]),
        (24, 1, [None, 1.0]), (25, 1, []), (26, 2, []), (27, 1, [1.0]),
    ]
    everything = set(range(40))
    assert found(spark, bad, everything) == expected(bad, everything)
    assert found(spark, [], everything) == []
    # Repeated rows count once, rows that share an id do not; scores of zero and below have no or exact windows.
    rows = bad + [
        (1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [0.95, 0.0]), (2, 1, [0.9, 0.0]), (3, 2, [0.85, 0.0]), (3, 2, [0.85, 0.0]),
        (4, 1, [-1.0, 0.0]), (5, 3, [0.0, 0.0]), (6, 1, [0.0, 1.0]), (7, 2, [0.0, 2.0]), (7, 3, [0.9, 0.0]), (8, 2, [0.8, 0.1]),
    ]
    assert found(spark, rows, everything) == expected(rows, everything)
    assert found(spark, [(1, 1, [1e9, 0.0]), (2, 1, [1.0, 0.0]), (3, 2, [1.0, 0.0])], {1, 2}) == []


def test_extra_columns_are_ignored(spark):
    rows = [(i, i % 2, [1.0 - i / 100, 0.5], "k", i, 3) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA + ", key string, x int, tile int")
    got = rtree.hard_negatives(df, df.where("vec_id = 10")).collect()
    assert sorted(tuple(r) for r in got) == expected([r[:3] for r in rows], {10})
