import math

import numpy as np

from patchlens.llm import lsh_forest


def exact(rows, asked, k=5):
    """{query id: [(vec_id, score)]} by scoring everything."""

    def fine(v):
        return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    pool = {(i, tuple(v)) for i, v in rows if i is not None and fine(v)}
    out = {}
    for i, v in pool:
        if i in asked:
            q = np.array(v)
            scored = [
                (-float(np.dot(q, w) / (np.linalg.norm(q) * np.linalg.norm(w))), j)
                for j, w in pool
                if j != i and len(w) == len(v)
            ]
            out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scored)[:k]]
    return out


def found(spark, rows, asked, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    out = {}
    for r in lsh_forest.nearest(df, df.where(df.vec_id.isin(list(asked))), **kw).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in out.items()}


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(40)]  # groups of equal vectors
    asked = {0, 5, 50, 1000, 1003, 1039}
    got, want = found(spark, rows, asked), exact(rows, asked)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_recall_on_given_vectors(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "SHARD_ROWS", 2000)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    asked = {i for i, _ in rows if i % 50 == 0}
    got, want = found(spark, rows, asked, least=100), exact(rows, asked)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_descent_and_ascent():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 16))
    forest = lsh_forest.Forest(points, trees=4)
    codes = lsh_forest.hash_strings(points, trees=4)
    assert (np.diff(forest.codes.astype(object), axis=1) >= 0).all()
    asked = lsh_forest.hash_strings(rng.normal(size=(20, 16)), trees=4)

    def shared(a, b):
        return 64 - int(a ^ b).bit_length()

    assert forest.longest(asked).tolist() == [
        max(shared(asked[t, j], c) for t in range(4) for c in codes[t]) for j in range(20)
    ]
    for j, met in enumerate(forest.candidates(asked, 60)):
        depth = [max(shared(asked[t, j], codes[t, p]) for t in range(4)) for p in range(500)]
        level = max(x for x in range(65) if sum(d >= x for d in depth) >= 60)
        assert met.tolist() == [p for p in range(500) if depth[p] >= level]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [0.0, 3.0]), (10, [1.0, 0.0, 0.0]),
    ]
    got = found(spark, rows, set(range(11)))
    assert got == {7: [(8, 1.0), (9, 0.0)], 8: [(7, 1.0), (9, 0.0)], 9: [(7, 0.0), (8, 0.0)]}
    assert found(spark, [], {1}) == {}


def test_very_large_and_very_small_vectors(spark):
    big, small = 2.0**600, 2.0**-600
    rows = [(1, [big, big]), (2, [big, 0.0]), (3, [1.0, 1.0]), (4, [small, small]), (5, [5e-324, 0.0]), (6, [0.0, -1.7e308])]
    got = found(spark, rows, {1, 4, 5, 6})
    half = math.sqrt(0.5)
    assert [[i for i, _ in got[q]] for q in (1, 4, 5, 6)] == [[3, 4, 2, 5, 6], [1, 3, 2, 5, 6], [2, 1, 3, 4, 6], [2, 5, 1, 3, 4]]
    assert np.allclose([s for _, s in got[1]], [1, 1, half, half, -half])
    assert np.allclose([s for _, s in got[5]], [1, half, half, half, 0])
