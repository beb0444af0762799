import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from patchlens.llm import whitening


def scaled(v):
    if not v or any(c is None or not math.isfinite(c) for c in v):
        return None
    return tuple(math.floor(64 * c) + 1000000 for c in v)


def expected(rows, weights="counts"):
    """{vec_id: [(n, deviation, [|whitened|], [explained])]} from the definition, by numpy."""
    kept = [(i, scaled(v)) for i, v in rows if scaled(v)]
    listed = [x for _, x in kept]
    if weights == "one":
        listed = sorted(set(listed))
    n = len(listed)
    sums = [sum(x[k] for x in listed) for k in range(len(listed[0]))]
    c = np.array([[float(a * n - s) / n for a, s in zip(x, sums)] for x in listed])
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = defaultdict(list)
    for i, x in kept:
        z = np.array([float(a * n - s) / n for a, s in zip(x, sums)]) @ axes / np.sqrt(values)
        out[i].append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), np.abs(z), values / values.sum()))
    return out


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    out = whitening.whiten(df, **kw)
    assert out.schema.simpleString() == "struct<" + whitening.RESULT.replace(", ", ",").replace(" ", ":") + ">"
    return out.collect()


def check(got, want, components):
    held = Counter((r.vec_id, r.component) for r in got)
    assert set(held.values()) <= {len(want[i]) for i in want}
    assert {i for i, _ in held} == set(want)
    for r in got:
        n, deviation, z, explained = want[r.vec_id][0]
        k = r.component - 1
        assert r.n == n and r.deviation == deviation
        assert abs(r.whitened) == pytest.approx(z[k], rel=1e-7, abs=1e-9)
        assert r.explained == pytest.approx(explained[k], rel=1e-8)
        assert r.identity_error < 1e-9
    assert max(r.component for r in got) == components


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_equals_the_definition(spark, weights):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=40) * np.linspace(1, 4, 40) + 3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(2000 + i, rows[i % 5][1]) for i in range(40)]
    want = expected(rows, weights)
    got = found(spark, rows, weights=weights)
    check(got, want, 32)
    assert len(got) == 32 * len(rows)
    # One sign for all rows: the products of components agree too.
    z = np.array([[r.whitened for r in sorted(got, key=lambda r: r.component) if r.vec_id == i] for i in (1, 2, 3)])
    c = np.array([scaled(v) for _, v in rows[1:4]], float)
    assert np.linalg.matrix_rank(z) == np.linalg.matrix_rank(c - c.mean()) == 3


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(whitening.whiten(df).collect(), expected(rows), 32)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1e300, 1.0])]
    assert found(spark, bad) == []
    assert found(spark, []) == []
    # Entries below a 64th are rounded down; repeated rows and rows without an id count.
    rows = bad + [(7, [0.0, 1.0]), (7, [0.0, 1.0]), (None, [-0.001, 2.0]), (8, [2.0, -5.5])]
    check(found(spark, rows), expected([r for r in rows if r[0] != 6]), 2)
    # A direction without variance, one row alone, and lengths that are fits of their own.
    flat = {(r.vec_id, r.component): r for r in found(spark, [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (9, [1.0])])}
    assert flat[1, 1].explained == 1 and abs(flat[1, 1].whitened) == pytest.approx(1)
    assert flat[1, 2].whitened is None and flat[1, 2].n == 2 and flat[1, 1].identity_error < 1e-12
    assert flat[9, 1].n == 1 and flat[9, 1].deviation == 0
    assert flat[9, 1].whitened is None and flat[9, 1].explained is None and flat[9, 1].identity_error is None


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0**30, 0.0]), (2, [-(2.0**30), 1.0]), (3, [2.0**20, 3.0])]
    want = expected(rows)
    got = found(spark, rows)
    for r in got:
        deviation = want[r.vec_id][0][1]
        assert r.deviation == (deviation if deviation < 2**63 else None)
        if r.component == 1:  # beside it the other direction is below rounding
            assert abs(r.whitened) == pytest.approx(want[r.vec_id][0][2][0], rel=1e-6)
    assert any(r.deviation is None for r in got)


def test_extra_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, [1.0], "a", 2, b"x"), (2, [3.0], "b", 4, b"y")], "vec_id int, embedding array<float>, x string, n int, key binary")
    assert sorted((r.vec_id, round(abs(r.whitened), 9), r.n) for r in whitening.whiten(df).collect()) == [(1, 1.0, 2), (2, 1.0, 2)]
