import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from patchlens.llm import vantage_trees as vt


def plain_fingerprint(text, words=3):
    """Bit by bit, from the definition."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    parts = [w for w in text.split(" ") if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, distance=3):
    """Sorted (doc_id, fingerprint, component_id) by comparing all pairs."""
    bits = [plain_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= distance:
                up[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, f"{bits[k]:016x}", least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted((tuple(r) for r in vt.near_duplicates(df, **kw).collect()), key=str)


def near_texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 2, 3, 4, 9, 60, 300, 900]))]
        for _ in range(rng.randrange(1, 6)):
            t = list(base)
            if rng.random() < 0.7:
                t[rng.randrange(len(t))] = "other"
            out.append(rng.choice([" ", "\t ", "\n"]).join(t))
    rng.shuffle(out)
    return list(enumerate(out))


def test_components_equal_all_pairs(spark):
    rows = near_texts(1)
    want = expected(rows)
    assert found(spark, rows) == want
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some links are near, not equal


def test_small_shards_give_the_same(spark):
    rows = near_texts(2)
    assert found(spark, rows, shard=20, sample=90) == expected(rows)


def test_hash_is_that_of_the_session(spark):
    texts = ["a b c", "ünï 漢字 x", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h"))
    assert [r.h % 2**64 for r in df.collect()] == [vt.shingle_hashes(t.encode(), 3)[0] for t in texts]


def links_by_all_pairs(points, distance):
    return {
        (max(a, b), min(a, b))
        for i, a in enumerate(points)
        for b in points[:i]
        if (a ^ b).bit_count() <= distance
    }


def parts(pairs, points):
    up = {p: p for p in points}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[root(a)] = root(b)
    groups = {}
    for p in points:
        groups.setdefault(root(p), set()).add(p)
    return sorted(map(sorted, groups.values()))


def clustered(seed, n=1500):
    """Random fingerprints, many a few bits from another, and one dense cluster of a third of them."""
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(n // 3)]
    for _ in range(n // 3):
        p = rng.choice(points)
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            p ^= 1 << b
        points.append(p)
    centre = rng.getrandbits(64)
    for _ in range(n // 3):
        p = centre
        for b in rng.sample(range(64), rng.randrange(9)):
            p ^= 1 << b
        points.append(p)
    return sorted(set(points))


@pytest.mark.parametrize("distance, shard", [(0, 100), (1, 64), (3, 64), (3, 10_000), (7, 300)])
def test_links_connect_what_all_pairs_connect(spark, distance, shard):
    points = clustered(distance)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "bits bigint").repartition(4)
    rows = vt.fingerprint_links(df, distance, shard=shard, sample=600).collect()
    got = [(r.a % 2**64, r.b % 2**64) for r in rows]
    assert len(got) <= 20 * len(points)
    assert parts(got, points) == parts(links_by_all_pairs(points, distance), points)


@pytest.mark.parametrize("half", [0, 1])
@pytest.mark.parametrize("radius", [0, 1, 3])
def test_a_tree_prunes_and_loses_nothing(half, radius):
    rng = np.random.default_rng(half + radius)
    points = np.unique(rng.integers(0, 2**64, 4000, np.uint64))
    mask = vt.HALVES[half]
    root, leaves = vt.grow(points, mask, radius, 50)
    assert sorted(np.concatenate([x.points for x in leaves]).tolist()) == list(range(len(points)))
    assert max(len(x.points) for x in leaves) <= 50 or radius == 3
    asked = points[:200] ^ np.uint64((1 << 40 | 1 << 3) if radius else 0)
    met = {(int(q), int(p)) for leaf, at in vt.descend(root, asked, mask, radius) for q in at for p in leaf.points}
    for q, value in enumerate(asked):
        near = np.flatnonzero(np.bitwise_count((points ^ value) & mask) <= radius)
        assert all((q, int(p)) in met for p in near)
    if radius < 2:
        assert len(met) < 0.25 * len(asked) * len(points)


def test_bit_counts():
    rng = np.random.default_rng(5)
    for n in (1, 254, 255, 256, 1000):
        hashes = rng.integers(0, 2**64, n, np.uint64)
        assert vt.bit_counts(hashes).tolist() == [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


def test_edge_cases(spark):
    long = " ".join(f"v{k % 700}" for k in range(200_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (5, "ONE"), (6, "one two"), (None, "one two"),
        (None, None), (7, "Straße É"), (8, "straße É"), (9, long), (10, long + " end"), (None, "alone here"), (11, " "),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "a b", 7, "x", 3)], "doc_id int, text string, bits int, component string, least int")
    assert vt.near_duplicates(df).columns == ["doc_id", "fingerprint", "component_id"] and vt.near_duplicates(df).count() == 1
