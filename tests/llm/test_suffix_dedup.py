import random
from collections import Counter

import numpy as np
import pytest

from patchlens.llm import suffix_dedup


def expected(rows, window=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept) from a count of all windows."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + window] for _, t in data for k in range(len(t) - window + 1))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - window + 1):
            if seen[t[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = suffix_dedup.remove_repeats(df).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in kept), key=repr)


def texts(seed, n=40):
    """Texts that share passages of 150 to 400 bytes between and within themselves, with changed bytes."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß ") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(90))[: rng.randrange(150, 400)] for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1 :]
            parts += [p[rng.randrange(30) :], " ".join(word() for _ in range(rng.randrange(40)))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("alphabet", [3, 4096])
def test_suffix_array_is_sorted(alphabet, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ALPHABET", alphabet)
    rng = random.Random(alphabet)
    for _ in range(150):
        symbols = rng.choice([1, 2, 3, 9])
        text = [rng.randrange(1, symbols + 1) for _ in range(rng.randrange(1, 80))] + [0]
        assert suffix_dedup.suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda k: text[k:])


def test_equals_brute_force(spark):
    rows = list(enumerate(texts(1)))
    assert found(spark, rows) == expected(rows)


def test_anchors_of_many_segments_are_compared_by_hash(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", 1)
    rows = list(enumerate(texts(2)))
    assert found(spark, rows) == expected(rows)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rows = list(enumerate(texts(3, 20)))
    assert found(spark, rows) == expected(rows)


def test_edge_cases(spark):
    same = "x" * 500
    rows = [
        (1, None), (2, ""), (3, "a" * 199), (4, "a" * 199), (5, "b" * 200), (6, "b" * 201), (7, same), (7, same),
        (8, "é" * 150), (9, "é" * 150), (10, "ab" * 300), (None, "c" * 220),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_copies_of_a_text_give_a_segment_once(spark):
    docs = spark.createDataFrame([(k % 2, f"{k % 2}" + "abc" * 100) for k in range(80)], "key bigint, text string").repartition(3)
    wanted = spark.createDataFrame(
        [(0, 5, False, 3, 10, True), (1, 5, False, 3, 10, True), (1, 6, True, 20, 4, False)],
        "key bigint, anchor bigint, many boolean, start bigint, windows int, single boolean",
    )
    got = suffix_dedup._with_bytes(docs, wanted, 200).collect()
    assert sorted((r.key, r.anchor, r.start, len(r.bytes)) for r in got) == [(0, 5, 3, 209), (1, 5, 3, 209), (1, 6, 20, 203)]


@pytest.mark.parametrize("tasks", [1, 3])
def test_many_copies_and_near_copies(spark, tasks):
    base = texts(4, 1)[0] + "".join(map(str, range(300)))
    rows = [(k, base) for k in range(60)] + [(100, base[:400] + "#" + base[400:]), (101, base + "end")] + list(enumerate(texts(5, 10), 200))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(tasks)
    kept = suffix_dedup.remove_repeats(df).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in kept), key=repr) == expected(rows)
