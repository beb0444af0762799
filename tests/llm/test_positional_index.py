import random
import re

import pyarrow.parquet as pq
import pytest

from patchlens.llm import positional_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, size=13):
    """(doc_id, n_words, n_hit, items, contaminated) by looking every window up at every place."""
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, met = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    met |= found
        out.append((d, len(w), len(hit), sorted(map(str, met)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(1)
    text = lambda n: [rng.choice(["the", "Of", "été", "x1", "and", "b", f"w{rng.randrange(60)}"]) for _ in range(n)]
    items = [text(rng.choice([0, 1, 2, 12, 13, 14, 40])) for _ in range(30)]
    docs = []
    for _ in range(80):
        parts = text(rng.randrange(60))
        if rng.random() < 0.6:
            item = rng.choice(items)
            a = rng.randrange(len(item) + 1)
            parts += item[a : a + rng.randrange(30)] + text(rng.randrange(40))
        docs.append(rng.choice([" ", ", ", "\n"]).join(parts))
    docs += [None, "", "...", "the " * 60_000]
    items = [(k, " ".join(x)) for k, x in enumerate(items)] + [(90, None), (91, ""), (None, "x1 b"), (3, "x1 b")]
    return [*enumerate(docs), (5, docs[5]), (None, docs[7])], items


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    rows = positional_index.contamination(d, spark.createDataFrame(items, "item_id bigint, text string"))
    out = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in rows.collect()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("query_bytes", [32 << 20, 300])
def test_equals_brute_force(spark, tables, monkeypatch, query_bytes):
    monkeypatch.setattr(positional_index, "QUERY_BYTES", query_bytes)
    assert found(spark, *tables) == expected(*tables)


def test_empty_tables(spark, tables):
    assert found(spark, [], tables[1]) == []
    assert all(r[2:] == (0, [], False) for r in found(spark, tables[0], []))


def test_near_hits(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(50))) for k in range(20)]
    items = [(1, "a b c"), (2, "h h g"), (3, "zz a"), (4, "")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    index = positional_index.build_index(d)
    got = positional_index.near_hits(index, spark.createDataFrame(items, "item_id bigint, text string"), 5)
    want = set()
    for i, t in docs:
        w = words(t)
        for item, q in items:
            terms = set(words(q))
            for s in range(len(w)):
                if terms and w[s] in terms and terms <= set(w[s : s + 5]):
                    want.add((i, item, s))
    # A stretch is reported if it holds the rarest term, which every full one does.
    assert {tuple(r) for r in got.collect()} == want


def test_clean_keeps_columns_and_equal_texts_together(spark, tables):
    docs, items = tables
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, items string")
    kept = positional_index.clean(d, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == d.columns
    good = [r[0] for r in expected(docs, items) if not r[4]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(good, key=repr)


@pytest.mark.parametrize("n", [1024, 4096])
def test_structured_words_are_told_apart(spark, n):
    bits = [bin(k).count("1") % 2 for k in range(n)]
    one, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    docs, items = [(1, one), (2, other)], [(7, one)]
    assert found(spark, docs, items) == expected(docs, items)
    assert [r[2] for r in found(spark, docs, items)] == [1, 0]


def test_a_row_of_the_index_is_read_alone(spark):
    rows = [(k, f"word{k} " * 5) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        stored = positional_index.build_index(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert stored.count() == 12
    for file in stored.inputFiles():
        footer = pq.ParquetFile(file.removeprefix("file:")).metadata
        assert all(footer.row_group(k).num_rows == 1 for k in range(footer.num_row_groups))


def test_windows_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "d e f"), (3, "x")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(["a b c", "b c d", "d e f", "e f g", "c"])], "item_id bigint, text string")
    whole = sorted(map(tuple, positional_index.phrase_hits(positional_index.build_index(docs), asked, 3).collect()))
    monkeypatch.setattr(positional_index, "WINDOWS", 1)
    assert sorted(map(tuple, positional_index.phrase_hits(positional_index.build_index(docs), asked, 3).collect())) == whole
    assert [(r[0], sorted(r[3])) for r in whole] == [(1, [0, 1, 2, 4]), (2, [2]), (3, [])]
