import functools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from patchlens.llm import textblocks as tb
from patchlens.llm import toxicity


def test_response_equals_a_plain_convolution():
    rng = np.random.default_rng(1)
    net = toxicity.ConvNet(bits=6, half=3, filters=2)
    net.bias[:] = rng.normal(size=len(net.bias))
    texts = [rng.integers(0, 2**60, n).astype(np.uint64) for n in (0, 1, 2, 7)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = net.logits(np.concatenate(texts), bounds)
    for k, text in enumerate(texts):
        rows = net.buckets(text)
        vectors = [np.concatenate([net.tables[0][a], net.tables[1][b]]) for a, b in rows.T]
        zero = np.zeros(6)
        features, column = [], 0
        for w, width in enumerate(toxicity.WIDTHS):
            kernel = net.kernel[:, column * 2 : (column + width) * 2]
            column += width
            best = np.full(2, -np.inf)
            for s in range(max(1, len(vectors))):
                window = [vectors[s + j] if s + j < len(vectors) else zero for j in range(width)]
                best = np.maximum(best, sum(v @ kernel[:, 2 * j : 2 * j + 2] for j, v in enumerate(window)))
            features.append(best + net.bias[2 * w : 2 * w + 2])
        assert np.isclose(got[k], np.maximum(np.concatenate(features), 0) @ net.out + net.base, atol=1e-4)


def test_threshold_has_the_best_f1():
    rng = np.random.default_rng(2)
    logits = np.round(rng.normal(size=60), 1)
    labels = (logits + rng.normal(size=60) > 0.8).astype(int)

    def f1(cut):
        hit = logits >= cut
        return 2 * (hit & (labels == 1)).sum() / (hit.sum() + labels.sum())

    assert f1(toxicity.threshold(logits, labels)) == max(f1(x) for x in logits)


def planted(n):
    rng = random.Random(3)
    docs, labels = [], []
    for k in range(n):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(5, 120))]
        toxic = rng.random() < 0.25
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(["vile", "Scum!", "moronic"])
        docs.append((k, " ".join(words), rng.choice(["en", "fr"])))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_rows_and_edge_cases(spark):
    docs, labels = planted(900)
    odd = [(2000, None, None), (2001, "", "en"), (None, "vile words", "fr"), (5, docs[5][1], None), (2002, "scum " * 50_000, "en")]
    d = spark.createDataFrame(docs + odd, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), labels[4]], "doc_id bigint, toxic int")
    rows = toxicity.classify(d, marks).collect()
    assert len(rows) == len(docs) + len(odd)
    truth = dict(labels)
    held = [r for r in rows if r.doc_id in truth and r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    hits = sum(r.predicted and truth[r.doc_id] for r in held)
    assert hits >= 0.8 * sum(truth[r.doc_id] for r in held)
    assert sum(r.predicted and not truth[r.doc_id] for r in held) <= 0.1 * len(held)
    assert len({r.score for r in rows if r.doc_id in (2000, 2001)}) == 1


def test_without_labels_nothing_is_toxic(spark):
    d = spark.createDataFrame(planted(20)[0], "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in toxicity.classify(d, none).collect()} == {0}
    assert toxicity.classify(d.limit(0), none).count() == 0


def test_histograms_ignore_the_separator():
    shares = toxicity.byte_histograms([b"ab", b"", b"\n\n"])
    assert np.allclose((shares**2).sum(axis=1), [1, 0, 1]) and shares[2, 10] == 1
    assert tb.words([b"A b", b""], tb.ALNUM)[1].tolist() == [0, 2, 2]


def test_an_id_on_many_rows_teaches_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "_fit", lambda rows: rows)
    docs = [(1, f"bad words {k}", "en") for k in range(60)] + [(2, "good words", "en"), (2, "good words", "en"), (3, "more", "en")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int")
    rows = toxicity.train(df, labels, most_toxic=1, most_clean=1)
    assert sorted(r[1] for r in rows) == [0, 1]
    again = toxicity.train(df.repartition(3), labels, most_toxic=1, most_clean=1)
    assert [r[2].tolist() for r in rows] == [r[2].tolist() for r in again]


def test_rows_beyond_the_sample_teach(spark, monkeypatch):
    docs, labels = planted(2400)
    truth, least = dict(labels), 60
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    sample = {r.doc_id for k in (0, 1) for r in frame.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id")).limit(least).collect()}
    rng = random.Random(4)
    rows = []
    for i, text, lang in docs:
        words = [w for w in text.split() if w.startswith("w")] or ["w1"]
        for _ in range(3 * truth[i]):
            words.insert(rng.randrange(len(words)), "vile" if i in sample else "grim")
        rows.append((i, " ".join(words), lang))
    monkeypatch.setattr(toxicity, "train", functools.partial(toxicity.train, most_toxic=least, most_clean=least))
    found = toxicity.classify(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    ).collect()
    held = [r for r in found if r.held_out]
    hits = sum(r.predicted and truth[r.doc_id] for r in held)
    assert hits >= 0.8 * sum(truth[r.doc_id] for r in held)
    assert sum(r.predicted and not truth[r.doc_id] for r in held) <= 0.1 * len(held)


def test_a_long_text_teaches_whole(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, 20)) for _ in range(toxicity.BATCH)]
    texts[0] = " ".join(["w1"] * (toxicity.MOST_WORDS + 1)) + " last"
    rows = [(i, int(i == 0), "en", t) for i, t in enumerate(texts) if not toxicity._apart(np.array([i]))[0] or i == 0]
    rows = [(r[0] if r[0] else 10_000, *r[1:]) for r in rows]
    assert not toxicity._apart(np.array([10_000]))[0]
    df = spark.createDataFrame(rows, "doc_id bigint, toxic int, lang string, text string")
    (step,) = toxicity._steps(df.selectExpr("0 part", "doc_id", "toxic", "text").coalesce(1).toArrow().to_batches())
    assert texts[0].encode() in step[1] and sum(step[2]) == 1
    net = toxicity.ConvNet(bits=6, half=3, filters=2)
    net.begin()
    moved = toxicity.taught(net, df, {0: len(rows) - 1, 1: 1})
    assert not np.allclose(moved.kernel, net.kernel) and np.isfinite(moved.tables).all()
