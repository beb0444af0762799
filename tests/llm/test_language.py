import zlib

import numpy as np

from patchlens.llm import language


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    model = language.ByteGru(3, hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    data, label = rng.integers(60, 70, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    loss, grads = model.gradients(data, label)
    for name, weight in model.weights.items():
        rows = np.unique(data) if name.startswith("in") else np.arange(len(weight))
        at = (int(rng.choice(rows)),) + tuple(int(rng.integers(n)) for n in weight.shape[1:])
        weight[at] += 1e-3
        higher, _ = model.gradients(data, label)
        weight[at] -= 2e-3
        lower, _ = model.gradients(data, label)
        weight[at] += 1e-3
        assert abs((higher - lower) / 2e-3 - grads[name][at]) < 2e-3, name


def test_pooling_does_not_depend_on_the_neighbours():
    model = language.ByteGru(3)
    texts = [b"", b"a", b"x" * 127, b"y" * 128, b"z" * 129, "é".encode() * 400]
    together = language.pooled(model, texts)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-4)
    for k, t in enumerate(texts):
        assert np.allclose(language.pooled(model, [t])[0], together[k], atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in language.identify(docs).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held) > 150
    assert all(0 <= r.score <= 1 for r in held)


def test_edge_cases(spark):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the cat and dog " * 9, "en"), ("le chat été ça " * 9, "fr")] * 12)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "123 .,!", "en"), (103, "x" * 300_000, None), (None, "le chat", "fr"), (104, "a", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert len(got) == len(rows)
    assert all((got[k].lang_pred, got[k].score) == ("und", 0.0) for k in (100, 101, 102))
    assert {got[k].lang_pred for k in (103, None, 104)} <= {"en", "fr"}
    assert got[0].lang_pred == "en" and got[1].lang_pred == "fr" and got[None].held_out is False
    assert language.identify(df.limit(0)).count() == 0
    bare = language.identify(df.withColumn("lang", df.lang.substr(1, 0)).where("false or doc_id = 0").drop("lang").selectExpr("*", "cast(null as string) lang"))
    assert [(r.lang_pred, r.score) for r in bare.collect()] == [("und", 0.0)]


def test_padding_does_not_enter_the_gradient():
    rng = np.random.default_rng(4)
    model = language.ByteGru(3, hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    data, label, size = rng.integers(60, 70, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5), np.array([1, 7, 3, 5, 2])
    loss, grads = model.gradients(data, label, size)
    for name in ("inf", "ref", "outb", "bias"):
        at = (int(data[0, 0]),) + (1,) * (model.weights[name].ndim - 1) if name == "inf" else (0,) * model.weights[name].ndim
        weight = model.weights[name]
        weight[at] += 1e-3
        higher, _ = model.gradients(data, label, size)
        weight[at] -= 2e-3
        lower, _ = model.gradients(data, label, size)
        weight[at] += 1e-3
        assert abs((higher - lower) / 2e-3 - grads[name][at]) < 2e-3, name


def test_a_language_of_short_texts_is_learned(spark):
    rows = [(k, "the cat and the dog went over there " * 5, "en") for k in range(60)]
    rows += [(100 + k, f"żółć gęś {'ąę'[k % 2]}", "pl") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    languages, model = language.train(df)
    assert languages == ["en", "pl"]
    got = {r.doc_id: r.lang_pred for r in language.predict(df, languages, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_an_id_on_many_rows_teaches_each_language_once(spark):
    docs = [(1, f"some words {k}", "en") for k in range(60)] + [(1, "des mots", "fr"), (1, "des mots", "fr"), (2, "autres", "fr")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(4)
    runs = language._sample(df, 1, 6, 64)
    assert [lang for lang, _ in runs] == ["en", "fr"]
    assert runs == language._sample(df.repartition(3), 1, 6, 64)
