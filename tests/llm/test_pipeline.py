import json
import subprocess
import sys

import pyarrow as pa

import corpus_pipeline
from patchlens.llm import jaccard_join, language, line_dedup, positional_index


def test_stages_keep_the_columns_and_pack_the_rest(spark, tmp_path):
    words = [f"w{k}" for k in range(400)]
    near = words[:200]
    rows = [
        (1, " ".join(near), "en", "a", 0), (2, " ".join([*near[:100], "x", *near[101:]]), "en", "b", 0),
        (3, "123 456", "en", "a", 0), (4, None, None, None, 0), (5, " ".join(words[200:260]), "fr", "a", 0),
        (6, "le chat noir dort ici\nune ligne de plus", "fr", "a", 0), (7, "une ligne de plus\nencore une autre chose", "fr", "a", 0),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(words[200:240]))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        docs, kept[name] = after, {r.doc_id for r in after.select("doc_id").collect()}
    assert kept["language_id"] == {1, 2, 5, 6, 7}
    assert kept["line_dedup"] == {1, 2, 5, 6, 7}
    assert kept["benchmark_decontamination"] == kept["ngram_jaccard_join"] - {5}
    assert kept["packing"] == kept["benchmark_decontamination"]


def test_stages_keep_columns_named_like_their_own(spark):
    words = [f"w{k}" for k in range(60)]
    texts = ["first line of it\nsecond line here", "other words\nfirst line of it", " ".join(words), None, "", " ".join(words)]
    own = ["_id", "_ID_", "_hash", "kept_id", "kept_hash", "_bad", "_lettered", "_gone", "gone_id", "gone_hash", "_lines"]
    own += ["n_lines", "n_removed", "n", "row", "line_id", "norm", "component", "key", "text_hash", "set_id", "n_words", "items", "item_id", "a.b"]
    rows = [(k, t, "en", *(f"{c}{k}" for c in own)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", *own]).repartition(3)
    plain = docs.select("doc_id", "text", "lang")
    benchmark = spark.createDataFrame([(1, "other words first", "x")], "item_id bigint, text string, _bad string")
    languages, model = language.train(plain)
    stages = [
        lambda d: language.in_a_language(d, languages, model, 0.0),
        line_dedup.without_repeats,
        jaccard_join.one_of_each,
        lambda d: positional_index.clean(d, benchmark),
    ]
    for stage, ids in zip(stages, [{0, 1, 2, 5}, {0, 1, 2, 3, 4, 5}, {0, 1, 2, 3, 4}, {0, 2, 3, 4, 5}]):
        out = stage(docs)
        assert out.columns == docs.columns
        found = {r[0]: tuple(r) for r in out.collect()}
        assert set(found) == ids
        assert all(row[3:] == rows[k][3:] for k, row in found.items())
        assert sorted(map(tuple, stage(plain).collect()), key=repr) == sorted((row[:3] for row in found.values()), key=repr)


def test_the_rest_imports_without_the_operators():
    code = """
import sys, json
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("patchlens.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(json.dumps(sorted(e.queries())))
"""
    names = json.loads(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert "leak_detect" in names and not any(n.startswith("op") or n == "pipeline" for n in names)


def test_stages_take_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text", "'en' AS lang").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    try:
        corpus_pipeline.pack(spark, docs, "")
        found = [r[0] for r in docs.mapInArrow(sizes, "size bigint").collect()]
        assert sum(found) > 12e6 and max(found) < 5e6
        spark.conf.set(key, "64k")
        corpus_pipeline.pack(spark, docs, "")
        assert spark.conf.get(key) == "64k"
    finally:
        spark.conf.unset(key)
