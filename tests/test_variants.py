"""JSON of any shape: whole texts, unknown fields, reasons."""

import json

from pyspark.sql import functions as F

from patchlens.functions.variants import whole_json
from patchlens.operators import commit_files, commit_reasons, explode_files
from patchlens.plans import parse_responses, response_reasons
from patchlens.schemas import COMMIT


def test_whole_json_is_exactly_one_value(spark, column):
    good = ["1", " [1, 2]\n", '{"a": null}', '"x"', "null", "[]"]
    bad = ["", " ", "[1] tail", "[1], [2]", "1], [2", "[1]] x", "[1]} x", "{", "oops [1]", None, '{"a":1} , "b": 2']
    out = column(lambda c: F.to_json(whole_json(c)), *good, *bad)
    assert [json.loads(v) for v in out[: len(good)]] == [json.loads(v) for v in good]
    assert out[len(good) :] == [None] * len(bad)


def test_commit_fields_beyond_the_schema_stay(spark):
    commits = [
        {"repo_name": "a/b", "sha": "s1", "when": {"day": 1}, "files": [
            {"filename": "X.PY", "patch": "+a", "changes": 3, "tags": ["u", 2]}, {"filename": "y"}, 7, None, {"patch": "+b"}, {"patch": ""}]},
        {"repo_name": "a/b", "sha": "s2", "files": []},
    ]
    bad = ["oops", json.dumps([commits[0]]), '{"sha": "s", "files": []}', '{"repo_name": "r", "sha": null}', '{"repo_name": "r", "sha": "s", "files": 1}', None]
    texts = [*map(json.dumps, commits), *bad]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    rows = commit_files(df, "i").select(
        "i", "repo_name", "commit_sha", "filename", "patch", F.to_json("commit_rest").alias("c"), F.to_json("file_rest").alias("f")
    ).collect()
    assert [(*r[:5], json.loads(r.c), json.loads(r.f)) for r in rows] == [
        (0, "a/b", "s1", "x.py", "+a", {"when": {"day": 1}}, {"changes": 3, "tags": ["u", 2]}),
        (0, "a/b", "s1", "", "+b", {"when": {"day": 1}}, {}),
    ]
    reasons = {r.i: r.reason for r in commit_reasons(df, "i").collect()}
    assert reasons == {
        2: "no JSON", 3: "no object", 4: "lacks repo_name", 5: "lacks sha", 6: "files are no list", 7: "no JSON",
    }
    # What the schema names is what the typed form gives, which loses all files of a commit with one that is no object.
    clean = [{**c, "files": [f for f in c["files"] if isinstance(f, dict)]} for c in commits]
    objects = spark.createDataFrame([(json.dumps(c),) for c in clean], "value string")
    typed = objects.select(F.from_json("value", COMMIT).alias("c")).select("c.*")
    known = ["repo_name", "commit_sha", "filename", "patch"]
    assert sorted(commit_files(objects).select(known).collect()) == sorted(explode_files(typed).select(known).collect())


def test_each_answer_without_rows_has_a_reason(spark):
    item = {"sector": "s", "theme": "t", "summary": "u", "top_libs": ["x"]}
    less = {k: v for k, v in item.items() if k != "theme"}
    answers = {
        None: [json.dumps([item]), f"```json\n{json.dumps([item, item])}\n```", json.dumps([{**item, "more": 1}])],
        "no JSON": ["", "oops [1]", json.dumps([item]) + " done", json.dumps([item])[:-3], None],
        "no list": [json.dumps(item), "3"],
        "no items": ["[]"],
        "item 1 is no object": ["[3]"],
        "item 2 lacks theme": [json.dumps([item, less])],
        "item 1 lacks summary": [json.dumps([{**item, "summary": None}, less])],
        "item 1 lacks top_libs": [json.dumps([{**item, "top_libs": "x"}])],
    }
    rows = [(reason, text) for reason, texts in answers.items() for text in texts]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i int, response string")
    found = {r.i: r.reason for r in response_reasons(df, "i").collect()}
    assert [found.get(i) for i in range(len(rows))] == [reason for reason, _ in rows]
    # An answer either gives rows or a reason.
    assert {r.i for r in parse_responses(df, "i").collect()} == set(range(len(rows))) - set(found)


def test_reasons_parse_a_text_once_and_where_it_was_dealt_to(spark):
    """The filter on the reason stays above the parsing, and the parsing above the exchange."""
    texts = spark.createDataFrame([(1, "[]"), (2, "[] []"), (3, '[{"sector": "s"}]')], "id int, text string").repartition(3)
    for reasons, name, found in ((response_reasons, "response", ["no items", "no JSON", "item 1 lacks theme"]), (commit_reasons, "value", ["no object", "no JSON", "no object"])):
        dealt = reasons(texts.withColumnRenamed("text", name), "id")
        assert [r.reason for r in dealt.orderBy("id").collect()] == found
        plan = dealt._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Repartition")
        assert above.count("parseJson") == 2 and "Filter" in above and "Filter" not in below
