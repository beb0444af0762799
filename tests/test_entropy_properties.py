"""The two entropy forms against each other and against a direct count."""

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patchlens.functions import mask_sha
from patchlens.operators import patch_entropy

TEXT = st.text(
    st.one_of(
        st.sampled_from("abcAB01 \n\t\r\x1c\x85\xa0 　é漢字😀"),
        st.characters(exclude_categories=["Cs"], exclude_characters="\x00"),
    ),
    max_size=60,
)
SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def direct(text):
    if not text:
        return 0.0
    kept = [c for c in text if not c.isspace()]
    if not kept:
        return None
    shares = [n / len(kept) for c, n in Counter(kept).items() if ord(c) < 256]
    return abs(sum(p * math.log2(p) for p in shares))


def scores(spark, texts, method):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, patch string")
    found = patch_entropy(rows, ["id"], method=method).collect()
    assert len(found) == len(texts)
    return [score for _, score in sorted(found)]


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, abs_tol=1e-9))


@SLOW
@given(texts=st.lists(TEXT, min_size=1, max_size=40))
def test_both_forms_count_right(spark, texts):
    expected = [direct(t) for t in texts]
    for method in ("arrow", "native"):
        assert all(map(close, scores(spark, texts, method), expected))
    assert all(e is None or 0 <= e <= 8 for e in expected)


@SLOW
@given(texts=st.lists(TEXT, min_size=1, max_size=40), random=st.randoms())
def test_order_and_whitespace_do_not_matter(spark, texts, random):
    texts = [t for t in texts if t] or ["a"]
    moved = ["\n".join(random.sample(t, len(t))) for t in texts]
    assert all(map(close, scores(spark, texts, "arrow"), scores(spark, moved, "arrow")))


@SLOW
@given(hashes=st.lists(st.text("0123456789abcdef", min_size=9, max_size=40), min_size=1, max_size=20))
def test_a_masked_hash_shows_eight_characters(spark, hashes):
    rows = spark.createDataFrame([(h,) for h in hashes], "sha string")
    masked = [r[0] for r in rows.select(mask_sha(F.col("sha"))).collect()]
    assert masked == [h[:8] + "*" * 16 for h in hashes]


def test_whole_texts_are_scored(spark):
    long = "a" * 300_000 + "b" * 300_000
    for method in ("arrow", "native"):
        assert close(scores(spark, [long], method)[0], 1.0)
