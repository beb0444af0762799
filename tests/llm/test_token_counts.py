import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from patchlens.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def tokenizer(vocabulary):
    """The library's unigram tokenizer of the same pieces."""
    out = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0, byte_fallback=False))
    out.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return out



PUBLIC = token_counts.unigram_vocabulary(MODEL)
TIED = [(p, -float(len(p) // 2 + 1)) for p in ["a", "b", "ab", "ba", "aab", "bb", "aba", "▁", "▁a", "▁ab", "c", "bcb"]]


@pytest.fixture(scope="module", params=["public", "tied"])
def both(request):
    vocabulary = PUBLIC if request.param == "public" else TIED
    return token_counts.Counter(vocabulary), tokenizer(vocabulary)


def check(both, text):
    counter, reference = both
    assert counter.text(text)[0] == len(reference.encode(text, add_special_tokens=False).ids), text


def test_random_texts(both):
    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(alphabet="abc ▁d\n", max_size=40), st.text(max_size=30), st.text(alphabet="the andıœß漢ing ")))
    def run(text):
        check(both, text)

    run()


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "\n", "▁", "a▁ b", "漢字漢字 漢", "abab" * 50, "𝔘nicode 𝔘𝔘"])
def test_special_texts(both, text):
    check(both, text)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    reference = tokenizer(PUBLIC)
    want = {r.doc_id: len(reference.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    got = token_counts.count_tokens(docs, MODEL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want


def test_edge_cases(spark):
    rows = [(1, None, 1), (2, "", 1), (2, "", 1), (None, "ab", 1), (3, "word " * 40_000, 1), (4, "x" * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = {(r.doc_id, r.n_chars): (r.n_tokens, r.score) for r in token_counts.count_tokens(df, MODEL).collect()}
    assert got[1, 0] == got[2, 0] == (0, 0.0)
    reference = tokenizer(PUBLIC)
    for i, t, _ in rows[3:]:
        assert got[i, len(t)][0] == len(reference.encode(t, add_special_tokens=False).ids)
    assert token_counts.count_tokens(df.limit(0), MODEL).count() == 0


def test_counts_do_not_depend_on_what_is_remembered(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 2)
    small, large = token_counts.Counter(TIED), token_counts.Counter(TIED)
    for text in ["a b ab ba", "ab ab d", "dd a"]:
        assert small.text(text) == large.text(text)


def test_long_parts_are_not_remembered():
    count = token_counts.Counter(TIED)
    long, short = "ab" * token_counts.LONGEST, "abab"
    assert count.text(f"{long} {short}")[0] == count.text(long)[0] + count.text(short)[0]
    assert max(map(len, count)) <= token_counts.LONGEST and token_counts.SPACE + short in count
