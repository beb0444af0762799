import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patchlens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \t\n'sdé漢 <|>endoftx"))))
def test_ids_are_the_tokenizers(text):
    assert np.frombuffer(packing.encoder(PATH).encode(["x", text])[1], "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["<|endoftext|> a", "I'll  we've \n\n x", "\x1c\x1d a\x85 b\xa0c", "½²3 ª", "漢字 kana"])
def test_ids_of_special_texts(text):
    assert np.frombuffer(packing.encoder(PATH).encode(["x", text])[1], "<u4").tolist() == ids_of(text)


@settings(deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 2, 64, 1024]))
def test_cuts_are_powers_of_two_without_gaps(n, size):
    parts = packing.cuts(n, size)
    assert [s for s, _ in parts] == np.cumsum([0, *(c for _, c in parts)])[:-1].tolist()
    assert sum(c for _, c in parts) == n
    assert all(c <= size and c & (c - 1) == 0 for _, c in parts)
    below = [c for _, c in parts if c < size]
    assert len(below) == len(set(below))


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(1, None), (2, ""), (2, ""), (3, " "), (None, "null id"), (4, "word " * 30_000)]
    rows += [(k, " ".join(rng.choice(["the", "été", "x1", "\n", "--"]) for _ in range(rng.randrange(900)))) for k in range(5, 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = packing.pack(df, PATH).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    assert all(r.offset == 0 and len(r.ids) == 4 * r.length and r.length & (r.length - 1) == 0 for r in out)
    by_length = [r.length for r in sorted(out, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length, reverse=True)
    pieces = {}
    for r in out:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for doc_id, text in set(rows):
        want = np.array([*ids_of(text), 0], "<u4")
        mine = sorted(pieces[doc_id, len(want)], key=lambda r: r.start)
        copies = rows.count((doc_id, text))
        assert len(mine) == copies * len(packing.cuts(len(want), 1024))
        assert b"".join(r.ids for r in mine[::copies]) == want.tobytes()
    digests = packing.pack_digests(df, PATH).collect()
    key = lambda r: (r.sequence_id, r.length)
    assert sorted(map(key, digests)) == sorted(map(key, out))
    crc = sorted(r.ids_crc32 for r in digests)
    assert crc == sorted(zlib.crc32(r.ids) for r in out)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "a", 2, 3, "x")], "doc_id int, text string, part int, place int, ids string")
    assert packing.pack(df, PATH).count() == 1
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_long_pre_tokens_are_not_remembered():
    encoder = packing.Encoder(PATH)
    long = "x" * (packing.LONGEST + 1)
    for _ in range(2):
        coded = encoder.encode([f"a {long} b {long}", long])
        assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [ids_of(f"a {long} b {long}"), ids_of(long)]
        assert max(map(len, encoder.ids)) <= packing.LONGEST
