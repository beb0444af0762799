"""Packing by power-of-two decomposition.

A document's ids, with END after them, are cut in pieces whose lengths are the powers of two in
their number: as many pieces of ``size`` as fit, then the binary digits of the rest, largest
first. A piece is a sequence of its own, so no sequence crosses documents and none needs
padding. Sequences of one length are numbered one after the other, a bucket for each length.
"""

import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.llm import textblocks as tb
from patchlens.llm.scratch import saved

END = 0
#: Pre-tokens a worker remembers with their ids, in each of two halves.
REMEMBERED = 350_000
#: Characters up to which a pre-token is remembered, so that the memory has a bound in bytes as well.
LONGEST = 64

# Fixed values of the tokenizer's pre-tokenisation, for characters up to U+00FF: contractions,
# letters, numbers, other signs (each with one space before it), white space.
_SPACE = r"\t-\r\x20\x85\xa0"
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBER = "0-9²³¹¼½¾"
_PRETOKEN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_FIND = re.compile(_PRETOKEN).findall
_SPECIAL = "<|endoftext|>"


def _covered(text: str) -> bool:
    """Whether the pattern covers a text: no special token in it, and no character beyond U+00FF."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return _SPECIAL not in text


def _packed(encodings: list) -> list[bytes]:
    return [struct.pack(f"<{len(ids)}I", *ids) for e in encodings for ids in (e.ids,)]


class Encoder:
    """Whole texts to ids (little-endian 32-bit), exactly as the byte-level BPE file at ``path`` encodes them.

    BPE never crosses a pre-token, so a text's ids are those of its pre-tokens, and the
    vocabulary of pre-tokens repeats: a block's new ones are encoded in one batch and remembered.
    What the pattern does not cover goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        odd = [k for k, t in enumerate(texts) if not _covered(t)]
        for k, ids in zip(odd, _packed(self.tokenizer.encode_batch([texts[k] for k in odd], add_special_tokens=False))):
            out[k] = ids
        found = [_FIND(t) if out[k] is None else [] for k, t in enumerate(texts)]
        if len(self.ids) > REMEMBERED:  # what is used again returns from the older half
            self.older, self.ids = self.ids, {}
        new = set().union(*found).difference(self.ids)
        again = new.intersection(self.older)
        self.ids.update((w, self.older[w]) for w in again)
        new = list(new - again)
        self.ids.update(zip(new, _packed(self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        known = self.ids.__getitem__
        coded = [b"".join(map(known, f)) if out[k] is None else out[k] for k, f in enumerate(found)]
        for long in [w for w in new if len(w) > LONGEST]:
            del self.ids[long]
        return coded


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, so what it remembers serves all of the worker's tasks."""
    return Encoder(path)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: lengths are powers of two of at most ``size``, largest first."""
    out = [(k, size) for k in range(0, n - size + 1, size)]
    at = len(out) * size
    for bit in range(size.bit_length() - 2, -1, -1):
        if (n - at) >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, part int, place bigint"


def pieces(docs: DataFrame, tokenizer: str, size: int = 1024) -> DataFrame:
    """Pieces of every row of docs: ids (little-endian 32-bit), and their place among a task's pieces of that length."""
    if size & (size - 1) or size < 1:
        raise ValueError("size must be a power of two")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        count: dict[int, int] = {}
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            for i, j in tb.blocks(texts):
                rows: list[tuple] = []
                for doc_id, coded in zip(ids[i:j], encode(texts[i:j])):
                    coded += END.to_bytes(4, "little")
                    total = len(coded) // 4
                    for start, length in cuts(total, size):
                        place = count.get(length, 0)
                        count[length] = place + 1
                        rows.append((doc_id, start, length, coded[4 * start : 4 * (start + length)], total, part, place))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    whole = pa.int64()
    schema = pa.schema(
        [("doc_id", whole), ("start", whole), ("length", whole), ("ids", pa.binary()), ("doc_tokens", whole),
         ("part", pa.int32()), ("place", whole)]
    )
    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, PIECES)


def numbered(stored: DataFrame) -> DataFrame:
    """Stored pieces (length, part, place, ...) with sequence_id and offset instead of part and place.

    Ids run from 0 through the buckets, longest first, without a gap. Only the counts of each
    task and length are sorted; they are a dozen rows a task.
    """
    counts = stored.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.orderBy(F.desc("length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        stored.join(base, ["length", "part"])
        .withColumn("sequence_id", F.col("base") + F.col("place"))
        .withColumn("offset", F.lit(0).cast("bigint"))
        .drop("base", "part", "place")
    )


def pack(docs: DataFrame, tokenizer: str, size: int = 1024) -> DataFrame:
    """Pieces of docs (doc_id, text): doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A null text is empty and gives the one piece of END. Each row is a document of its own, so
    repeated rows give repeated pieces in sequences of their own; a null doc_id stays null. Other
    columns are ignored; an empty table gives no rows.
    """
    return numbered(saved(pieces(docs, tokenizer, size)))


def pack_digests(docs: DataFrame, tokenizer: str, size: int = 1024) -> DataFrame:
    """The same with ids_crc32 in place of ids; the ids are not stored."""
    made = pieces(docs, tokenizer, size)
    return numbered(saved(made.withColumn("ids_crc32", F.crc32("ids")).drop("ids")))
