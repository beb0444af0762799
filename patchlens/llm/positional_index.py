"""Benchmark decontamination by a distributed positional inverted index.

`build_index` stores the postings of all training tokens: each row of the index holds the
sorted position lists of some megabytes of whole documents, so it is written without a shuffle
and a lost task rebuilds only its own rows. A query set (the benchmark) visits every row of the
index in blocks of bounded size. A phrase starts from the positions of its rarest term there and
keeps those at which the other terms' lists, moved by their offsets, meet it, rarest first.

Words are runs of ASCII letters and digits and of characters beyond ASCII; A-Z is lowered.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm import textblocks as tb
from patchlens.llm.scratch import free, saved, small_batches

#: Bytes of documents in one row of the index, and of query texts in one visit of it.
INDEX_BYTES = 4 << 20
QUERY_BYTES = 32 << 20
#: Windows that are looked up in a row of the index at a time.
WINDOWS = 1 << 16

INDEX = (
    "doc_ids array<bigint>, bounds array<int>, terms array<bigint>, heads array<int>, gaps array<int>"
)
HITS = "doc_id bigint, n_words bigint, spans array<int>, items array<bigint>"


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), tb.text_bytes(batch.column("text"))
        for i, j in tb.blocks(texts, INDEX_BYTES):
            hashes, bounds = tb.words(texts[i:j], tb.ALNUM)
            order = np.argsort(hashes, kind="stable")
            terms, heads = np.unique(hashes[order], return_index=True)
            gaps = np.diff(order, prepend=0)
            gaps[heads] = order[heads]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                    pa.array([bounds.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([terms.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([np.append(heads, len(order)).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([gaps.astype(np.int32)], pa.list_(pa.int32())),
                ],
                ["doc_ids", "bounds", "terms", "heads", "gaps"],
            )


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of docs (doc_id, text; other columns are ignored).

    Each document keeps its place even without words or text, and each repeated row is indexed
    for itself. An empty table gives an empty index.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    # A row has some megabytes, so tasks that held many of them would hold a multiple of their input.
    return saved(narrow.mapInArrow(_postings, INDEX), group_rows=1)


class _Block:
    """One row of the index with its lists ready to be probed."""

    def __init__(self, doc_ids, bounds, terms, heads, gaps):
        self.doc_ids, self.bounds = doc_ids, bounds.astype(np.int64)
        self.terms, self.heads = terms.view(np.uint64), heads.astype(np.int64)
        total = np.cumsum(gaps.astype(np.int64))
        lists = np.diff(self.heads)
        before = total[self.heads[:-1]] - gaps[self.heads[:-1]] if len(self.terms) else lists
        self.positions = total - np.repeat(before, lists)
        self.n = int(self.bounds[-1])
        # Lists follow each other by term: one sorted array holds them all.
        self.keys = np.repeat(np.arange(len(self.terms)), lists) * (self.n + 1) + self.positions

    def lists_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and length of each term's list; length 0 where the term is absent."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == hashes if len(self.terms) else np.zeros(len(hashes), bool)
        return at, np.where(known, np.diff(self.heads)[at] if len(self.terms) else 0, 0)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, position, side="right") - 1

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * (self.n + 1) + position
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return self.keys[at] == key

    def starts(self, rank: np.ndarray, term: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase numbers and rarest-term positions, one pair for each entry of their lists."""
        first = np.take_along_axis(term, rank[:, :1], 1)[:, 0]
        count = np.take_along_axis(size, rank[:, :1], 1)[:, 0]
        phrase = np.repeat(np.arange(len(term)), count)
        inner = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
        return phrase, self.positions[self.heads[first][phrase] + inner]

    def phrases(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (phrase, start) of equally long phrases, a row of word hashes each."""
        length = hashes.shape[1]
        term, size = (x.reshape(hashes.shape) for x in self.lists_of(hashes.ravel()))
        alive = np.flatnonzero((size > 0).all(axis=1))
        if not len(alive):
            return alive, alive
        term, size = term[alive], size[alive]
        rank = np.argsort(size, axis=1, kind="stable")
        phrase, start = self.starts(rank, term, size)
        start = start - rank[phrase, 0]
        for k in range(1, length):
            offset = rank[phrase, k]
            keep = self.has(term[phrase, offset], start + offset)
            phrase, start = phrase[keep], start[keep]
        whole = (start >= 0) & (start + length <= self.n)
        phrase, start = phrase[whole], start[whole]
        same = self.document(start) == self.document(start + length - 1)
        return alive[phrase[same]], start[same]

    def near(self, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of stretches of ``window`` words of one document that hold all its terms.

        Each stretch starts at one of the terms and holds the rarest.
        """
        term, size = (x.reshape(hashes.shape) for x in self.lists_of(hashes.ravel()))
        alive = np.flatnonzero((size > 0).all(axis=1))
        if not len(alive):
            return alive, alive
        term, size = term[alive], size[alive]
        phrase, pivot = self.starts(np.argsort(size, axis=1, kind="stable"), term, size)
        found = []
        for back in range(window):
            start = pivot - back
            ok = (start >= 0) & (start >= self.bounds[self.document(pivot)])
            p, s = phrase[ok], start[ok]
            end = np.minimum(s + window, self.bounds[self.document(s) + 1])
            opens = np.zeros(len(p), bool)
            inside = np.ones(len(p), bool)
            for k in range(hashes.shape[1]):
                key = term[p, k] * (self.n + 1)
                at = np.searchsorted(self.keys, key + s)
                at[at == len(self.keys)] = 0
                inside &= (self.keys[at] >= key + s) & (self.keys[at] < key + end)
                opens |= self.keys[at] == key + s
            found.append(np.stack([alive[p], s])[:, inside & opens])
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for k in range(len(batch)):
            lists = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in range(1, 5))
            yield _Block(batch.column(0)[k].as_py(), *lists)


def _windows(items: list[tuple[int, bytes]], most: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the distinct windows, and (window, item) pairs as two arrays."""
    hashes, bounds = tb.words([t for _, t in items], tb.ALNUM)
    by_size: dict[int, list] = {}
    for (item, _), a, b in zip(items, bounds, bounds[1:]):
        size = min(most, b - a)
        for s in range(a, b - size + 1 if size else a):
            by_size.setdefault(int(size), []).append((s, item))
    out = {}
    for size, found in by_size.items():
        start, item = np.array(found, np.int64).T
        rows, which = np.unique(hashes[start[:, None] + np.arange(size)], axis=0, return_inverse=True)
        out[size] = rows, which.ravel(), item
    return out


def _query_blocks(queries: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """The query texts in blocks of QUERY_BYTES, read one partition at a time."""
    held, size = [], 0
    rows = queries.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).dropna()
    for item, text in rows.toLocalIterator():
        raw = text.encode()
        if held and size + len(raw) > QUERY_BYTES:
            yield held
            held, size = [], 0
        held.append((item, raw))
        size += len(raw)
    yield held


def phrase_hits(index: DataFrame, queries: DataFrame, words: int = 13) -> DataFrame:
    """Per indexed row: doc_id, n_words, spans (start and end of each maximal hit run, flat), items.

    A query's windows are its runs of ``words`` words; a shorter one, but not an empty one, is a
    single window. A query without text, item_id or words matches nothing. Query texts beyond
    QUERY_BYTES are taken in several visits of the index, whose results are merged.
    """
    parts = [_one_visit(index, _windows(block, words)) for block in _query_blocks(queries)]
    if len(parts) == 1:
        return parts[0].drop("block", "place")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    merged = out.groupBy("block", "place", "doc_id", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    return merged.drop("block", "place").mapInArrow(_merge_spans, HITS)


def _merge_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for flat in batch.column("spans").to_pylist():
            runs: list[int] = []
            for a, b in sorted(zip(flat[::2], flat[1::2])):
                if runs and a <= runs[-1]:
                    runs[-1] = max(runs[-1], b)
                else:
                    runs += [a, b]
            spans.append(runs)
        at = batch.schema.get_field_index("spans")
        yield batch.set_column(at, "spans", pa.array(spans, pa.list_(pa.int32())))


def _one_visit(index: DataFrame, windows: dict) -> DataFrame:
    """The hits of one block of windows; (block, place) names an indexed row."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _rows(batches):
            edge = np.zeros(block.n + 1, np.int64)
            hits: list[np.ndarray] = []
            for size, (hashes, which, item) in windows.items():
                parts = [(k, block.phrases(hashes[k : k + WINDOWS])) for k in range(0, len(hashes), WINDOWS)]
                phrase = np.concatenate([k + part[0] for k, part in parts])
                start = np.concatenate([part[1] for _, part in parts])
                np.add.at(edge, start, 1)
                np.add.at(edge, start + size, -1)
                met = np.unique(np.stack([block.document(start), phrase]), axis=1)
                order = np.argsort(which, kind="stable")
                low = np.searchsorted(which[order], met[1])
                count = np.searchsorted(which[order], met[1], side="right") - low
                inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                hits.append(np.stack([np.repeat(met[0], count), item[order[np.repeat(low, count) + inner]]]))
            covered = np.concatenate(([False], np.cumsum(edge)[: block.n] > 0, [False]))
            docs = len(block.doc_ids)
            items: list[list[int]] = [[] for _ in range(docs)]
            if hits:
                for d, i in np.unique(np.concatenate(hits, axis=1), axis=1).T.tolist():
                    items[d].append(i)
            spans = []
            for a, b in zip(block.bounds, block.bounds[1:]):
                inside = np.concatenate(([False], covered[a + 1 : b + 1], [False]))
                spans.append(np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32))
            first = int(block.terms[0]) if len(block.terms) else 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{block.n}:{first}:{block.doc_ids[0]}"] * docs),
                    pa.array(np.arange(docs, dtype=np.int64)),
                    pa.array(block.doc_ids, pa.int64()),
                    pa.array(np.diff(block.bounds)),
                    pa.array(spans, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                ["block", "place", "doc_id", "n_words", "spans", "items"],
            )

    return index.mapInArrow(search, f"block string, place bigint, {HITS}")


def near_hits(index: DataFrame, queries: DataFrame, window: int) -> DataFrame:
    """(doc_id, item_id, start): stretches of ``window`` words that hold all words of a query, in any order.

    A stretch starts at one of the query's words. A query of no words matches nothing.
    """
    parts = []
    for held in _query_blocks(queries):
        hashes, bounds = tb.words([t for _, t in held], tb.ALNUM)
        sets: dict[int, list] = {}
        for (item, _), a, b in zip(held, bounds, bounds[1:]):
            terms = np.unique(hashes[a:b])
            if len(terms):
                sets.setdefault(len(terms), []).append((item, terms))
        asked = {n: (np.array([t for _, t in x]), np.array([i for i, _ in x])) for n, x in sets.items()}

        def search(batches: Iterable[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            for block in _rows(batches):
                for terms, item in asked.values():
                    phrase, start = block.near(terms, window)
                    doc = block.document(start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.doc_ids[d] for d in doc], pa.int64()),
                            pa.array(item[phrase].astype(np.int64)),
                            pa.array(start - block.bounds[doc]),
                        ],
                        ["doc_id", "item_id", "start"],
                    )

        parts.append(index.mapInArrow(search, "doc_id bigint, item_id bigint, start bigint"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = 13, one_in: int = 20) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, items (matched item ids, as sorted text), contaminated.

    A document is contaminated when it has hit words and they are at least one in ``one_in`` of all.
    """
    hits = phrase_hits(build_index(docs), benchmark, words)
    n_hit = F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda a, x: a + x
    ).cast("bigint")
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.sort_array(F.col("items").cast("array<string>")).alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, words: int = 13, one_in: int = 20) -> DataFrame:
    """docs without contaminated rows; all columns stay, whatever their names. A text alone decides, so equal texts share a verdict."""
    text_hash = F.xxhash64(F.col("text").cast("string"))
    verdicts = contamination(docs.select(text_hash.alias("doc_id"), "text"), benchmark, words, one_in)
    (name,) = free(docs, "_bad")
    bad = verdicts.where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, text_hash == F.col(name), "left_anti")
