"""Removal of repeated byte strings, found in suffix arrays of shards built by induced sorting.

A byte goes if a string of WINDOW bytes that covers it also starts elsewhere. Equal strings have
to meet in one shard without shuffling every suffix:

* Each window names its anchor, the ANCHOR-byte string of least hash in it. Neighbouring windows
  with one anchor form a segment; equal windows lie in segments of the same anchor, so segments
  are dealt by it. Most anchors occur once, and their segments are done.
* Equal segments are counted first: all windows of a segment that occurs twice are repeated, and
  one copy stands for all from there on.
* Anchors with different segments go to shards. A shard's segments form one string, whose suffix
  array is induced from its sorted leftmost-smaller substrings; a window is repeated if the
  common prefix with its neighbour among the shard's windows has WINDOW bytes.
* An anchor with more than SHARD_SEGMENTS different segments would not fit a shard. Its windows
  are compared by their hashes in a plain aggregation.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm import textblocks as tb
from patchlens.llm.scratch import saved

WINDOW = 200
ANCHOR = 64
SHARD_BYTES = 1 << 20
SHARD_SEGMENTS = 4000
#: Largest alphabet whose buckets are induced one by one.
ALPHABET = 4096
#: Bytes of a long text taken at once (positions in a block have 20 bits).
PIECE = 1_000_000
REMEMBERED = 500_000


# --- suffix arrays ---------------------------------------------------------------------------


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their right neighbour; text ends with its unique least symbol."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    nxt = differs[np.searchsorted(differs, np.arange(n - 1))]
    return np.append(text[nxt] < text[nxt + 1], True)


def _append(text, suffixes, kind, want, found, place, step):
    """Put the left neighbours of found suffixes that are of the wanted kind at their buckets' ends.

    place holds each bucket's next free slot and moves by step (1 from heads, -1 from tails).
    Returns the neighbours' bucket of each and where they were put, in order.
    """
    left = found[found > 0] - 1
    left = left[kind[left] == want]
    bucket = text[left]
    order = np.argsort(bucket, kind="stable")
    left, bucket = left[order], bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    count = np.diff(np.append(first, len(bucket)))
    rank = np.arange(len(bucket)) - np.repeat(first, count)
    suffixes[place[bucket] + step * rank] = left
    place[bucket[first]] += step * count


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The suffix array that follows from leftmost-smaller suffixes in the order given.

    Buckets are scanned as a whole: what a bucket adds to itself is scanned as a further wave,
    which is the order of a scan entry by entry.
    """
    ends = np.cumsum(size)
    heads = ends - size
    suffixes = np.full(len(text), -1, np.int64)
    order = np.argsort(text[lms], kind="stable")
    bucket = text[lms][order]
    later = np.searchsorted(bucket, bucket, side="right") - np.arange(len(bucket))
    suffixes[ends[bucket] - later] = lms[order]
    lms_in = np.bincount(text[lms], minlength=len(size))
    place = heads.copy()
    used = np.flatnonzero(size)
    for c in used:
        done = heads[c]
        while done < place[c]:
            wave = suffixes[done : place[c]].copy()
            done = place[c]
            _append(text, suffixes, small, False, wave, place, 1)
        _append(text, suffixes, small, False, suffixes[ends[c] - lms_in[c] : ends[c]].copy(), place, 1)
    large_end = place
    place = ends - 1
    for c in used[::-1]:
        done = ends[c] - 1
        while done > place[c]:
            wave = suffixes[place[c] + 1 : done + 1][::-1].copy()
            done = place[c]
            _append(text, suffixes, small, True, wave, place, -1)
        _append(text, suffixes, small, True, suffixes[heads[c] : large_end[c]][::-1].copy(), place, -1)
    suffixes[0] = len(text) - 1
    return suffixes


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks, for reduced strings of too many names to induce by bucket."""
    rank, width, n = names.astype(np.int64), 1, len(names)
    while True:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of text's suffixes in order; text (integers) ends with its unique least symbol 0."""
    n, text = len(text), text.astype(np.int64)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    size = np.bincount(text)
    rough = _induce(text, small, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    in_order = rough[is_lms[rough]]
    # Equal substrings, each from one leftmost-smaller position to the next, get equal names.
    end = np.full(n, n - 1)
    end[lms[:-1]] = lms[1:]
    length = end[in_order] - in_order + 1
    powers = tb._powers(max(21, int(n).bit_length()))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(tb.mix(text.astype(np.uint64), 9) * powers[0][:n], out=prefix[1:])
    hashed = (prefix[in_order + length] - prefix[in_order]) * powers[1][in_order]
    name = np.cumsum(np.append(0, (hashed[1:] != hashed[:-1]) | (length[1:] != length[:-1])))
    if name[-1] + 1 < len(lms):
        named = np.empty(n, np.int64)
        named[in_order] = name
        reduced = named[lms]
        deeper = suffix_array if name[-1] < ALPHABET else _by_doubling
        in_order = lms[deeper(reduced)]
    return _induce(text, small, in_order, size)


def permuted_lcp(text: np.ndarray, first: np.ndarray, second: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of suffixes first[k] and second[k], up to ``most``, by halving on prefix hashes."""
    n = len(text)
    power, inverse = tb._powers(max(21, int(n).bit_length()))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(tb.mix(text.astype(np.uint64), 9) * power[:n], out=prefix[1:])
    low, step = np.zeros(len(first), np.int64), 1 << (most.bit_length() - 1)
    while step:
        longer = np.minimum(low + step, most)
        fits = (first + longer <= n) & (second + longer <= n)
        a, b = first[fits], second[fits]
        w = longer[fits]
        same = (prefix[a + w] - prefix[a]) * inverse[a] == (prefix[b + w] - prefix[b]) * inverse[b]
        low[np.flatnonzero(fits)[same]] = w[same]
        step //= 2
    return low


def repeated_windows(pieces: list[bytes], owned: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each piece, whether each of its first ``owned`` windows occurs again among all pieces' owned windows."""
    data, starts = tb.joined(pieces)
    text = data.astype(np.int64) + 2
    text[starts[1:] - 1] = 1  # between pieces
    order = suffix_array(np.append(text, 0))
    mine = np.zeros(len(text) + 1, bool)
    for s, n in zip(starts, owned):
        mine[s : s + n] = True
    order = order[mine[order]]
    # In text order: the common prefix with the window before in the suffix array.
    plcp = np.zeros(len(text) + 1, np.int64)
    plcp[order[1:]] = permuted_lcp(text, order[:-1], order[1:], window)
    again = plcp >= window
    again[order[:-1]] |= plcp[order[1:]] >= window
    return [again[s : s + n] for s, n in zip(starts, owned)]


# --- segments --------------------------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i that has a whole window."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :])


def segments(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor hash, content hash) of every segment of some texts of one block."""
    data, starts = tb.joined(texts)
    none = np.zeros(0, np.int64)
    if len(data) <= window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = tb.prefix_hash(data)
    place = np.arange(len(data) - ANCHOR + 1)
    hashed = tb.span_hash(prefix, place, place + ANCHOR)
    low = np.uint64((1 << 20) - 1)
    least = _sliding_min((tb.mix(hashed, 41) & ~low) | place.astype(np.uint64), window - ANCHOR + 1)
    anchor = (least & low).astype(np.int64)
    n = len(anchor)  # windows in the whole block
    text = tb.owner(starts)[:n]
    valid = np.arange(n) + window < starts[text + 1]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1] | (text[1:] != text[:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], n)
    count = np.minimum(stop, starts[text[start] + 1] - window) - start
    content = tb.span_hash(prefix, start, start + count + window - 1)
    return text[start], start - starts[text[start]], count, hashed[anchor[start]], content


def _pieces(texts: list[bytes], window: int) -> list[tuple[int, int, bytes]]:
    """(text, offset, bytes): long texts in pieces that share window - 1 bytes, so each window is in one."""
    return [
        (k, at, t[at : at + PIECE + window - 1])
        for k, t in enumerate(texts)
        for at in range(0, max(1, len(t) - window + 1), PIECE)
    ]


SEGMENTS = "key bigint, start bigint, windows int, anchor bigint, content bigint"


def segments_of(docs: DataFrame, window: int) -> DataFrame:
    """Segments of docs (key, text); a task takes texts of one key once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), tb.text_bytes(batch.column("text"))
            fresh = []
            for k, (key, t) in enumerate(zip(keys, texts)):
                if len(t) >= window and key not in seen:
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    fresh.append(k)
            parts = _pieces([texts[k] for k in fresh], window)
            for i, j in tb.blocks([p[2] for p in parts], PIECE):
                which, start, count, anchor, content = segments([p[2] for p in parts[i:j]], window)
                key = np.array([keys[fresh[p[0]]] for p in parts[i:j]], np.int64)
                offset = np.array([p[1] for p in parts[i:j]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[which]),
                        pa.array(start + offset[which]),
                        pa.array(count.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                    ],
                    ["key", "start", "windows", "anchor", "content"],
                )

    return docs.mapInArrow(run, SEGMENTS)


def _with_bytes(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """wanted (key, anchor, start, windows, single, ...) with the bytes of each segment, once for all copies of a text."""
    listed = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "many", "start", "windows", "single")).alias("of"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), tb.text_bytes(batch.column("text"))
            for i, j in tb.blocks(texts):
                out: list[tuple] = []
                for key, t, of in zip(keys[i:j], texts[i:j], batch.column("of").slice(i, j - i).to_pylist()):
                    out += [
                        (key, s["anchor"], s["many"], s["start"], s["windows"], s["single"],
                         t[s["start"] : s["start"] + s["windows"] + window - 1])
                        for s in of
                    ]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(schema.names, row)) for row in out], schema=schema
                )

    schema = pa.schema(
        [("key", pa.int64()), ("anchor", pa.int64()), ("many", pa.bool_()), ("start", pa.int64()),
         ("windows", pa.int32()), ("single", pa.bool_()), ("bytes", pa.binary())]
    )
    ddl = "key bigint, anchor bigint, many boolean, start bigint, windows int, single boolean, bytes binary"
    # Copies of a text are cut to one in each task before the shuffle, which also serves the join.
    return docs.dropDuplicates(["key"]).join(listed, "key").select("key", "text", "of").mapInArrow(cut, ddl)


RUNS = "key bigint, start bigint, windows int"


def _in_shards(parts: DataFrame, window: int) -> DataFrame:
    """Runs (key, start, windows) of repeated windows of single segments, by suffix arrays."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tb.grouped(batches, ["anchor"], SHARD_BYTES, "bytes"):
            owned = table.column("windows").to_numpy()
            again = repeated_windows(table.column("bytes").to_pylist(), owned, window)
            key, start = table.column("key").to_numpy(), table.column("start").to_numpy()
            single = table.column("single").to_pylist()
            out = []
            for k, flags in enumerate(again):
                if single[k] and flags.any():
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
                    out += [(key[k], start[k] + a, b - a) for a, b in zip(edge[::2], edge[1::2])]
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2].astype(np.int32))],
                ["key", "start", "windows"],
            )

    return parts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, RUNS)


def _by_hash(parts: DataFrame, window: int) -> DataFrame:
    """The same for anchors of too many segments, by counting two hashes of each window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            data, starts = tb.joined(batch.column("bytes").to_pylist())
            owned = batch.column("windows").to_numpy()
            which = np.repeat(np.arange(len(owned)), owned)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(owned) - owned, owned)
            at = starts[which] + inner
            hashed = tb.span_hash(tb.prefix_hash(data), at, at + window)
            other = tb.span_hash(tb.prefix_hash(255 - data), at, at + window)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("key").to_numpy()[which]),
                    pa.array(batch.column("start").to_numpy()[which] + inner),
                    pa.array(batch.column("single").to_numpy(zero_copy_only=False)[which]),
                    pa.array(hashed.view(np.int64)),
                    pa.array((other >> np.uint64(32)).astype(np.int64)),
                ],
                ["key", "start", "single", "h", "g"],
            )

    each = parts.mapInArrow(run, "key bigint, start bigint, single boolean, h bigint, g bigint").repartition("h", "g")
    twice = each.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1")
    return each.where("single").join(twice, ["h", "g"]).select("key", "start", F.lit(1).alias("windows"))


def repeated_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, start, windows): runs of repeated windows in docs (key, text), a key for each distinct text.

    Runs of a text that has copies may be missing or repeated: it is repeated as a whole.
    """
    dealt = segments_of(docs, window).repartition("content")
    distinct = dealt.groupBy("content").agg(
        F.count("*").alias("n"), F.min(F.struct("anchor", "key", "start", "windows")).alias("of")
    )
    whole = dealt.join(distinct.where("n > 1").select("content"), "content").select("key", "start", "windows")
    by_anchor = distinct.select("of.*", (F.col("n") == 1).alias("single")).repartition("anchor")
    mixed = (
        by_anchor.groupBy("anchor")
        .agg(F.count("*").alias("k"), F.max("single").alias("any_single"))
        .where("k > 1 and any_single")
        .select("anchor", (F.col("k") > SHARD_SEGMENTS).alias("many"))
    )
    parts = saved(_with_bytes(docs, by_anchor.join(mixed, "anchor"), window))
    runs = _in_shards(parts.where("not many"), window).unionByName(_by_hash(parts.where("many"), window))
    return whole.unionByName(runs)


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, removed array<bigint>, kept binary"


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, removed (flat starts and ends), kept bytes.

    Removed is every byte in a string of ``window`` bytes of UTF-8 that also starts anywhere else,
    in this text or in another row's. A null text is empty; texts shorter than ``window`` stay
    whole. A row that repeats another's text of at least ``window`` bytes is removed whole, as is
    that other one. Other columns are ignored; an empty table gives no rows.
    """
    keyed = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text").alias("key")
    )
    runs = repeated_runs(keyed.where(F.octet_length("text") >= window).select("key", "text"), window)
    copies = saved(
        keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("copied"))
    )
    # Texts with copies go whole and need no runs; the list of any other is bounded by its length.
    own = runs.join(copies, "key", "left_anti")
    listed = own.groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    known = listed.join(copies, "key", "full")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tb.text_bytes(batch.column("text"))
            for i, j in tb.blocks(texts):
                spans, kept = [], []
                for t, runs, copied in zip(
                    texts[i:j],
                    batch.column("runs").slice(i, j - i),
                    batch.column("copied").slice(i, j - i).to_pylist(),
                ):
                    edge = np.zeros(len(t) + 1, np.int64)
                    if copied and len(t) >= window:
                        edge[0], edge[-1] = 1, -1
                    elif runs.is_valid:
                        start = runs.values.field("start").to_numpy()
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + runs.values.field("windows").to_numpy() + window - 1, -1)
                    gone = np.cumsum(edge)[: len(t)] > 0
                    spans.append(np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))))
                    kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        pa.array([len(t) for t in texts[i:j]], pa.int64()),
                        pa.array([int((s[1::2] - s[::2]).sum()) for s in spans], pa.int64()),
                        pa.array([len(s) // 2 for s in spans], pa.int64()),
                        pa.array(spans, pa.list_(pa.int64())),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "removed", "kept"],
                )

    joined = keyed.join(known, "key", "left").select("doc_id", "text", "runs", "copied")
    return joined.mapInArrow(run, KEPT)
