"""Whole texts of Arrow batches as blocks of bytes, their words and 64-bit hashes, in numpy.

A block holds some megabytes of whole texts; a longer text is a block of its own. All hashes
depend on bytes only, so they agree between tasks, retries and runs.
"""

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5
U64 = np.uint64


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser of 64-bit values; ``salt`` gives independent functions."""
    x = x ^ U64((salt * 0xA0761D6478BD642F + 0xE7037ED1A0B428DB) & (2**64 - 1))
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


_BYTE = mix(np.arange(256, dtype=U64), 7)


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for 2**bits positions."""

    def up(base: int) -> np.ndarray:
        p = np.full(1 << bits, base, U64)
        p[0] = 1
        return np.cumprod(p)

    return up(_BASE), up(pow(_BASE, -1, 2**64))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hash` gets the hash of any span of data in constant time."""
    out = np.zeros(len(data) + 1, U64)
    power, _ = _powers(max(21, int(len(data)).bit_length()))
    np.cumsum(_BYTE[data] * power[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = _powers(max(21, int(len(prefix) - 1).bit_length()))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; null gives none."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of texts of at most ``most`` bytes together, or one text."""
    i = size = 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > most:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a line feed after each, and where each starts (one more entry at the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), starts


def lower_table() -> np.ndarray:
    """Byte to byte, A-Z lowered."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


#: Anything but space, tab, line feed, vertical tab, form feed and carriage return.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Digits, ASCII letters, and every byte of a character beyond ASCII.
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = lower_table()


#: Bytes up to which a word is mixed eight bytes at a time; a longer one is digested whole.
LONG_WORD = 64


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the spans of data, from all their bytes; no sum over positions in which structured words cancel out.

    Each step mixes eight bytes into the hash so far, from the length on, so that two words of one length of
    at most eight bytes never share a hash. Words above LONG_WORD bytes have the first half of a 128-bit BLAKE2b digest.
    """
    size = last - first
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = mix(size.astype(U64), 11)
    at = np.flatnonzero(size <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        part = np.ascontiguousarray(eight[first[at] + k]).view("<u8")[:, 0]
        spare = U64(8) * (U64(8) - np.minimum(size[at] - k, 8).astype(U64))
        out[at] = mix(out[at] ^ (part << spare >> spare), 12 + k)
    for w in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(data[first[w] : last[w]], digest_size=16).digest()
        out[w] = int.from_bytes(digest[:8], "little")
    return out


def words(texts: list[bytes], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes in ``kind``, A-Z lowered), and each text's range of them.

    The line feed between two texts belongs to neither kind, so no word crosses texts.
    """
    data, starts = joined(texts)
    inside = np.concatenate(([False], kind[data]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    return word_hashes(_LOWER[data], first, last), np.searchsorted(first, starts)


def owner(bounds: np.ndarray) -> np.ndarray:
    """For each item, the index of the range [bounds[k], bounds[k+1]) that holds it."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ngrams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's n-word runs (a shorter text's whole sequence, none if empty), and their text."""
    texts = owner(bounds)
    left = bounds[texts + 1] - np.arange(len(hashes))
    size = np.minimum(n, np.diff(bounds))[texts]
    at = np.flatnonzero(left >= size)
    out = mix(hashes[at] + U64(1), 1)
    for k in range(1, n):
        more = size[at] > k
        out[more] = mix(out[more] * U64(0x9FB21C651E98DF25) + hashes[at[more] + k], 2)
    return out, texts[at]


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str], most: int, weigh: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by the keys, each of about ``most`` bytes of ``weigh``.

    A group of more bytes comes alone. Callers bound their groups.
    """
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        held.append(table)
        size += table.column(weigh).nbytes
        if size < most:
            continue
        whole = pa.concat_tables(held)
        last = [whole.column(k)[-1].as_py() for k in keys]
        cut = len(whole)
        while cut and [whole.column(k)[cut - 1].as_py() for k in keys] == last:
            cut -= 1
        if cut:
            yield whole.slice(0, cut).combine_chunks()
        held = [whole.slice(cut)]
        size = held[0].column(weigh).nbytes if cut else size
    if held:
        whole = pa.concat_tables(held).combine_chunks()
        if len(whole):
            yield whole
