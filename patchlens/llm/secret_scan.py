"""Secrets in whole texts: fixed patterns, and random strings found by a battery of tests.

A candidate is a run of LEAST_LENGTH or more characters of one encoding (hex, base32, lower or
upper case with digits, alphanumeric, base64 or its URL form), or a part of it between the signs
``+ / _ -``. Under the hypothesis that it is random, its symbols are uniform and independent.
Three tests ask so: chi-squared uniformity over equal parts of the alphabet, as many as its
length can fill, over its classes of characters and over its frequent letters; runs above and below the
alphabet's middle and runs of one class; and serial correlation. Fisher's method combines them. Over all candidates of the corpus, the hypotheses are rejected at a false
discovery rate of RATE with weights in proportion to length, since longer strings tell more.
What is not rejected is reported as random; a part is not reported within a run that is.
"""

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.scratch import saved

LEAST_LENGTH = 20
RATE = 0.05
#: Width of the bins of -log10 p in which the corpus's tests are counted, and the largest value.
BIN, MOST = 0.01, 300.0

# The kinds in their order and the patterns of the base scan.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_LENGTH)
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "lower36": _LOWER + _DIGITS,
    "UPPER36": _UPPER + _DIGITS,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
#: Letters that make up most of words and names, and little of random strings.
_FREQUENT = frozenset("etaoinshrETAOINSHR")
_PART = re.compile(r"[A-Za-z0-9]{%d,}" % LEAST_LENGTH)
_PLACES = {name: {c: k for k, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()}


def encoding(text: str) -> str | None:
    """The smallest encoding whose alphabet has all characters; none for decimal numbers, which are identifiers."""
    used = set(text)
    if used <= set(_DIGITS):
        return None
    return next((name for name, places in _PLACES.items() if used <= places.keys()), None)


def _chi_squared_tail(x: float, freedom: int) -> float:
    """P(X >= x), by Wilson and Hilferty's normal approximation."""
    spread = 2 / (9 * freedom)
    return 0.5 * math.erfc(((max(x, 0) / freedom) ** (1 / 3) - 1 + spread) / math.sqrt(2 * spread))


def _both_tails(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared(part_of: list[int], symbols: list[int]) -> float:
    """p of the symbols' counts in the parts of the alphabet; part_of gives each symbol's part."""
    share, seen = [0] * (max(part_of) + 1), [0] * (max(part_of) + 1)
    for part in part_of:
        share[part] += 1
    for s in symbols:
        seen[part_of[s]] += 1
    expected = [len(symbols) * w / len(part_of) for w in share]
    return _chi_squared_tail(sum((o - e) ** 2 / e for o, e in zip(seen, expected)), len(share) - 1)


def _classes(alphabet: str) -> list[int]:
    """The class of each symbol of the alphabet: upper case and signs, lower case or digits, numbered from 0."""
    kinds = [2 if c in _DIGITS else 1 if c in _LOWER else 0 for c in alphabet]
    return [sorted(set(kinds)).index(k) for k in kinds]


def uniformity(symbols: list[int], alphabet: str) -> float:
    """p of equal use of the alphabet, by classes of characters, by frequent and other letters, and by equal parts.

    A part has about four symbols. The smallest of the three counts three times.
    """
    size = len(alphabet)
    parts = max(2, min(size, len(symbols) // 4))
    classes = _classes(alphabet)
    frequent = [2 if c in _DIGITS else int(c in _FREQUENT) for c in alphabet]
    cuts = (classes, frequent, [k * parts // size for k in range(size)])
    return min(1.0, 3 * min(_chi_squared(cut, symbols) for cut in cuts))


def runs(symbols: list[int], alphabet: str) -> float:
    """p of the number of runs in the halves of the alphabet, and of runs of one class; the smaller counts twice."""
    size = len(alphabet)
    classes = _classes(alphabet)
    share = [classes.count(c) / size for c in range(max(classes) + 1)]
    same = sum(w * w for w in share)
    n = len(symbols)
    changes = sum(classes[a] != classes[b] for a, b in zip(symbols, symbols[1:]))
    # Neighbouring pairs depend on each other by the chance of three alike.
    spread = (n - 1) * same * (1 - same) + 2 * (n - 2) * (sum(w**3 for w in share) - same * same)
    by_class = _both_tails((changes - (n - 1) * (1 - same)) / math.sqrt(spread)) if spread > 0 else 1.0
    return min(1.0, 2 * min(by_class, _runs_of_halves(symbols, size)))


def _runs_of_halves(symbols: list[int], size: int) -> float:
    high = [2 * s >= size for s in symbols]
    up = sum(high)
    down, n = len(high) - up, len(high)
    if not up or not down:
        return 2.0 ** (1 - n)  # all in one half
    mean = 2 * up * down / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    changes = 1 + sum(a != b for a, b in zip(high, high[1:]))
    return _both_tails((changes - mean) / math.sqrt(spread)) if spread > 0 else 1.0


def serial(symbols: list[int]) -> float:
    """p of the correlation of neighbouring symbols."""
    n = len(symbols)
    mean = sum(symbols) / n
    total = sum((s - mean) ** 2 for s in symbols)
    if not total:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(symbols, symbols[1:])) / total
    return _both_tails((r + 1 / n) * math.sqrt(n))


def evidence(text: str) -> float | None:
    """-log10 of the combined p that text is random in its encoding, 0 to MOST; None without an encoding."""
    name = encoding(text)
    if name is None:
        return None
    symbols = [_PLACES[name][c] for c in text]
    tests = (uniformity(symbols, ENCODINGS[name]), runs(symbols, ENCODINGS[name]), serial(symbols))
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    # Fisher: twice this is chi-squared with six degrees of freedom, whose tail is elementary.
    return min(MOST, (half - math.log(1 + half + half * half / 2)) / math.log(10))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points."""
    out = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


_SPAN = "struct<start: bigint, kind: int, end: bigint>"
_TEST = "struct<start: bigint, end: bigint, length: int, against: double, run_length: int, run_against: double>"
_FOUND = f"doc_id bigint, base array<{_SPAN}>, tested array<{_TEST}>"


def candidates(text: str) -> Iterator[dict]:
    """Every candidate with the evidence against its being random, and for a part those of the run around it."""
    for m in _CANDIDATE.finditer(text):
        core = m[0].rstrip("=")
        against = evidence(core)
        run = {"run_length": None, "run_against": None}
        if against is not None:
            yield {"start": m.start(), "end": m.end(), "length": len(core), "against": against, **run}
            run = {"run_length": len(core), "run_against": against}
        for part in _PART.finditer(core):
            if len(part[0]) < len(core) and (against := evidence(part[0])) is not None:
                at = {"start": m.start() + part.start(), "end": m.start() + part.end()}
                yield {**at, "length": len(part[0]), "against": against, **run}


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: base spans, and every candidate with the evidence against its being random."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        test = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("length", pa.int32()), ("against", pa.float64()), ("run_length", pa.int32()), ("run_against", pa.float64())])
        for batch in batches:
            base, tested = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in base_spans(text)])
                tested.append(list(candidates(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(tested, pa.list_(test))],
                ["doc_id", "base", "tested"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, _FOUND)


def _weighted(length, against, mean: float):
    """-log10 of a candidate's p divided by its weight, its length over the mean length."""
    return against + F.log10(length / F.lit(mean))


def rejection(found: DataFrame, rate: float = RATE) -> tuple[float, float]:
    """Mean length of all candidates, and the weighted evidence from which on they are not random.

    Benjamini and Hochberg's step-up over the counts in bins of width BIN: a bin counts whole or
    not at all, on the strict side. Infinite where nothing is rejected.
    """
    each = found.select(F.explode("tested").alias("t")).select("t.length", "t.against")
    mean = each.agg(F.avg("length")).first()[0]
    if mean is None:
        return 1.0, math.inf
    place = F.floor(_weighted(F.col("length"), F.col("against"), mean) / BIN).cast("int")
    # At most (MOST + 10) / BIN bins, however many candidates.
    bins = sorted(((r.bin, r.n) for r in each.groupBy(place.alias("bin")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, above, cut = sum(n for _, n in bins), 0, math.inf
    for number, n in bins:
        above += n
        if 10.0 ** (-number * BIN) <= rate * above / total:
            cut = number * BIN
    return float(mean), cut


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, base and spans, arrays of (start, kind, end).

    kind is a place in KINDS; start and end count code points, end exclusive; spans are base
    ones and random strings, by start and kind. A null text is empty. Repeated rows give repeated
    results and count in the corpus's rate; other columns are ignored; an empty table gives no rows.
    """
    found = saved(scan(docs))
    mean, cut = rejection(found, rate)
    passes = lambda length, against: _weighted(length, against, mean) < F.lit(cut)
    alone = lambda t: ~F.coalesce(passes(t["run_length"], t["run_against"]), F.lit(False))
    random = F.filter("tested", lambda t: passes(t["length"], t["against"]) & alone(t))
    added = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return found.select("doc_id", "base", F.sort_array(F.concat("base", added.cast(f"array<{_SPAN}>"))).alias("spans"))


def as_text(spans):
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def count_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
