"""Language of whole texts by a bidirectional gated recurrent network over their bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled
rows. It labels every byte of a text with a distribution over the learned languages; the mean of
all positions is the document's. A text is cut in runs of RUN bytes, each read from both ends,
so runs of many texts go through the network side by side.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.llm import textblocks as tb
from patchlens.llm.scratch import free

RUN = 128
UNKNOWN = "und"


class ByteGru:
    """Two gated recurrent layers of ``hidden`` units, one for each direction, and a softmax at each position.

    Gates are z (keep) and r (reset), both piecewise linear sigmoids, and c (candidate, x / (1 + |x|));
    a byte selects its row of input weights.
    """

    def __init__(self, classes: int, hidden: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.hidden = hidden

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.weights = {
            f"{name}{d}": value
            for d in "fb"
            for name, value in (
                ("in", normal(256, 3 * hidden, scale=0.2)),
                ("re", normal(hidden, 3 * hidden, scale=hidden**-0.5)),
                ("out", normal(hidden, classes, scale=hidden**-0.5)),
            )
        } | {"bias": np.zeros(classes, np.float32)}

    def states(self, data: np.ndarray, d: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """States [time, hidden, run] of bytes [time, run] read in one direction; what backpropagation needs.

        Runs lie along the last axis, so every operation works on long contiguous rows.
        """
        h, w = self.hidden, self.weights
        steps = range(len(data)) if d == "f" else range(len(data) - 1, -1, -1)
        state = np.zeros((h, data.shape[1]), np.float32)
        out = np.empty((len(data), h, data.shape[1]), np.float32)
        tape = []
        table, recur = np.ascontiguousarray(w[f"in{d}"].T), np.ascontiguousarray(w[f"re{d}"].T)
        data = data.astype(np.intp)
        for t in steps:
            x, a = table.take(data[t], axis=1, mode="clip"), recur @ state
            gates = np.add(x[: 2 * h], a[: 2 * h], out=x[: 2 * h])
            gates += 0.5
            np.clip(gates, 0, 1, out=gates)
            z, r = gates[:h], gates[h:]
            c = x[2 * h :]
            c += r * a[2 * h :]
            c /= np.abs(c) + 1
            if keep:
                tape.append((t, state, z, r, c, a[2 * h :]))
            new = np.subtract(state, c, out=out[t])
            new *= z
            new += c
            state = new
        return out, tape

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities [time, class, run] of every byte of runs [time, run]."""
        w = self.weights
        p = w["outf"].T @ self.states(data, "f")[0]
        p += w["outb"].T @ self.states(data, "b")[0]
        p += w["bias"][:, None]
        np.exp(p, out=p)  # states are within -1 to 1 and weights small, so no overflow
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(
        self, data: np.ndarray, label: np.ndarray, size: np.ndarray | None = None
    ) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions and its gradient, back through time in both directions.

        With size, run k has that many bytes and padding behind them, whose positions do not count.
        """
        h, w = self.hidden, self.weights
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        runs = {d: self.states(data, d, keep=True) for d in "fb"}
        logits = w["outf"].T @ runs["f"][0] + w["outb"].T @ runs["b"][0] + w["bias"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        rows = np.arange(len(label))
        counts = np.ones((len(data), len(label)), bool) if size is None else np.arange(len(data))[:, None] < size
        n = max(1, int(counts.sum()))
        loss = -(np.log(p[:, label, rows] + 1e-9) * counts).sum() / n
        p[:, label, rows] -= 1
        p *= counts[:, None, :]
        p /= n
        grads["bias"] = p.sum(axis=(0, 2))
        for d in "fb":
            states, tape = runs[d]
            grads[f"out{d}"] = np.tensordot(states, p, axes=([0, 2], [0, 2]))
            down = w[f"out{d}"] @ p
            carry = np.zeros((h, data.shape[1]), np.float32)
            gates = np.empty((len(data), 3 * h, data.shape[1]), np.float32)
            recur = np.empty((3 * h, data.shape[1]), np.float32)
            for t, before, z, r, c, ac in reversed(tape):
                gate = gates[t]
                dh = down[t] + carry
                dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
                gate[:h] = dh * (before - c) * ((z > 0) & (z < 1))
                gate[h : 2 * h] = dc * ac * ((r > 0) & (r < 1))
                gate[2 * h :] = dc
                recur[: 2 * h] = gate[: 2 * h]
                recur[2 * h :] = dc * r
                carry = dh * z + w[f"re{d}"] @ recur
                grads[f"re{d}"] += before @ recur.T
            flat, seen = gates.transpose(1, 0, 2).reshape(3 * h, -1), data.ravel()
            for k in range(3 * h):
                grads[f"in{d}"][:, k] = np.bincount(seen, weights=flat[k], minlength=256)
        return float(loss), grads

    def fit(
        self,
        data: np.ndarray,
        label: np.ndarray,
        size: np.ndarray | None = None,
        epochs: int = 8,
        batch: int = 256,
        rate: float = 0.02,
    ) -> None:
        """Adam over shuffled batches; the order is fixed by a seed, so equal samples give equal weights."""
        rng = np.random.default_rng(2)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, steps = 0, epochs * -(-len(data) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                _, grads = self.gradients(
                    np.ascontiguousarray(data[rows].T), label[rows], None if size is None else size[rows]
                )
                step += 1
                pace = rate * (1 - step / (steps + 1))
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    fixed = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                    self.weights[k] -= (pace * fixed).astype(np.float32)


def remainder(name: str, modulus: int):
    """crc32 of a column's text modulo ``modulus``; null for null."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % modulus


def _sample(docs: DataFrame, per_language: int, runs_each: int, length: int) -> list[tuple[str, bytes]]:
    """Labelled runs of bytes: of each language the ``per_language`` rows of least hash, some runs of each."""
    lettered = docs.where("lang is not null and doc_id is not null").where(F.col("text").rlike(r"\p{L}"))
    least = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # dense_rank, so that the limit per task stands below the distinct's shuffle and a repeated id is one.
    ids = (
        lettered.select("doc_id", "lang")
        .withColumn("place", F.dense_rank().over(least))
        .where(F.col("place") <= per_language)
        .select("lang", "doc_id")
        .distinct()
    )
    chosen = [tuple(r) for r in ids.collect()]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = batch.column("lang").to_pylist(), []
            for i, lang, text in zip(batch.column("doc_id").to_pylist(), langs, tb.text_bytes(batch.column("text"))):
                rng = np.random.default_rng(i & 0xFFFFFFFF)
                whole = range(0, max(1, len(text) - length + 1))
                for at in sorted({int(rng.integers(len(whole))) for _ in range(runs_each)}):
                    out.append((lang, text[at : at + length]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], ["lang", "run"]
            )

    # An id may stand on any number of rows: one text of it teaches each of its languages.
    named = lettered.where(F.col("doc_id").isin(sorted({i for _, i in chosen})))
    text = F.min(F.struct(F.xxhash64("text"), "text")).alias("row")
    single = named.groupBy("lang", "doc_id").agg(text).select("doc_id", "lang", "row.text")
    rows = single.join(docs.sparkSession.createDataFrame(chosen, "lang string, doc_id bigint"), ["lang", "doc_id"], "left_semi")
    rows = rows.select("doc_id", "lang", "text")
    return sorted((r.lang, bytes(r.run)) for r in rows.mapInArrow(cut, "lang string, run binary").collect())


def train(
    docs: DataFrame, per_language: int = 300, runs_each: int = 6, length: int = 64, most_languages: int = 200
) -> tuple[list[str], ByteGru | None]:
    """Languages and network fitted on at most ``per_language`` rows a language, ``runs_each`` runs of ``length`` bytes each.

    A text below ``length`` bytes is one run, padded as in scoring, so every sampled row teaches.
    Of rows equal in doc_id and lang, the one of least text hash teaches.
    Rows without lang, doc_id or a letter teach nothing; no labelled row gives no network. More
    than ``most_languages`` languages are refused, as the sample would have no bound.
    """
    languages = sorted(
        r.lang for r in docs.where("lang is not null").select("lang").distinct().limit(most_languages + 1).collect()
    )
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    runs = _sample(docs, per_language, runs_each, length) if languages else []
    if not runs:
        return [], None
    languages = sorted({x[0] for x in runs})
    size = np.array([len(x[1]) for x in runs])
    data = np.frombuffer(b"".join(x[1].ljust(length, b" ") for x in runs), np.uint8).reshape(len(runs), length)
    label = np.searchsorted(np.array(languages), np.array([x[0] for x in runs]))
    model = ByteGru(len(languages))
    model.fit(data, label, size)
    return languages, model


def pooled(model: ByteGru, texts: list[bytes], most: int = 4096) -> np.ndarray:
    """Mean over all positions of each text's distributions; even for an empty text."""
    classes = len(model.weights["bias"])
    total = np.zeros((len(texts), classes))
    pieces = [(k, t[i : i + RUN]) for k, t in enumerate(texts) for i in range(0, len(t), RUN)]
    # Runs go together by length, rounded up so that a run's padding depends on itself alone.
    by_width: dict[int, list[tuple[int, bytes]]] = {}
    for piece in pieces:
        by_width.setdefault(-(-len(piece[1]) // 16) * 16, []).append(piece)
    for width, group in sorted(by_width.items()):
        for at in range(0, len(group), most):
            part = group[at : at + most]
            padded = b"".join(p[1].ljust(width, b" ") for p in part)
            p = model.positions(np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(len(part), width).T))
            size = np.array([len(x[1]) for x in part])
            if size.min() < width:
                p *= (np.arange(width)[:, None] < size)[:, None, :]
            np.add.at(total, [x[0] for x in part], p.sum(axis=0).T)
    size = np.array([len(t) for t in texts])
    total[size == 0] = 1 / classes
    return total / np.maximum(size, 1)[:, None]


def _labelled(batch: pa.RecordBatch, languages: list[str], model: ByteGru | None) -> tuple[list[str], list[float]]:
    """Language and score of each row of a batch with text and _lettered."""
    texts = tb.text_bytes(batch.column("text").cast(pa.string()))
    letters = batch.column("_lettered").to_pylist()
    names, scores = [], []
    for i, j in tb.blocks(texts):
        part = [t if x else b"" for t, x in zip(texts[i:j], letters[i:j])]
        p = np.zeros((j - i, 1)) if model is None else pooled(model, part)
        best = p.argmax(axis=1)
        for k in range(j - i):
            known = model is not None and letters[i + k]
            names.append(languages[best[k]] if known else UNKNOWN)
            scores.append(min(1.0, float(p[k, best[k]])) if known else 0.0)
    return names, scores


def _lettered():
    return F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, languages: list[str], model: ByteGru | None) -> DataFrame:
    """doc_id, lang_pred and score (mean probability of lang_pred, 0 to 1) of each row of docs (doc_id, text).

    A text that is null or has no letter is UNKNOWN with score 0, as is any text without a network.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _labelled(batch, languages, model)
            arrays = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), _lettered().alias("_lettered"))
    return narrow.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def in_a_language(docs: DataFrame, languages: list[str], model: ByteGru | None, least: float) -> DataFrame:
    """docs without the rows that are UNKNOWN or score below ``least``; all columns stay, whatever their names."""
    columns = [f"c{k}" for k in range(len(docs.columns))]
    text = columns[[c.lower() for c in docs.columns].index("text")]
    (lettered,) = free(docs, "_lettered")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = pa.RecordBatch.from_arrays([batch.column(text), batch.column("lettered")], ["text", "_lettered"])
            names, scores = _labelled(read, languages, model)
            keep = [n != UNKNOWN and s >= least for n, s in zip(names, scores)]
            yield batch.select(columns).filter(pa.array(keep, pa.bool_()))

    # Numbered names, as the map takes none with a dot.
    named = docs.withColumn(lettered, _lettered()).toDF(*columns, "lettered")
    return named.mapInArrow(run, docs.toDF(*columns).schema).toDF(*docs.columns)


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Rows whose crc32(doc_id as text) modulo ``folds`` is ``held`` teach nothing and are held_out,
    nor does a null doc_id. Repeated rows give repeated results, other columns are ignored, and
    an empty table gives no rows.
    """
    typed = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"))
    languages, model = train(typed.where(remainder("doc_id", folds) != held))
    held_out = F.coalesce(remainder("doc_id", folds) == held, F.lit(False))
    return predict(typed, languages, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
