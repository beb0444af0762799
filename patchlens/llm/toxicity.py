"""Toxicity of whole texts by a convolutional network over hashed word embeddings.

A word's embedding is two halves, picked from two tables by independent hashes, so two words
have the same embedding only if both hashes agree. Filters of several widths slide over a text's
words; each filter's maximum over the text is a feature of a logistic output. The network is
started in numpy on a bounded sample. Then all labelled texts teach it, whole, in parts that learn
side by side and whose changes Spark averages. Its decision threshold is calibrated for each language, by
all rows set apart for that; the language is that of the nearest mean byte histogram of all labelled texts, so a
text alone decides its score.
"""

import copy
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm import textblocks as tb
from patchlens.llm.language import remainder
from patchlens.llm.scratch import dropped, saved

WIDTHS = (1, 2, 3)
#: Scale of untrained embeddings: small, so that a word the sample lacks says next to nothing.
START = 0.01
#: Texts of the sample in which a word must stand for its embedding to be trained.
LEAST_TEXTS = 3
#: A score of this or more marks a text as toxic.
CUT = 0.7
#: Words of a text in the training sample; longer texts teach nothing, but are scored whole.
MOST_WORDS = 1500
#: Texts of a step, and of a part whose steps follow each other; the parts' changes are averaged.
BATCH = 64
PART = 4000
#: Times that all labelled texts teach after the sample.
ROUNDS = 2
#: Steps of a unit in which logits are counted for the thresholds, up to MOST_LOGIT from zero.
FINE = 256
MOST_LOGIT = 64


class ConvNet:
    """Word hashes to a logit: embeddings, filters of WIDTHS, maximum over the text, linear output."""

    def __init__(self, bits: int = 18, half: int = 8, filters: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bits, self.half, self.filters = bits, half, filters
        # The last row of each table is the padding after a text.
        self.tables = rng.normal(0, START, (2, (1 << bits) + 1, half)).astype(np.float32)
        self.tables[:, -1] = 0
        shifts = sum(WIDTHS)
        self.kernel = rng.normal(0, (2 * half) ** -0.5, (2 * half, shifts * filters)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * filters, np.float32)
        self.out = rng.normal(0, 0.1, len(WIDTHS) * filters).astype(np.float32)
        self.base = np.float32(0)

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """[2, word] rows of the tables."""
        mask = np.uint64((1 << self.bits) - 1)
        return np.stack([tb.mix(hashes, 21) & mask, tb.mix(hashes, 22) & mask]).astype(np.int32)

    def padded(self, rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """rows with max(WIDTHS) paddings after each text, and where each text starts."""
        pad = max(WIDTHS)
        texts = len(bounds) - 1
        out = np.full((2, rows.shape[1] + pad * texts), 1 << self.bits, np.int32)
        out[:, np.arange(rows.shape[1]) + pad * tb.owner(bounds)] = rows
        return out, bounds[:-1] + pad * np.arange(texts)

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.tables[0].take(rows[0], axis=0), self.tables[1].take(rows[1], axis=0)], axis=1)

    def convolve(self, embedded: np.ndarray) -> np.ndarray:
        """[word, filter] responses of all filters to the words from each word on."""
        n, f = len(embedded), self.filters
        each = embedded @ self.kernel
        out = np.empty((n, len(WIDTHS) * f), np.float32)
        column = 0
        for k, width in enumerate(WIDTHS):
            part = out[:, k * f : (k + 1) * f]
            part[:] = self.bias[k * f : (k + 1) * f]
            for shift in range(width):
                part[: n - shift] += each[shift:, column : column + f]
                column += f
        return out

    def logits(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """One logit a text; a text without words has that of padding."""
        rows, starts = self.padded(self.buckets(hashes), bounds)
        response = self.convolve(self.embed(rows))
        # Words that start in the padding belong to no text, but for the one place of an empty text.
        sizes = np.maximum(np.diff(bounds), 1)
        ranges = np.stack([starts, starts + sizes], axis=1).ravel()
        top = np.maximum.reduceat(response, ranges, axis=0)[::2]
        return np.maximum(top, 0) @ self.out + self.base

    def begin(self) -> None:
        """Adagrad's sums of squares before the first step."""
        self.seen = {k: np.full_like(getattr(self, k), 1e-3) for k in ("tables", "kernel", "bias", "out")}
        self.seen["base"] = np.float32(1e-3)

    def step(self, rows: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weight: np.ndarray, rate: float = 0.03):
        """One step of Adagrad on the weighted logistic loss of a batch; only the words that hold a maximum get a gradient.

        Returns rows of the tables and the text that pulled on them, as [2, pull] and [pull].
        """
        f, half, seen = self.filters, self.half, self.seen
        rows, starts = self.padded(rows, bounds)
        embedded = self.embed(rows)
        response = self.convolve(embedded)
        sizes = np.maximum(np.diff(bounds), 1)
        where = np.stack([s + response[s : s + n].argmax(axis=0) for s, n in zip(starts, sizes)])
        top = np.take_along_axis(response, where, axis=0)
        hidden = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-(hidden @ self.out + self.base)))
        error = ((p - labels) * weight / len(labels)).astype(np.float32)
        down = error[:, None] * self.out * (top > 0)
        grads = {"out": hidden.T @ error, "bias": down.sum(axis=0), "base": error.sum()}
        kernel = np.zeros_like(self.kernel)
        touched, pulls, texts = [], [], []
        column = 0
        for k, width in enumerate(WIDTHS):
            own = down[:, k * f : (k + 1) * f]
            for shift in range(width):
                place = where[:, k * f : (k + 1) * f] + shift
                kernel[:, column : column + f] = np.einsum("dfe,df->ef", embedded[place], own)
                pull = own[:, :, None] * self.kernel[:, column : column + f].T
                live = own != 0
                touched.append(place[live])
                pulls.append(pull[live])
                texts.append(np.nonzero(live)[0])
                column += f
        grads["kernel"] = kernel
        for name, g in grads.items():
            seen[name] = seen[name] + g * g
            setattr(self, name, getattr(self, name) - rate * g / np.sqrt(seen[name]))
        place, pull = np.concatenate(touched), np.concatenate(pulls)
        for h in range(2):
            row, which = np.unique(rows[h, place], return_inverse=True)
            g = np.zeros((len(row), half), np.float32)
            np.add.at(g, which, pull[:, h * half : (h + 1) * half])
            g[row == 1 << self.bits] = 0
            seen["tables"][h, row] += g * g
            self.tables[h, row] -= 5 * rate * g / np.sqrt(seen["tables"][h, row])
        return rows[:, place], np.concatenate(texts)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = 6, batch: int = BATCH, rate: float = 0.03):
        """Steps over shuffled batches, toxic and clean texts of equal weight together."""
        rng = np.random.default_rng(3)
        weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
        self.begin()
        # A word of very few texts teaches only to know those texts: it trains as padding.
        word, count = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
        common = word[count >= LEAST_TEXTS]
        rows_of = [np.where(np.isin(t, common), self.buckets(t), 1 << self.bits).astype(np.int32) for t in texts]
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                bounds = np.concatenate([[0], np.cumsum([len(texts[k]) for k in chosen])])
                self.step(np.concatenate([rows_of[k] for k in chosen], axis=1), bounds, labels[chosen], weight[chosen], rate)

    def dense(self) -> np.ndarray:
        """All parameters but the tables, as rows of the tables' width with zeros behind."""
        flat = np.concatenate([self.kernel.ravel(), self.bias, self.out, [self.base]]).astype(np.float32)
        return np.concatenate([flat, np.zeros(-len(flat) % self.half, np.float32)]).reshape(-1, self.half)

    def set_dense(self, rows: np.ndarray) -> None:
        flat = rows.ravel().astype(np.float32)
        a, b = self.kernel.size, self.kernel.size + self.bias.size
        self.kernel, self.bias = flat[:a].reshape(self.kernel.shape), flat[a:b]
        self.out, self.base = flat[b : b + self.out.size], flat[b + self.out.size]


class Learner:
    """A copy of a network that makes steps on the texts of one part, and what they changed."""

    def __init__(self, net: ConvNet):
        self.given, self.net, self.texts = net, copy.deepcopy(net), 0
        self.pulled = np.zeros(net.tables.shape[:2], np.int32)

    def step(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> None:
        hashes, bounds = tb.words(texts, tb.ALNUM)
        rows, text = self.net.step(self.net.buckets(hashes), bounds, labels, weight)
        for h in range(2):
            once = np.unique(rows[h].astype(np.int64) * len(texts) + text)
            np.add.at(self.pulled[h], once // len(texts), 1)
        self.texts += len(texts)

    def changes(self) -> pa.RecordBatch:
        """CHANGES: of each table row (kind 0, 1) the texts that pulled on it, of the rest (kind 2) all texts; times the change."""
        rows, counts, moved = [], [], []
        for h in range(2):
            at = np.flatnonzero(self.pulled[h, :-1])
            rows.append(at)
            counts.append(self.pulled[h, at])
            moved.append(self.net.tables[h, at] - self.given.tables[h, at])
        moved.append(self.net.dense() - self.given.dense())
        rows.append(np.arange(len(moved[2])))
        counts.append(np.full(len(moved[2]), self.texts))
        kinds = np.repeat([0, 1, 2], [len(r) for r in rows])
        n = np.concatenate(counts).astype(np.int64)
        change = np.concatenate(moved) * n[:, None]
        columns = [kinds.astype(np.int32), np.concatenate(rows).astype(np.int32), n, *change.T.astype(np.float32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "row", "n", *_moved(self.net.half)])


def _moved(half: int) -> list[str]:
    return [f"v{k}" for k in range(half)]


def byte_histograms(texts: list[bytes]) -> np.ndarray:
    """Square roots of each text's byte shares, of length 1 (0 for an empty text)."""
    data, starts = tb.joined(texts)
    seen = np.bincount(tb.owner(starts) * 256 + data, minlength=256 * len(texts))
    shares = seen.reshape(len(texts), 256).astype(np.float32)
    shares[:, 10] -= 1
    return np.sqrt(shares / np.maximum(shares.sum(axis=1, keepdims=True), 1))


class Model:
    """The network, the mean histograms of languages, and each language's threshold on the logit."""

    def __init__(self, net: ConvNet, centres: np.ndarray, thresholds: np.ndarray):
        self.net, self.centres, self.thresholds = net, centres, thresholds

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """0 to 1; exactly CUT at the threshold of the text's nearest language."""
        hashes, bounds = tb.words(texts, tb.ALNUM)
        logit = self.net.logits(hashes, bounds).astype(np.float64)
        language = (byte_histograms(texts) @ self.centres.T).argmax(axis=1)
        above = logit - self.thresholds[language]
        score = 1 / (1 + np.exp(-np.clip(above, -500, 500)) * (1 - CUT) / CUT)
        return np.where(above >= 0, np.maximum(score, CUT), np.minimum(score, np.nextafter(CUT, 0)))


def threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The cut with the best F1, in the middle of the widest gap that keeps it. counts: how many rows each stands for."""
    order = np.argsort(-logits, kind="stable")
    counts = np.ones(len(logits), np.int64) if counts is None else counts[order]
    logits, hits = logits[order], np.cumsum(labels[order] * counts)
    last = np.append(logits[1:] < logits[:-1], True)
    f1 = np.where(last, 2 * hits / (np.cumsum(counts) + hits[-1]), -1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    below = np.append(logits[1:], logits[-1] - 2)
    k = best[np.argmax(logits[best] - below[best])]
    return float((logits[k] + below[k]) / 2)


def _fit(rows: list[tuple[str | None, int, np.ndarray, np.ndarray, bool]]) -> Model:
    """rows: lang, label, word hashes, byte histogram, whether the row calibrates rather than teaches."""
    net = ConvNet()
    teach = [r for r in rows if not r[4]] or rows
    net.fit([r[2] for r in teach], np.array([r[1] for r in teach], np.float32))
    check = [r for r in rows if r[4]] or rows
    bounds = np.concatenate([[0], np.cumsum([len(r[2]) for r in check])])
    logit = net.logits(np.concatenate([r[2] for r in check]), bounds)
    label = np.array([r[1] for r in check])
    languages = sorted({r[0] for r in rows if r[0] is not None}) or [None]
    of = lambda name: [r[3] for r in rows if r[0] == name or name is None]
    centres = np.stack([np.mean(of(x), axis=0) for x in languages])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    nearest = (np.stack([r[3] for r in check]) @ centres.T).argmax(axis=1)
    overall = threshold(logit, label) if label.any() else float(logit.max()) + 1
    cuts = []
    for k in range(len(languages)):
        own = nearest == k
        # A language without enough of both kinds keeps the threshold of all.
        enough = label[own].sum() >= 10 and (1 - label[own]).sum() >= 10
        cuts.append(threshold(logit[own], label[own]) if enough else overall)
    return Model(net, centres, np.array(cuts))


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = 1500, most_clean: int = 2500) -> Model:
    """A first fit, on at most ``most_toxic`` and ``most_clean`` labelled rows of up to MOST_WORDS words each, by least hash.

    Of the rows that share
    a doc_id, the one of least text hash teaches. A document with several labels counts as toxic if one says so; null labels say nothing. A
    fifth of the sample (by hash) calibrates the thresholds. Without any label every score is low.
    """
    marked = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    named = docs.select("doc_id").join(marked, "doc_id").distinct()
    picked = {
        r.doc_id: int(r.toxic)
        for kind, most in ((1, most_toxic), (0, most_clean))
        for r in named.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    }

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tb.text_bytes(batch.column("text"))
            for i, j in tb.blocks(texts):
                words, bounds = tb.words(texts[i:j], tb.ALNUM)
                lists = [words[a:b].view(np.int64) if b - a <= MOST_WORDS else None for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        batch.column("lang").slice(i, j - i),
                        pa.array(lists, pa.list_(pa.int64())),
                        pa.array(list(byte_histograms(texts[i:j])), pa.list_(pa.float32())),
                    ],
                    ["doc_id", "lang", "words", "bytes"],
                )

    # An id may stand on any number of rows: it teaches by one of them, so the sample keeps its bound.
    row = F.min(F.struct(F.xxhash64("text"), "lang", "text")).alias("row")
    sample = docs.where(F.col("doc_id").isin(list(picked))).groupBy("doc_id").agg(row).select("doc_id", "row.lang", "row.text")
    found = sample.mapInArrow(hashed, "doc_id bigint, lang string, words array<bigint>, bytes array<float>")
    table = found.where("words is not null").toArrow().sort_by("doc_id")
    rows = []
    for k in range(len(table)):
        i = table.column("doc_id")[k].as_py()
        words = table.column("words")[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
        shares = table.column("bytes")[k].values.to_numpy(zero_copy_only=False)
        rows.append((table.column("lang")[k].as_py(), picked[i], words, shares, bool(_apart(np.array([i]))[0])))
    if not any(r[1] for r in rows):
        return Model(ConvNet(), np.zeros((1, 256), np.float32), np.array([1e6]))
    return _fit(rows)


def _apart(ids: np.ndarray) -> np.ndarray:
    """Which ids calibrate the thresholds and teach nothing else: a fifth."""
    return tb.mix(ids.astype(np.uint64), 31) % np.uint64(5) == 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, lang, text of every labelled id, once each, by the rules of ``train``."""
    marked = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    row = F.min(F.struct(F.xxhash64("text"), "lang", "text")).alias("row")
    known = marked.where(F.col("toxic").isin(0, 1))
    return docs.groupBy("doc_id").agg(row).join(known, "doc_id").select("doc_id", "toxic", "row.lang", "row.text")


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """Part, texts and labels of each step: rows that follow each other in a part, at most BATCH and some megabytes."""
    part, texts, labels, size = -1, [], [], 0
    for batch in batches:
        use = ~_apart(batch.column("doc_id").to_numpy())
        rows = zip(use, batch.column("part").to_pylist(), tb.text_bytes(batch.column("text")), batch.column("toxic").to_pylist())
        for teaches, own, text, label in rows:
            if not teaches:
                continue
            if texts and (own != part or len(texts) == BATCH or size + len(text) > tb.BLOCK_BYTES):
                yield part, texts, labels
                texts, labels, size = [], [], 0
            part = own
            texts.append(text)
            labels.append(int(label == 1))
            size += len(text)
    if texts:
        yield part, texts, labels


def taught(net: ConvNet, rows: DataFrame, of: dict[int, int]) -> ConvNet:
    """net after one more round over all rows (doc_id, toxic, text), of which ``of`` has the numbers by label.

    Each part of about PART rows, dealt by id, makes its steps from net on; a parameter moves by the mean change over the
    texts that pulled on it. A row of the tables that fewer than LEAST_TEXTS texts pulled on stays: it would learn to know them.
    """
    parts = -(-sum(of.values()) // PART)
    weight = np.array([sum(of.values()) / max(1, 2 * of.get(k, 0)) for k in (0, 1)])
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, learner = -1, None
        for own, texts, label in _steps(batches):
            if own != part:
                if learner is not None:
                    yield learner.changes()
                part, learner = own, Learner(shared.value)
            learner.step(texts, np.array(label), weight[label])
        if learner is not None:
            yield learner.changes()

    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")
    dealt = rows.select(part, "doc_id", "toxic", "text").repartition(parts, "part").sortWithinPartitions("part", "doc_id")
    moved = _moved(net.half)
    changes = dealt.mapInArrow(run, ", ".join(["kind int, row int, n bigint", *(f"{v} float" for v in moved)]))
    table = changes.groupBy("kind", "row").agg(F.sum("n").alias("n"), *(F.sum(v).cast("float").alias(v) for v in moved)).toArrow()
    shared.unpersist()
    kind, row, n = (table.column(c).to_numpy() for c in ("kind", "row", "n"))
    change = np.stack([table.column(v).to_numpy() for v in moved], axis=1) / np.maximum(n, 1)[:, None]
    out = copy.deepcopy(net)
    for h in range(2):
        at = (kind == h) & (n >= LEAST_TEXTS)
        out.tables[h, row[at]] += change[at]
    dense, at = out.dense(), kind == 2
    dense[row[at]] += change[at]
    out.set_dense(dense)
    return out


def centres(rows: DataFrame) -> np.ndarray:
    """Mean byte histogram, of length 1, of each language of rows (lang, text), or of all rows if none has a language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts, sums = tb.text_bytes(batch.column("text")), {}
            for i, j in tb.blocks(texts):
                shares = byte_histograms(texts[i:j]).astype(np.float64)
                for lang in set(langs[i:j]):
                    sums[lang] = sums.get(lang, 0) + shares[langs[i:j] == lang].sum(axis=0)
            names = [lang for lang in sums for _ in range(256)]
            total = np.concatenate([np.zeros(0), *sums.values()])
            byte = np.tile(np.arange(256, dtype=np.int32), len(sums))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(byte), pa.array(total)], ["lang", "byte", "total"])

    summed = rows.select("lang", "text").mapInArrow(run, "lang string, byte int, total double")
    found = summed.groupBy("lang", "byte").agg(F.sum("total").alias("total")).collect()
    languages = sorted({r.lang for r in found if r.lang is not None}) or [None]
    place = {name: k for k, name in enumerate(languages)}
    out = np.zeros((len(languages), 256))
    for r in found:
        if r.lang in place:
            out[place[r.lang], r.byte] = r.total
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def calibrated(net: ConvNet, rows: DataFrame) -> Model:
    """The network with the centres of all rows (doc_id, toxic, lang, text) and the thresholds of all that are set apart.

    Logits are counted in steps of 1 / FINE by language and label; the driver gets these counts.
    """
    middle = centres(rows)
    shared = rows.sparkSession.sparkContext.broadcast((net, middle))

    def counted(every: bool) -> list:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, middle = shared.value
            for batch in batches:
                use = _apart(batch.column("doc_id").to_numpy()) | every
                batch = batch.filter(pa.array(use))
                texts, labels = tb.text_bytes(batch.column("text")), batch.column("toxic")
                for i, j in tb.blocks(texts):
                    logit = net.logits(*tb.words(texts[i:j], tb.ALNUM)).astype(np.float64)
                    language = (byte_histograms(texts[i:j]) @ middle.T).argmax(axis=1).astype(np.int32)
                    fine = np.floor(np.clip(logit, -MOST_LOGIT, MOST_LOGIT) * FINE).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(language), pa.array(fine), labels.slice(i, j - i)], ["language", "fine", "toxic"]
                    )

        made = rows.select("doc_id", "toxic", "text").mapInArrow(run, "language int, fine int, toxic int")
        return made.groupBy("language", "fine", "toxic").count().collect()

    found = counted(False) or counted(True)
    language, fine, label, n = (np.array([r[k] for r in found]) for k in range(4))
    logit, label = (fine + 0.5) / FINE, (label == 1).astype(np.int64)
    overall = threshold(logit, label, n) if label.any() else float(logit.max()) + 1
    cuts = []
    for k in range(len(middle)):
        own = language == k
        # A language without enough of both kinds keeps the threshold of all.
        enough = (label * n)[own].sum() >= 10 and ((1 - label) * n)[own].sum() >= 10
        cuts.append(threshold(logit[own], label[own], n[own]) if enough else overall)
    shared.unpersist()
    return Model(net, middle, np.array(cuts))


def train_on_all(docs: DataFrame, labels: DataFrame) -> Model:
    """``train``, after which every labelled row teaches or calibrates, whole. Without any toxic label every score is low."""
    model = train(docs, labels)
    rows = saved(labelled(docs, labels))
    of = {int(r.toxic == 1): r["count"] for r in rows.groupBy((F.col("toxic") == 1).alias("toxic")).count().collect()}
    if of.get(1):
        net = model.net
        if not hasattr(net, "seen"):  # all toxic texts were too long for the sample
            net.begin()
        for _ in range(ROUNDS):
            net = taught(net, rows, of)
        del net.seen  # of no use for scores
        model = calibrated(net, rows)
    dropped(rows)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs (doc_id, text); null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tb.text_bytes(batch.column("text"))
            for i, j in tb.blocks(texts):
                scores = pa.array(shared.value.scores(texts[i:j]), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), scores], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, held_out, score, predicted.

    Labels of rows whose crc32(doc_id as text) modulo ``folds`` is ``held`` teach nothing; such rows
    are held_out. predicted is 1 from a score of CUT on. Repeated rows give repeated results, a null
    doc_id is not held out and teaches nothing, other columns are ignored, an empty table gives no rows.
    """
    typed = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"))
    known = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
    may_teach = remainder("doc_id", folds) != held
    model = train_on_all(typed.where(may_teach), known.where(may_teach))
    held_out = F.coalesce(remainder("doc_id", folds) == held, F.lit(False))
    return score(typed, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
