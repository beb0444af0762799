"""Token counts of a unigram tokenizer by a Viterbi search that carries counts, not tokens.

Text is split before each space (spaces become U+2581, and one is put in front), as the
tokenizer's pre-tokenizer does. In each part an Aho-Corasick automaton enumerates the vocabulary
matches by their end, longest first; each end keeps its best score and the number of pieces of
that path. Ties go to the piece that starts first, because the tokenizer relaxes ends in the
order of starts and replaces a path only for a better one. A character without a piece of its
own may also be unknown, at the least score minus UNKNOWN_PENALTY; neighbouring unknowns are one
token.
"""

from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Parts of text a task remembers with their counts.
REMEMBERED = 600_000
#: Characters up to which a part is remembered: a text without spaces is one part.
LONGEST = 64


def unigram_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model's ordinary pieces, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ordinary = (
        k for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))
    )
    return [(model.id_to_piece(k), model.get_score(k)) for k in ordinary]


class Counter(dict):
    """Part of text to (tokens, score), counted at first sight; parts above LONGEST characters are not remembered."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def __missing__(self, part: str) -> tuple[int, float]:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self.known(part) if self.single.issuperset(part) else self.search(part)
        if len(part) <= LONGEST:
            self[part] = out
        return out

    def known(self, part: str) -> tuple[int, float]:
        """The search where every character is a piece, so no path has unknowns."""
        best = [float("-inf")] * (len(part) + 1)
        best[0] = 0.0
        count = [0] * (len(part) + 1)
        for last, (size, score) in self.matches.iter(part):
            end = last + 1
            path = best[end - size] + score
            if path > best[end]:
                best[end] = path
                count[end] = count[end - size] + 1
        return count[-1], best[-1]

    def search(self, part: str) -> tuple[int, float]:
        ends: list[list[tuple[int, float]]] = [[] for _ in part]
        for last, match in self.matches.iter(part):
            ends[last].append(match)
        best, count, unknown = [0.0], [0], [False]
        for at, character in enumerate(part):
            choice = None
            for size, score in ends[at]:
                path = best[at + 1 - size] + score
                if choice is None or path > choice[0]:
                    choice = (path, count[at + 1 - size] + 1, False)
            if character not in self.single:
                path = best[at] + self.unknown
                if choice is None or path > choice[0]:
                    choice = (path, count[at] + (not unknown[at]), True)
            best.append(choice[0])
            count.append(choice[1])
            unknown.append(choice[2])
        return count[-1], best[-1]

    def text(self, text: str) -> tuple[int, float]:
        """Tokens and best score of a whole text."""
        if not text:
            return 0, 0.0
        marked = text.replace(" ", SPACE)
        if marked[0] != SPACE:
            marked = SPACE + marked
        # Each part starts with the mark that split() takes away.
        found = [self[SPACE + p] for p in marked.split(SPACE)[1:]]
        return sum(n for n, _ in found), sum(s for _, s in found)


@cache
def counter(model_file: str) -> Counter:
    """One for each Python worker, so its memory of parts serves all of the worker's tasks."""
    return Counter(unigram_vocabulary(model_file))


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_chars, n_tokens, score (log of the best path's weight).

    A null or empty text has no tokens and score 0. Repeated rows are counted each, other columns
    are ignored, an empty table gives no rows. Texts of any length are read whole; a part without
    spaces is searched in time and memory proportional to its length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_file)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [count.text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                ["doc_id", "n_chars", "n_tokens", "score"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id bigint, n_chars bigint, n_tokens bigint, score double")
