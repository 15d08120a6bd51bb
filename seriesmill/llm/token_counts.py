"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton over the vocabulary finds, for every end position, all pieces that end there; dynamic
programming carries the best score and the number of pieces of the best path to each position, and nothing else.

Tie rules are those of the unigram tokenizers: of paths of equal score the one whose last piece starts first stays;
a character without a piece of its own costs the least score of the vocabulary less 10 and counts as its UTF-8
bytes where the vocabulary has byte pieces (else as one, with its neighbours of the same kind).

No piece reaches over a white-space marker, so a text's best path is the joined best paths of its chunks (a run of
markers and what follows it). A Python worker keeps the counts of a bounded number of distinct chunks. That holds for whole-number
scores, whose sums are exact. Sums of other scores are rounded, and so decide ties, by all that comes before: the best
score is then carried along the whole text, chunk after chunk.

Null and empty texts count 0. Texts of any length are counted whole. Rows are independent, so repeated rows and ties between rows
need no rule. Only the key and the text are read, so other columns may have any name; a key named n_tokens is an error. An empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .piece_codec import MARK, Remembered, crosses_marks, distinct_chunks, new_column, processor, slices

#: What an unknown character costs below the least score.
UNKNOWN_PENALTY = 10.0


def vocabulary(model: str) -> tuple[list[tuple[str, float]], bool]:
    """The ordinary pieces of a model file with their scores, and whether it has byte pieces."""
    p = processor(model)
    every = range(p.get_piece_size())
    plain = [i for i in every if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    return [(p.id_to_piece(i), p.get_score(i)) for i in plain], any(map(p.is_byte, every))


class PieceCounter:
    """Counts the pieces of chunks."""

    def __init__(self, pieces: Iterable[tuple[str, float]], has_bytes: bool):
        import ahocorasick

        pieces = list(pieces)
        if crosses_marks(p for p, _ in pieces):
            raise ValueError("a piece crosses a white-space marker; chunks are not independent")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.has_bytes = has_bytes
        self.exact = all(float(s).is_integer() for _, s in pieces)
        self.table = Remembered(lambda chunks: [self.of_chunk(MARK + c.replace(" ", MARK)) for c in chunks])

    def of_chunk(self, chunk: str) -> int:
        """Pieces on the best path through ``chunk``, markers included."""
        if not self.single.issuperset(chunk):
            return self.with_unknown(chunk)
        best, count = [0.0] + [float("-inf")] * len(chunk), [0] * (len(chunk) + 1)
        # Matches come by their end, the longest first: the path whose last piece starts first wins a tie.
        for last, (length, score) in self.automaton.iter(chunk):
            start, end = last + 1 - length, last + 1
            if (total := best[start] + score) > best[end]:
                best[end], count[end] = total, count[start] + 1
        return count[-1]

    def with_unknown(self, chunk: str) -> int:
        """The same for chunks with characters that have no piece of their own."""
        ends: dict[int, list[tuple[int, float]]] = {}
        for last, found in self.automaton.iter(chunk):
            ends.setdefault(last + 1, []).append(found)
        best, count, unknown = [0.0], [0], [False]
        for end in range(1, len(chunk) + 1):
            top, pieces, was = None, 0, False
            for length, score in ends.get(end, ()):
                if top is None or best[end - length] + score > top:
                    top, pieces, was = best[end - length] + score, count[end - length] + 1, False
            char = chunk[end - 1]
            if char not in self.single and (top is None or best[end - 1] + self.unknown > top):
                top, was = best[end - 1] + self.unknown, True
                pieces = count[end - 1] + (len(char.encode()) if self.has_bytes else not unknown[end - 1])
            best.append(top)
            count.append(pieces)
            unknown.append(was)
        return count[-1]

    def of_texts(self, texts: list[str]) -> np.ndarray:
        chunks, which, places = distinct_chunks(texts)
        if not self.exact:
            marked, ends = [MARK + c.replace(" ", MARK) for c in chunks], np.cumsum(places)
            return np.array([self.of_chunk("".join(marked[k] for k in which[lo:hi])) for lo, hi in zip(ends - places, ends)], dtype=np.int64)
        counts = np.array(self.table.of(chunks), dtype=np.int64)
        behind = np.concatenate([[0], np.cumsum(counts[which])])
        return np.diff(behind[np.concatenate([[0], np.cumsum(places)])])


@lru_cache(maxsize=2)
def piece_counter(model: str) -> PieceCounter:
    """The counter of this Python worker: later tasks of the worker find the chunks of earlier ones."""
    return PieceCounter(*vocabulary(model))


def count_tokens(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``key`` and n_tokens."""
    new_column([key], "n_tokens")

    def counts(batches: Iterator[pa.RecordBatch]):
        counter = piece_counter(model)
        for whole in batches:
            for b in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counter.of_texts(b.column(1).to_pylist()))], names=[key, "n_tokens"])

    wanted = docs.select(F.col(key).cast("long").alias(key), text_of(text).alias("text"))
    return wanted.mapInArrow(counts, f"{key} long, n_tokens long")
