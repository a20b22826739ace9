"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each
character; the dynamic programme carries the best score, the number of pieces
and nothing else. Tie rules are those of the unigram tokenizers: paths are
extended from left to right and a later path replaces an earlier one only when
its score is strictly higher, so of equal paths the one with the longest last
piece stays; a character that is no piece of its own costs the lowest score less
ten and counts as its UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 500_000  # units remembered by a Python worker

# pieces never hold a space after another character, nor a line break: the best
# path of a text is the best paths of these units, end to end
_units = re.compile(" *[^ \n]+| +|\n")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """(piece, score) of the ordinary pieces of a vocabulary file.

    The file ranks its pieces; their scores are read as Zipf log probabilities
    -log(rank + 1), ranks counted from the first ordinary piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return tuple((model.id_to_piece(i), -math.log(rank + 1)) for rank, i in enumerate(ids, 1))


class Counter:
    """Piece counts of units, the most of them remembered up to a bound."""

    def __init__(self, pieces: tuple[tuple[str, float], ...], entries: int = CACHE_ENTRIES):
        import ahocorasick

        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p, _ in pieces):
            raise ValueError("a piece crosses the border of a unit")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), score))
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        if len(self.automaton):
            self.automaton.make_automaton()
        self.entries, self.known = entries, {}

    def best(self, text: str) -> tuple[float, int]:
        """(score, pieces) of the best path of one unit, spaces given as the space mark."""
        n = len(text)
        scores, counts = [0.0] + [-math.inf] * n, [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, found in self.automaton.iter(text):
                ends[end].append(found)
        for end in range(n):
            best, count, single = -math.inf, 0, False
            for length, score in sorted(ends[end], reverse=True):
                single = single or length == 1
                start = end + 1 - length
                if scores[start] + score > best:
                    best, count = scores[start] + score, counts[start] + 1
            if not single and scores[end] + self.unknown > best:
                best, count = scores[end] + self.unknown, counts[end] + len(text[end].encode())
            scores[end + 1], counts[end + 1] = best, count
        return scores[n], counts[n]

    def __call__(self, unit: str) -> int:
        n = self.known.get(unit)
        if n is None:
            n = self.best(unit.replace(" ", SPACE))[1]
            if len(self.known) < self.entries:
                self.known[unit] = n
        return n

    def count(self, text: str | None) -> int:
        """Pieces of a whole text with the usual space in front; none for null or empty."""
        return sum(map(self, _units.findall(" " + text))) if text else 0


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """Kept by a Python worker from task to task."""
    return Counter(vocabulary(path))


def token_counts(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, n_bytes (UTF-8) of each row's whole text.

    Null and empty text count 0; null or repeated doc_id and repeated rows are
    carried as they are; other columns are ignored; an empty table gives none.
    """
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("n_bytes", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = batch.column("text")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([counts.count(t) for t in texts.to_pylist()], pa.int64()),
                     pc.binary_length(texts).fill_null(0).cast(pa.int64())], names=schema.names)

    return documents.select("doc_id", "text").mapInArrow(count, schema)
