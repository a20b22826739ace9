"""Benchmark decontamination by winnowed fingerprints.

Of the hashes of all k-word runs, the least in each sliding window is kept. A
span of ``window`` words or more that a document shares with a benchmark item
has a fingerprint in both. Fingerprints that meet are extended to the whole
windows around them, which are compared word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from trueform.llm.common import byte_slices, flat_text, saved
from trueform.llm.textbytes import Hashed, U, lower_ascii, runs, shingles, sliding

WINDOW, GRAM = 13, 7
FILTER_BITS = 24  # a bit table of fixed size (2 MB) that drops most fingerprints before the join

_word = np.zeros(256, dtype=bool)
_word[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Words:
    """The words of a batch of texts: lower-cased bytes, spans, hashes, and the words before each row."""

    def __init__(self, texts: pa.Array):
        raw, offsets = flat_text(texts)
        self.raw = lower_ascii(raw)
        self.starts, self.ends, self.first = runs(_word[self.raw], offsets)
        self.hashes = Hashed(self.raw).span(self.starts, self.ends)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def text(self, at: int, n: int) -> str:
        return b" ".join(self.raw[s:e].tobytes() for s, e in zip(self.starts[at:at + n], self.ends[at:at + n])).decode()


def fingerprints(words: Words, gram: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the runs of ``gram`` words that are the least of some window of ``width`` runs."""
    hashes = shingles(words.hashes, gram)
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    inside = words.row[:len(hashes)] == words.row[gram - 1:]
    if width == 1:
        at = np.flatnonzero(inside)
        return at, hashes[at]
    # a window must lie within one row; a run belongs to the result if some such window has no less
    low = sliding(hashes, width, np.minimum) if len(hashes) >= width else np.zeros(0, np.uint64)
    span = gram + width - 1
    whole = words.row[:len(low)] == words.row[span - 1:]
    low = np.where(whole, low, U(0))
    padded = np.zeros(len(hashes) + width - 1, dtype=np.uint64)
    padded[width - 1:width - 1 + len(low)] = low
    at = np.flatnonzero(inside & (sliding(padded, width, np.maximum) == hashes))
    return at, hashes[at]


def window_plan(lengths: set[int], window: int, gram: int) -> list[tuple[int, int, tuple[int, ...]]]:
    """(run length, winnowing width, window lengths) that find every item window.

    Items of at least ``gram`` words share one pass whose width suits the
    shortest of them; shorter items have their own pass over all runs.
    """
    long = sorted({min(n, window) for n in lengths if n >= gram})
    plan = [(n, 1, (n,)) for n in sorted(lengths) if 0 < n < gram]
    return plan + ([(gram, long[0] - gram + 1, tuple(long))] if long else [])


def _slot(hashes: np.ndarray, gram: int) -> np.ndarray:
    return ((hashes + U(gram)) >> U(64 - FILTER_BITS)).astype(np.int64)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, window, n): every run of ``window`` words, or all words of a shorter item."""
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("window", T.StringType()), T.StructField("n", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                words, ids, rows = Words(batch.column("text")), batch.column("item_id").to_pylist(), []
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    n = min(window, int(b - a))
                    rows += [(ids[i], words.text(at, n), n) for at in range(a, b - n + 1) if n]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.string(), pa.int32()))], names=schema.names)

    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(cut, schema).distinct()


def _filter_table(benchmark: DataFrame, plan: list, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit table of the benchmark's fingerprints; its size does not depend on the benchmark's."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                words = Words(batch.column("text"))
                slots = [_slot(h, gram) for gram, width, _ in plan for _, h in [fingerprints(words, gram, width)]]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(slots)) if slots else [], pa.int64())], names=["slot"])

    blocks = (benchmark.select("text").mapInArrow(mark, "slot long").groupBy(F.shiftright("slot", 6).alias("block"))
              .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")))
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    for block, word in blocks.toPandas().itertuples(index=False):  # at most 2**(bits - 6) rows
        table[block] = word
    return table.view(np.uint64)


def document_windows(documents: DataFrame, table: np.ndarray, plan: list) -> DataFrame:
    """Rows (row_key, doc_id, n_words) of all documents, and (row_key, start, n, window) around fingerprints in ``table``."""
    shared = documents.sparkSession.sparkContext.broadcast(table)
    id_type = documents.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("row_key", T.LongType()), T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("window", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, base = shared.value, TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                words = Words(batch.column("text"))
                keys, found = base + np.arange(batch.num_rows), set()
                for gram, width, lengths in plan:
                    at, hashes = fingerprints(words, gram, width)
                    slots = _slot(hashes, gram)
                    at = at[(bits[slots >> 6] >> (slots & 63).astype(np.uint64)) & U(1) == 1]
                    for p in at.tolist():
                        row = words.row[p]
                        low, high = int(words.first[row]), int(words.first[row + 1])
                        for n in lengths:
                            found.update((int(row), s, n) for s in range(max(low, p + gram - n), min(p, high - n) + 1))
                rows = sorted(found)
                m, null = batch.num_rows, [None] * len(rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([keys, keys[[r for r, _, _ in rows]] if rows else keys[:0]]), pa.int64()),
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(len(rows), batch.column("doc_id").type)]),
                    pa.array(np.diff(words.first).tolist() + null, pa.int64()),
                    pa.array([None] * m + [int(s - words.first[r]) for r, s, _ in rows], pa.int64()),
                    pa.array([None] * m + [n for _, _, n in rows], pa.int32()),
                    pa.array([None] * m + [words.text(s, n) for _, s, n in rows], pa.string())], names=schema.names)
                base += m

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  share: int = 20) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit inside any occurrence of an item's window; a document
    is contaminated when it has hits and ``share`` times them reach its words.
    Null or empty text has no words; items without words have no windows; a null
    item_id hits words but is not counted as an item; repeated item rows count
    once; null or repeated doc_id and repeated rows give a row each. Other
    columns are ignored. An empty benchmark hits nothing.
    """
    items = saved(item_windows(benchmark, window), "item-windows")
    lengths = {r[0] for r in items.select("n").distinct().collect()}  # at most ``window`` values
    plan = window_plan(lengths, window, gram)
    rows = saved(document_windows(documents, _filter_table(benchmark, plan), plan), "document-windows")
    windows = rows.filter("window is not null").select("row_key", "start", "n", "window")
    hits = windows.join(items.select("window").distinct(), "window")
    covered = (hits.select("row_key", F.explode(F.expr("sequence(start, start + n - 1)")).alias("word")).distinct()
               .groupBy("row_key").agg(F.count("*").alias("n_hit")))
    named = (windows.select("row_key", "window").distinct().join(items.filter("item_id is not null"), "window")
             .select("row_key", "item_id").distinct()
             .groupBy("row_key").agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    n_hit, ids = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return (rows.filter("n_words is not null").select("row_key", "doc_id", "n_words")
            .join(covered, "row_key", "left").join(named, "row_key", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                    F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                    ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated")))
