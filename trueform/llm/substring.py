"""Substring dedup by line hashing.

Texts are cut into lines. A unit is the shortest run of whole lines, from a line
with words on, that holds at least ``MIN_WORDS`` words: a long line alone, or
short lines together. Units' normalised forms are digested; the digests meet in
one grouped aggregation; the occurrence in the document of least id, and there
the first, stays. The lines of all later ones are cut from their texts, and what
is kept remembers where it stood.

A short line (heading, list item, refrain) is so never judged alone, as it
repeats between documents that share nothing else, but as part of the passage
that it begins, continues or ends.

A passage need not begin or end with a line. ``passage_dedup`` cuts, besides those
lines, every word inside a run of ``PASSAGE_WORDS`` words that stands earlier. Of
the hashes of all ``GRAM``-word runs the least in each such window is kept; where
one is met in two documents, the windows around it are digested and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trueform.llm.common import byte_slices, lean, saved
from trueform.llm.decontaminate import Words, fingerprints
from trueform.llm.textbytes import U, mix, shingles

MIN_WORDS = 13  # words of a unit, as many as a benchmark window has
PASSAGE_WORDS, GRAM = 25, 10  # half of a passage of 50 words: one changed word leaves a window of it whole


def units(text: str | None, min_words: int) -> list[tuple[int, int, tuple[int, int]]]:
    """(first line, line behind the last, digest) of each unit: 128 bits of its lower-cased words, one space between."""
    full = [(i, words) for i, words in enumerate(line.lower().split() for line in (text or "").split("\n")) if words]
    out = []
    end, held = 0, 0  # lines full[at:end] hold this many words
    for at, (first, words) in enumerate(full):
        while end < len(full) and held < min_words:
            held += len(full[end][1])
            end += 1
        if held < min_words:
            break
        joined = " ".join([w for _, part in full[at:end] for w in part])
        d = hashlib.blake2b(joined.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        out.append((first, full[end - 1][0] + 1, (int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True))))
        held -= len(words)
    return out


def gone_lines(text: str, drop: set[tuple[int, int]], min_words: int) -> set[int]:
    """Numbers of the lines of dropped units and of later repeats of the text's own."""
    seen: set[tuple[int, int]] = set()
    gone: set[int] = set()
    for first, end, digest in units(text, min_words):
        if digest in drop or digest in seen:
            gone.update(range(first, end))
        seen.add(digest)
    return gone


def cut_lines(text: str, drop: set[tuple[int, int]], min_words: int) -> tuple[str, list[tuple[int, int]]]:
    """Text without the lines of dropped units and of later repeats of its own, and the (start, end) characters kept."""
    kept, spans, at = [], [], 0
    gone = gone_lines(text, drop, min_words)
    for i, line in enumerate(text.split("\n")):
        if i not in gone:
            kept.append(line)
            spans.append((at, at + len(line)))
        at += len(line) + 1
    return "\n".join(kept), spans


def repeated_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, d1, d2): units of a document that also stand in one of lesser id, once for each row of it.

    Nothing below the join needs a unit's rows together, so AQE may split a common one."""
    id_type = documents.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch, rows = whole.slice(at, 500), []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    rows += [(i, *d) for d in {d for _, _, d in units(text, min_words)}]
                table = np.array(rows, dtype=np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(table[:, 0])), pa.array(table[:, 1]), pa.array(table[:, 2])], names=schema.names)

    lines = documents.filter("doc_id is not null").select("doc_id", "text").mapInArrow(digest, schema)
    first = saved(lines.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                  .filter("first < last").select("d1", "d2", "first"), "repeated")
    return lines.join(first, ["d1", "d2"]).filter("doc_id > first").select("doc_id", "d1", "d2")


def substring_dedup(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` (all its columns) with ``text`` cut, and ``kept_spans``, ``n_lines``, ``n_removed``.

    ``kept_spans`` holds (start, end) character offsets in the original text of
    each line kept. Units are equal when their words are, whatever their case and
    spacing; a line goes if any unit that holds it stands earlier, as does a blank
    line inside such a unit. A line that is in no unit (the document ends before
    ``min_words`` words) always stays. Null text stays null without lines; empty text is one empty line. Rows of one doc_id
    are one document for each other: only repeats of earlier documents and
    within a row go. Rows of null doc_id lose only their own repeats. A column
    named like an added one gives way to it.
    """
    drop = (repeated_lines(documents, min_words).groupBy("doc_id")
            .agg(F.collect_list(F.struct("d1", "d2")).alias("__drop")))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    added = [T.StructField("kept_spans", T.ArrayType(span)), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]
    own = [f for f in documents.schema.fields if f.name not in {"kept_spans", "n_lines", "n_removed", "__drop"}]
    schema = T.StructType(own + added)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts, spans, lines, gone = [], [], [], []
                for text, drop in zip(batch.column("text").to_pylist(), batch.column("__drop").to_pylist()):
                    kept, where = (None, []) if text is None else cut_lines(text, {(d["d1"], d["d2"]) for d in drop or ()}, min_words)
                    n = 0 if text is None else text.count("\n") + 1
                    texts.append(kept)
                    spans.append([{"start": a, "end": b} for a, b in where])
                    lines.append(n)
                    gone.append(n - len(where))
                columns = [pa.array(texts, batch.column("text").type) if f.name == "text" else batch.column(f.name) for f in own]
                yield pa.RecordBatch.from_arrays(columns + [
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], names=schema.names)

    joined = documents.select(*[f.name for f in own]).join(drop, "doc_id", "left")
    return joined.select(*[f.name for f in own], "__drop").mapInArrow(cut, schema)


def window_digests(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether the window of ``n`` words at each word lies within a row, and its two hashes."""
    one, two = shingles(words.hashes, n), shingles(mix(words.hashes + U(1)), n)
    return words.row[:len(one)] == words.row[len(words.row) - len(one):], one.view(np.int64), two.view(np.int64)


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of ``n`` words that begins at one of ``starts``."""
    step = np.zeros(size + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def once_a_row(row: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    """Places of the first of each kind of hashes in its row, so that a text which repeats itself counts once."""
    order = np.lexsort((*hashes, row))
    x, y = order[1:], order[:-1]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (row[x] != row[y]) | np.any([h[x] != h[y] for h in hashes], axis=0)
    return order[new]


def repeated_passages(documents: DataFrame, n: int = PASSAGE_WORDS, gram: int = GRAM) -> DataFrame:
    """(doc_id, d1, d2): windows of ``n`` words of a document that also stand in one of lesser id, once for each row of it.

    As with units, nothing below a join needs a window's rows together."""
    id_field = T.StructField("doc_id", documents.schema["doc_id"].dataType)
    width = n - gram + 1
    print_schema = T.StructType([id_field, T.StructField("print", T.LongType())])
    window_schema = T.StructType([id_field, T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])

    @lean
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                words = Words(batch.column("text"))
                at, hashes = fingerprints(words, gram, width)
                first = once_a_row(words.row[at], hashes)
                at, hashes = at[first], hashes[first]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(words.row[at])), pa.array(hashes.view(np.int64))], names=print_schema.names)

    @lean
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                words, wanted = Words(batch.column("text")), batch.column("prints").flatten().to_numpy()
                at, hashes = fingerprints(words, gram, width)
                at = at[np.isin(hashes.view(np.int64), wanted)]
                inside, one, two = window_digests(words, n)
                # windows that hold the run at p begin at p + gram - n to p
                near = covered(at, width, len(words.row) + width)[width - 1:][:len(one)] if len(one) else inside
                first = np.flatnonzero(near & inside)
                first = first[once_a_row(words.row[first], one[first], two[first])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(words.row[first])), pa.array(one[first]), pa.array(two[first])], names=window_schema.names)

    def several(rows: DataFrame, *key: str) -> DataFrame:
        return (rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                .filter("first < last").select(*key, "first"))

    texts = documents.filter("doc_id is not null").select("doc_id", "text")
    prints = texts.mapInArrow(take, print_schema)
    met = prints.join(several(prints, "print").select("print"), "print").groupBy("doc_id").agg(F.collect_set("print").alias("prints"))
    windows = saved(texts.join(met, "doc_id").mapInArrow(digest, window_schema), "passage-windows")
    return windows.join(several(windows, "d1", "d2"), ["d1", "d2"]).filter("doc_id > first").select("doc_id", "d1", "d2")


def cut_passages(text: bytes, spans: list[tuple[int, int]], gone: set[int]) -> bytes:
    """``text`` without the lines ``gone`` and the byte ``spans`` (ascending, apart); a line left blank by a span goes with it."""
    kept, at, k = [], 0, 0
    for i, line in enumerate(text.split(b"\n")):
        end, parts, place = at + len(line), [], at
        while k < len(spans) and spans[k][0] < end:
            low, high = max(spans[k][0], at), min(spans[k][1], end)
            parts.append(text[place:low])
            place = high
            if spans[k][1] > end:
                break
            k += 1
        left = b"".join(parts) + text[place:end] if parts else line
        if i not in gone and not (parts and not left.strip()):
            kept.append(left)
        at = end + 1
    return b"\n".join(kept)


def passage_spans(words: Words, hit: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Byte ranges in the batch of the runs of ``hit`` words from ``low`` up to ``high``, with the punctuation and blanks behind each."""
    raw, out, k = words.raw, [], low
    while k < high:
        if not hit[k]:
            k += 1
            continue
        start = int(words.starts[k])
        while k < high and hit[k]:
            k += 1
        end = int(words.ends[k - 1])
        stop = int(words.starts[k]) if k < high else len(raw)
        while end < stop and raw[end] > 32:
            end += 1
        while end < stop and raw[end] in (9, 32):
            end += 1
        out.append((start, end))
    return out


def passage_dedup(documents: DataFrame, min_words: int = MIN_WORDS, n: int = PASSAGE_WORDS) -> DataFrame:
    """``documents`` with ``text`` cut: the lines that ``substring_dedup`` cuts, and every word in a run of ``n`` words that stands earlier.

    Both are judged on the input, not on what is left. Words of a passage are runs of letters
    and digits, A-Z lower-cased, so its punctuation, spacing and line breaks may differ. Null
    text and null or repeated doc_id count as in :func:`substring_dedup`.
    """
    listed = lambda rows, name: rows.groupBy("doc_id").agg(F.collect_set(F.struct("d1", "d2")).alias(name))
    own = [f for f in documents.schema.fields if f.name not in {"__drop", "__passages"}]
    names = [f.name for f in own]
    # one shuffle key for both lists, so that the texts are dealt out once
    drop = listed(repeated_lines(documents, min_words), "__drop").join(listed(repeated_passages(documents, n), "__passages"), "doc_id", "full")

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                words = Words(batch.column("text"))
                inside, one, two = window_digests(words, n)
                later = np.zeros(len(one), dtype=bool)
                order = np.lexsort((two, one, words.row[:len(one)]))  # stable: of equal windows of a row the first comes first
                x, y = order[1:], order[:-1]
                later[x] = (words.row[x] == words.row[y]) & (one[x] == one[y]) & (two[x] == two[y])
                base = np.concatenate([[0], np.cumsum([len(t.encode()) if t else 0 for t in batch.column("text").to_pylist()])])
                passages = batch.column("__passages")
                for i in np.flatnonzero(np.asarray(passages.is_valid())):
                    low, high = int(words.first[i]), min(int(words.first[i + 1]), len(one))
                    given = passages[int(i)].values
                    later[low:high] |= np.isin(one[low:high], given.field("d1").to_numpy()) & np.isin(two[low:high], given.field("d2").to_numpy())
                hit = covered(np.flatnonzero(later & inside), n, len(words.row))
                any_hit = np.concatenate([[0], np.cumsum(hit)])
                texts = []
                for i, (text, lines) in enumerate(zip(batch.column("text").to_pylist(), batch.column("__drop").to_pylist())):
                    if text is None:
                        texts.append(None)
                        continue
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    gone = gone_lines(text, {(d["d1"], d["d2"]) for d in lines or ()}, min_words)
                    spans = [(a - int(base[i]), min(b, int(base[i + 1])) - int(base[i])) for a, b in passage_spans(words, hit, low, high)] if any_hit[high] > any_hit[low] else []
                    texts.append(cut_passages(text.encode(), spans, gone).decode() if spans or gone else text)
                yield pa.RecordBatch.from_arrays([pa.array(texts, batch.column("text").type) if c == "text" else batch.column(c) for c in names], names=names)

    return documents.select(*names).join(drop, "doc_id", "left").select(*names, "__drop", "__passages").mapInArrow(cut, T.StructType(own))
