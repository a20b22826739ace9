"""Sequence packing by best-fit decreasing over a segment tree of capacities.

Documents become token ids plus an end id. A document longer than the window is
first cut into full windows; what is left of each is placed, longest first, into
the open window with the least remaining capacity that still holds it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from trueform.llm.common import saved

CAPACITY, END_ID = 4096, 2
SHARD_PIECES = 2048  # pieces packed together: bounds the memory and time of a task
CACHE_ENTRIES = 600_000  # words remembered by a Python worker
MARK, MARK_ID = "<|startoftext|>", 49406  # the vocabulary's own mark, put between words that are encoded together


_letters_first = re.compile(r"([^\W\d_]+)([!-@\[-`{-~][!-~]*)")


class WordEncoder:
    """Token ids (little-endian bytes, see ``kind``) of texts, word by word.

    The vocabulary drops white space and never joins tokens across it, so a
    text's ids are those of its space-separated words in turn. Words are
    remembered up to a bound; new ones are encoded together. A word's letters in
    lower case are remembered once for all its capital and punctuated forms.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.entries = Tokenizer.from_file(path), entries
        self.kind = np.dtype("<u2" if self.model.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")  # holds every id
        self.last = np.zeros(self.model.get_vocab_size(with_added_tokens=True), dtype=bool)
        self.last[[i for t, i in self.model.get_vocab().items() if t.endswith("</w>")]] = True  # tokens that end a run
        self.known: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _cut(self, joined: list[str], words: int, last: np.ndarray | None) -> list[bytes] | None:
        """Ids of words that were joined: each ends with a ``last`` token, or before the mark; None if they don't add up."""
        found = self.model.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.array([i for e in found for i in e.ids], dtype=self.kind)
        size, data = self.kind.itemsize, ids.tobytes()
        if last is None:
            cuts = np.flatnonzero(ids == MARK_ID)
            starts, ends = np.append(0, cuts + 1), np.append(cuts, len(ids))
        else:
            ends = np.flatnonzero(last[ids]) + 1
            starts = np.append(0, ends[:-1])
        if len(ends) != words:
            return None
        return [data[a:b] for a, b in zip((starts * size).tolist(), (ends * size).tolist())]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Words of letters are one run of tokens each and are joined by spaces; others have the mark between them."""
        letters = [w for w in words if w.isalpha()]
        marked = [w for w in words if not w.isalpha() and "<|" not in w]
        out: dict[str, bytes] = {}
        for group, joined, last in ((letters, [" ".join(letters[i:i + 100]) for i in range(0, len(letters), 100)], self.last), (marked, [MARK.join(marked)], None)):
            ids = self._cut(joined, len(group), last) if group else []
            out.update(zip(group, [self._whole(w) for w in group] if ids is None else ids))
        return [out[w] if w in out else self._whole(w) for w in words]

    def _parts(self, word: str) -> tuple[str, str]:
        """A word as its first letters, lower-cased, and an ASCII rest: the vocabulary never joins the two."""
        if word.isascii() and word.isalpha():
            return word.lower(), ""
        cut = None if word.isalpha() or "<|" in word else _letters_first.fullmatch(word)
        base, rest = cut.groups() if cut else (word, "")
        # one-to-one lower case and no composition: safe up to Latin Extended-B, but for dotted capital I
        return (base.lower(), rest) if base.isalpha() and max(base) < "ɐ" and "İ" not in base else (word, "")

    def learn(self, words: set[str]) -> list[str]:
        """Adds the ids of new words; returns what goes beyond the bound and is to be forgotten after use."""
        known, room = self.known, max(self.entries - len(self.known), 0)
        parts = {w: self._parts(w) for w in words}
        fresh = list({p for both in parts.values() for p in both}.difference(known))
        for i in range(0, len(fresh), 1000):
            part = fresh[i:i + 1000]
            known.update(zip(part, self._encode(part)))
        known.update([(w, known[base] + known[rest]) for w, (base, rest) in parts.items()])
        return list(dict.fromkeys([*fresh, *parts]))[room:]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        new = set().union(*split).difference(self.known)
        beyond = self.learn(new) if new else []
        get = self.known.__getitem__
        try:
            for words in split:
                yield b"".join(map(get, words))
        finally:
            for w in beyond:
                del self.known[w]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """Kept by a Python worker from task to task."""
    return WordEncoder(path)


class TightestFit:
    """Open windows by remaining capacity: a segment tree over 0..capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)  # any[node]: a window below it is open
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _mark(self, leaf: int, value: int) -> None:
        node = leaf + self.size
        self.any[node] = value
        node >>= 1
        while node:
            now = self.any[2 * node] | self.any[2 * node + 1]
            if self.any[node] == now:
                break
            self.any[node] = now
            node >>= 1

    def put(self, window: int, left: int) -> None:
        if left:
            if not self.open[left]:
                self._mark(left, 1)
            self.open[left].append(window)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least remaining capacity >= need, and that capacity."""
        node = need + self.size
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        left = node - self.size
        window = self.open[left].pop()
        if not self.open[left]:
            self._mark(left, 0)
        return window, left


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each length, given longest first."""
    tree, windows = TightestFit(capacity), 0
    where, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, need in enumerate(lengths.tolist()):
        found = tree.take(need) if need < capacity else None
        if found is None:
            found, windows = (windows, capacity), windows + 1
        where[i], offsets[i] = found[0], capacity - found[1]
        tree.put(found[0], found[1] - need)
    return where, offsets


def token_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document: full windows, then the rest. One row a piece.

    Columns: doc_id, start, length, doc_tokens, row_key (of the document's row) and,
    if ids are asked for, narrow_ids (little-endian, two bytes an id where the
    vocabulary allows it, else four) and id_bytes, else ids_crc32. Null text is the end id alone, null or repeated doc_id is carried as it is: each
    row is a document. Other columns are ignored.
    """
    fields = [T.StructField("doc_id", documents.schema["doc_id"].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "row_key", "id_bytes" if with_ids else "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("narrow_ids", T.BinaryType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = word_encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        size = encoder.kind.itemsize
        end, step = np.array([end_id], dtype=encoder.kind).tobytes(), size * capacity
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows, starts, lengths, totals, keys, last, ids = [], [], [], [], [], [], []
                for i, data in enumerate(encoder.encode(batch.column("text").to_pylist())):
                    data += end
                    for s in range(0, len(data), step):
                        piece = data[s:s + step]
                        rows.append(i)
                        starts.append(s // size)
                        lengths.append(len(piece) // size)
                        totals.append(len(data) // size)
                        keys.append(number)
                        if with_ids:
                            last.append(size)
                            ids.append(piece)
                        else:
                            last.append(zlib.crc32(np.frombuffer(piece, encoder.kind).astype("<u4")))
                    number += 1
                out = [batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, totals, keys, last))]
                yield pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.binary())] if with_ids else []), names=[f.name for f in fields])

    return documents.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns; length, row_key, start are used).

    Pieces are dealt by a hash of their key into shards of about
    ``shard_pieces`` whatever the input's size; each shard is packed alone, which
    leaves at most about one window in a shard half empty. Every piece is kept;
    no pieces, no sequences. ``pieces`` should be a saved table: it is counted.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(key: tuple, shard: pa.Table) -> pa.Table:
        shard = shard.drop_columns("__shard").sort_by([("length", "descending"), ("row_key", "ascending"), ("start", "ascending")])
        where, offsets = best_fit(shard.column("length").to_numpy(), capacity)
        return (shard.append_column("sequence_id", pa.array(where + (key[0].as_py() << 32)))
                .append_column("offset", pa.array(offsets)))

    dealt = pieces.withColumn("__shard", F.pmod(F.xxhash64("row_key", "start"), F.lit(shards)))
    return dealt.groupBy("__shard").applyInArrow(place, schema)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Token arrays of packed pieces that carry ids: sequence_id, ids (padded), n_tokens.

    A sequence is padded to the capacity unless its tokens are a power of two.
    """
    joined = packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    padding = F.when(F.bit_count(n) == 1, F.lit(0)).otherwise(F.lit(capacity) - n)
    return joined.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id).cast("long"), padding)).alias("ids"),
                         n.alias("n_tokens"))


def pack_sequences(pieces: DataFrame, shards: int, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Sequences of pieces with narrow_ids: sequence_id, ids, n_tokens, pieces (what stands where).

    ids are the padded token ids as little-endian uint32 bytes (``np.frombuffer(ids, "<u4")``).

    Pieces are placed as by ``pack`` and padded as by ``sequences``, in the shard.
    """
    doc_id = pieces.schema["doc_id"].dataType
    part = T.StructType([T.StructField("doc_id", doc_id)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "offset")])
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("pieces", T.ArrayType(part))])

    def build(key: tuple, shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("length", "descending"), ("row_key", "ascending"), ("start", "ascending")]).combine_chunks()
        where, offsets = best_fit(shard.column("length").to_numpy(), capacity)
        order = np.lexsort((offsets, where))
        shard, where, offsets = shard.take(pa.array(order)).combine_chunks(), where[order], offsets[order]
        lengths = shard.column("length").to_numpy()
        firsts = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        tokens = np.add.reduceat(lengths, firsts)
        ends = np.concatenate([[0], np.cumsum(np.where(tokens & (tokens - 1) == 0, tokens, capacity))])
        ids = np.full(ends[-1], pad_id, "<u4")
        narrow = b"".join(shard.column("narrow_ids").to_pylist())
        narrow = np.frombuffer(narrow, "<u2" if shard.column("id_bytes")[0].as_py() == 2 else "<u4")
        ids[np.arange(len(narrow)) + np.repeat(ends[where] + offsets - np.cumsum(lengths) + lengths, lengths)] = narrow
        parts = [shard.column(n).combine_chunks() for n in ("doc_id", "start", "length", "doc_tokens")] + [pa.array(offsets)]
        parts = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in parts]
        return pa.table({
            "sequence_id": pa.array(np.arange(len(firsts)) + (key[0].as_py() << 32)),
            "ids": pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids)]),
            "n_tokens": pa.array(tokens), "pieces": pa.ListArray.from_arrays(
                pa.array(np.append(firsts, len(where)).astype(np.int32)), pa.StructArray.from_arrays(parts, names=part.names))})

    dealt = pieces.select("doc_id", "start", "length", "doc_tokens", "row_key", "id_bytes", "narrow_ids",
                          F.pmod(F.xxhash64("row_key", "start"), F.lit(shards)).alias("__shard"))
    return dealt.groupBy("__shard").applyInArrow(build, schema)


def placed_pieces(sequences: DataFrame, with_sequence: bool = False) -> DataFrame:
    """One row a piece, read off its sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With ``with_sequence`` the piece at offset 0 also carries the ids of its whole
    padded sequence, the others null: ``offset = 0`` selects every sequence once.
    """
    rows = sequences.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.substring("ids", (4 * F.col("p.offset") + 1).cast("int"), (4 * F.col("p.length")).cast("int"))
    return rows.select("p.doc_id", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset",
                       *([F.when(F.col("p.offset") == 0, F.col("ids")).alias("sequence")] if with_sequence else []))


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, pad_id: int = 0,
                   shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The saved table of packed and padded sequences of all documents, see ``pack_sequences``.

    Shards are sized by an estimate of the pieces from the texts' bytes (three a token), so
    that token ids are shuffled once and never stored before they are packed.
    """
    guess = documents.select(F.sum(F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / (3 * capacity)) + 1)).first()[0] or 0
    shards = max(1, -(-int(guess) // shard_pieces))
    return saved(pack_sequences(token_pieces(documents, tokenizer_path, capacity, end_id, with_ids=True), shards, capacity, pad_id), "sequences")
