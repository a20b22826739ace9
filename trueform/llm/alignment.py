"""Alignment of two tokenizers through sparse token-byte incidence matrices.

Both tokenizers cut the same bytes. With A and B the token-byte incidence
matrices of a run of text (compressed sparse rows, built here by hand), the rows
of A.B' name the B tokens that share bytes with each A token (overlap links).
Byte offsets where both tokenizers end a token cut the tokens into groups; the
product of the two token-group matrices names the tokens that share a group.

A text is handled as its units: runs that begin before a single space or line
break between two printing characters, or before a dot or comma after a letter. No token of either vocabulary reaches over
such a place, so units are aligned once and remembered, and a text is its units
end to end.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from trueform.llm.common import byte_slices, list_array, saved

CACHE_ENTRIES = 250_000  # units remembered by a Python worker
CACHE_CHARS = 48  # the longest remembered unit
BATCH_UNITS = 20_000  # units aligned by one pair of matrices
JOINED_UNITS = 1000  # new units encoded in one call
PRODUCT_ROWS = 1 << 20  # entries of a matrix product formed at once
HOT_SHARE = 4096  # an id pair in at least one of so many block rows is joined by broadcast

# printing: not a space, control or format character that either tokenizer may treat as one
_print = "[^\\x00-\\x20\\x7f-\\xa0\\xad\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u2581\\u3000\\ufeff]"
_other = _print.replace("[^", "[")
_letter = "[^\\W\\d_²³¹]"
_units = re.compile(rf"(?s:.)(?:{_print.replace('[^', '[^.,')}++|(?<!{_letter})[.,]|(?<!{_print}){_other}|(?![ \n]){_other}|{_other}(?!{_print}))*+")
_joined = re.compile(rf"[ \n]{_print}(?s:.*)(?<={_print})")  # units that are units again when laid end to end
_cut = re.compile("[^▁]▁|\n|[^\\W\\d_²³¹][.,]")  # no piece holds a place where units are cut


@dataclass
class Csr:
    """Compressed sparse rows of a 0/1 matrix: the columns of row i are idx[ptr[i]:ptr[i + 1]]."""

    ptr: np.ndarray
    idx: np.ndarray
    n_cols: int

    @property
    def n_rows(self) -> int:
        return len(self.ptr) - 1

    def transpose(self) -> Csr:
        rows = np.repeat(np.arange(self.n_rows), np.diff(self.ptr))
        ptr = np.zeros(self.n_cols + 1, dtype=np.int64)
        np.cumsum(np.bincount(self.idx, minlength=self.n_cols), out=ptr[1:])
        return Csr(ptr, rows[np.argsort(self.idx, kind="stable")], self.n_rows)


def incidence(lengths: np.ndarray) -> Csr:
    """Token-byte matrix of tokens that lie end to end."""
    ptr = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=ptr[1:])
    return Csr(ptr, np.arange(ptr[-1]), int(ptr[-1]))


def membership(groups: np.ndarray, n_groups: int) -> Csr:
    """Token-group matrix: each token lies in one group."""
    return Csr(np.arange(len(groups) + 1), groups, n_groups)


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Symbolic pass: entries that each row of left.right gathers, equal columns not yet merged."""
    per = np.zeros(len(left.idx) + 1, dtype=np.int64)
    np.cumsum(np.diff(right.ptr)[left.idx], out=per[1:])
    return np.diff(per[left.ptr])


def product(left: Csr, right: Csr, limit: int = PRODUCT_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gustavson's row products: (row, column, value) of left.right, some rows at a time.

    Row i gathers the rows of ``right`` named by the columns of row i of ``left``;
    equal columns are added up.
    """
    sizes = np.cumsum(product_sizes(left, right))
    start = 0
    while start < left.n_rows:
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
        cols = left.idx[left.ptr[start]:left.ptr[stop]]
        rows = np.repeat(np.arange(start, stop), np.diff(left.ptr[start:stop + 1]))
        counts = right.ptr[cols + 1] - right.ptr[cols]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(right.ptr[cols] - ends + counts, counts)
        keys = np.repeat(rows, counts) * max(right.n_cols, 1) + right.idx[at]
        if len(keys) > 1 and (keys[1:] < keys[:-1]).any():
            keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if total else np.zeros(0, np.int64)
        value = np.diff(np.concatenate([first, [total]]))
        yield keys[first] // max(right.n_cols, 1), keys[first] % max(right.n_cols, 1), value
        start = stop


def overlap_links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, bytes shared) of all tokens whose byte ranges overlap: the entries of A.B'."""
    parts = list(product(incidence(a_lengths), incidence(b_lengths).transpose()))
    return tuple(np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts) if parts else ((),) * 3))


def group_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group number of each A token and B token, and the byte offsets where groups end."""
    ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends), ends


def shared_group_links(a_groups: np.ndarray, b_groups: np.ndarray, n_groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(A token, B token, 1) of all tokens in one group, some at a time: the product of the token-group matrices."""
    yield from product(membership(a_groups, n_groups), membership(b_groups, n_groups).transpose())


def _ragged(values: np.ndarray, ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows end to end, and how many each has."""
    counts = ptr[rows + 1] - ptr[rows]
    ends = np.cumsum(counts)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(ptr[rows] - ends + counts, counts)
    return values[at], counts


def _added(of: np.ndarray, pairs: np.ndarray, times: np.ndarray, n_pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (of, pair) rows as one, in order, their times added up; pairs are below ``n_pairs``."""
    keys = of * n_pairs + pairs
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    if not len(keys):
        return keys, keys, times
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first] // n_pairs, keys[first] % n_pairs, np.add.reduceat(times, first)


class _Units:
    """What is known of aligned units: counts, group text, and id pairs with how often each is linked."""

    def __init__(self):
        self.counts = np.zeros((0, 5), dtype=np.int64)  # A tokens, B tokens, groups, links, links by group
        self.valid = np.zeros(0, dtype=bool)
        self.groups: list[str] = []
        self.ptr = np.zeros(1, dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.times = np.zeros(0, dtype=np.int64)

    def plus(self, other: _Units) -> _Units:
        out = _Units()
        out.counts = np.concatenate([self.counts, other.counts])
        out.valid = np.concatenate([self.valid, other.valid])
        out.groups = self.groups + other.groups
        out.ptr = np.concatenate([self.ptr, other.ptr[1:] + self.ptr[-1]])
        out.pairs = np.concatenate([self.pairs, other.pairs])
        out.times = np.concatenate([self.times, other.times])
        return out

    def head(self, n: int) -> _Units:
        out = _Units()
        out.counts, out.valid, out.groups, out.ptr = self.counts[:n].copy(), self.valid[:n].copy(), self.groups[:n], self.ptr[:n + 1].copy()
        out.pairs, out.times = self.pairs[:out.ptr[-1]].copy(), self.times[:out.ptr[-1]].copy()
        return out


class Aligner:
    """Aligns texts; units are remembered up to a bound."""

    def __init__(self, a_path: str, b_path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # byte-level alphabet: printing bytes stand for themselves, the others for characters from 256 on
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        own = [b for b in range(256) if chr(b) in alphabet]
        rest = [b for b in range(256) if chr(b) not in alphabet]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        size = self.a.get_vocab_size(with_added_tokens=True)
        added = self.a.get_added_tokens_decoder()
        self.a_bytes = [added[i].content.encode() if i in added else bytes(byte_of[c] for c in self.a.id_to_token(i)) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        if any(_cut.search(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())):
            raise ValueError("a piece crosses the border of a unit")
        self.a_len = np.array([len(x) for x in self.a_bytes])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        self.n_pairs = len(self.a_bytes) * len(self.b_bytes)  # an id pair is held as a * (ids of B) + b
        self.numbers = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.entries = entries
        self.known: dict[str, int] = {}
        self.units = _Units()

    def _a_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _b_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts as they are: a line break in front takes the space that the model adds."""
        return [ids[2:] for ids in self.b.encode(["\n" + t for t in texts], num_threads=1)]

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids, B ids, their unit numbers, and which units both spell as they are (the rest get no tokens)."""
        at = {True: [], False: []}
        for i, u in enumerate(units):
            at[_joined.fullmatch(u) is not None].append(i)
        order = at[True] + at[False]
        runs = [at[True][i:i + JOINED_UNITS] for i in range(0, len(at[True]), JOINED_UNITS)] + [[i] for i in at[False]]
        texts = ["".join([units[i] for i in run]) for run in runs]
        a_ids, b_ids = self._a_ids(texts), self._b_ids(texts)
        valid = np.ones(len(units), dtype=bool)
        out_a, out_b, unit_a, unit_b = [], [], [], []
        for run, text, a, b in zip(runs, texts, a_ids, b_ids):
            whole = text.encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                if len(run) > 1:  # find the unit that is not spelled as it is
                    parts = [self._encode_one(units[i]) for i in run]
                else:
                    parts = [None]
                for i, part in zip(run, parts):
                    if part is None:
                        valid[i] = False
                    else:
                        out_a.append(part[0]), out_b.append(part[1])
                        unit_a.append(np.full(len(part[0]), i)), unit_b.append(np.full(len(part[1]), i))
                continue
            ends = np.cumsum([len(units[i].encode()) for i in run])
            for ids, lengths, out, of in ((a, self.a_len, out_a, unit_a), (b, self.b_len, out_b, unit_b)):
                ids = np.array(ids, dtype=np.int64)
                out.append(ids)
                of.append(np.array(run)[np.searchsorted(ends, np.cumsum(lengths[ids]))])
        empty = [np.zeros(0, np.int64)]
        a, b, ua, ub = (np.concatenate(x or empty) for x in (out_a, out_b, unit_a, unit_b))
        by_a, by_b = np.argsort(ua, kind="stable"), np.argsort(ub, kind="stable")
        return a[by_a], b[by_b], ua[by_a], ub[by_b], valid

    def _encode_one(self, unit: str) -> tuple[np.ndarray, np.ndarray] | None:
        a, b = self._a_ids([unit])[0], self._b_ids([unit])[0]
        whole = unit.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def align_units(self, units: list[str]) -> _Units:
        """Aligns units laid end to end: one pair of matrices for all of them."""
        a, b, unit_a, unit_b, valid = self._encode(units)
        n = len(units)
        a_len, b_len = self.a_len[a], self.b_len[b]
        a_groups, b_groups, ends = group_of(np.cumsum(a_len), np.cumsum(b_len))
        rows, cols, _ = overlap_links(a_len, b_len)
        out = _Units()
        out.valid = valid
        out.counts = np.zeros((n, 5), dtype=np.int64)
        out.counts[:, 0] = np.bincount(unit_a, minlength=n)
        out.counts[:, 1] = np.bincount(unit_b, minlength=n)
        unit_g = np.zeros(len(ends), dtype=np.int64)
        unit_g[a_groups] = unit_a
        out.counts[:, 2] = np.bincount(unit_g, minlength=n)
        out.counts[:, 3] = np.bincount(unit_a[rows], minlength=n)
        by_group = product_sizes(membership(a_groups, len(ends)), membership(b_groups, len(ends)).transpose())
        out.counts[:, 4] = np.bincount(unit_a, weights=by_group, minlength=n).astype(np.int64)
        of, out.pairs, out.times = _added(unit_a[rows], a[rows] * len(self.b_bytes) + b[cols], np.ones(len(rows), dtype=np.int64), self.n_pairs)
        out.ptr = np.searchsorted(of, np.arange(n + 1))
        # group text: A ids | B ids ; ...
        a_text, b_text = list(map(self.numbers.__getitem__, a.tolist())), list(map(self.numbers.__getitem__, b.tolist()))
        a_at = np.searchsorted(a_groups, np.arange(len(ends) + 1)).tolist()
        b_at = np.searchsorted(b_groups, np.arange(len(ends) + 1)).tolist()
        each = [",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m]) for i, j, k, m in zip(a_at, a_at[1:], b_at, b_at[1:])]
        g_at = np.searchsorted(unit_g, np.arange(n + 1)).tolist()
        out.groups = [";".join(each[i:j]) for i, j in zip(g_at, g_at[1:])]
        return out

    def _codes(self, flat: list[str]) -> tuple[np.ndarray, _Units]:
        """Numbers of units, and what they stand for. New short units stay known while there is room."""
        known, base = self.known, len(self.known)
        new = sorted(set(flat).difference(known), key=lambda u: len(u) > CACHE_CHARS)  # those that may stay come first
        stay = min(sum(len(u) <= CACHE_CHARS for u in new), max(self.entries - base, 0))
        units = self.units
        for i in range(0, len(new), BATCH_UNITS):
            units = units.plus(self.align_units(new[i:i + BATCH_UNITS]))
        known.update(zip(new, range(base, base + len(new))))
        codes = np.fromiter(map(known.__getitem__, flat), dtype=np.int64, count=len(flat))
        for u in new[stay:]:
            del known[u]
        if stay:
            self.units = units if stay == len(new) else units.head(base + stay)
        return codes, units

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: counts and group text; and offsets, id pairs, times linked of its distinct id pairs."""
        split = [_units.findall(" " + t) if t else [] for t in texts]
        codes, units = self._codes(list(chain.from_iterable(split)))
        n, sizes, n_units = len(texts), np.array([len(s) for s in split], dtype=np.int64), max(len(units.valid), 1)
        doc = np.repeat(np.arange(n), sizes)
        good = sizes > 0
        good[doc[~units.valid[codes]]] = False
        use = good[doc]
        doc, codes = doc[use], codes[use]
        counts = np.stack([np.bincount(doc, weights=units.counts[codes, j], minlength=n) for j in range(5)], axis=1).astype(np.int64)
        at, listed, groups = np.searchsorted(doc, np.arange(n + 1)).tolist(), codes.tolist(), []
        for i, j in zip(at, at[1:]):
            groups.append(";".join([units.groups[c] for c in listed[i:j]]))
        # distinct units of a text first, then their id pairs
        keys, often = np.unique(doc * n_units + codes, return_counts=True)
        doc, codes = keys // n_units, keys % n_units
        pairs, per = _ragged(units.pairs, units.ptr, codes)
        times = _ragged(units.times, units.ptr, codes)[0] * np.repeat(often, per)
        doc, pairs, times = _added(np.repeat(doc, per), pairs, times, self.n_pairs)
        pairs = (pairs // len(self.b_bytes) << 32) | pairs % len(self.b_bytes)
        return counts, groups, np.searchsorted(doc, np.arange(n + 1)), pairs, times


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """Kept by a Python worker from task to task."""
    return Aligner(a_path, b_path)


def align(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Aligned tokens of each row's whole text (tokenizer A: space and text; B adds the space itself).

    Rows of documents: ``doc_id, n_a, n_b, n_groups, n_links`` (token occurrences
    that share bytes), ``n_group_links`` (token occurrences that share a group),
    ``groups`` (``a1,a2|b1;...``: ids of A and B, group by group), ``pairs``
    (distinct linked ids, ascending, A's in the upper 32 bits) and ``times`` (how
    often each is linked there). Rows with ``in_block`` false carry no document:
    their ``pairs`` and ``times`` say how many of the ``block``'s documents hold
    each id pair linked.

    Null and empty text, and text that either tokenizer does not spell byte for
    byte, has no tokens (zeros, empty text and lists). Null or repeated doc_id and
    repeated rows are documents of their own; other columns are ignored; an empty
    table gives no row.
    """
    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_group_links")]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("in_block", T.BooleanType()),
                           T.StructField("doc_id", documents.schema["doc_id"].dataType), *longs, T.StructField("groups", T.StringType()),
                           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                n = batch.num_rows
                counts, groups, offsets, pairs, times = own.align(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array(np.ones(n, dtype=bool)), batch.column("doc_id"),
                     *(pa.array(counts[:, j]) for j in range(5)), pa.array(groups, pa.string()),
                     list_array(pairs, offsets, pa.int64()), list_array(times, offsets, pa.int64())], names=schema.names)
                pairs, n_docs = np.unique(pairs, return_counts=True)
                once = np.array([0, len(pairs)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([False]), pa.nulls(1, batch.column("doc_id").type),
                     *(pa.array([0]) for _ in range(5)), pa.array([""], pa.string()),
                     list_array(pairs, once, pa.int64()), list_array(n_docs, once, pa.int64())], names=schema.names)
                block += 1

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n_docs (documents that hold it linked), is_best (no pair of its A id is in more), n_blocks.

    Blocks have counted their own documents already, so a pair is one row a block.
    """
    per_block = aligned.filter("not in_block").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = per_block.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n_docs"), F.count("*").alias("n_blocks"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    best = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(best, "a").select("pair", "n_docs", "n_blocks", (F.col("n_docs") == F.col("most")).alias("is_best"))


def score_links(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The document rows of a saved ``align`` with ``n_best`` and ``count_sum`` from saved ``pair_counts``.

    Each block fetches the counts of its own pairs once, for all its documents.
    Pairs in at least 1 / HOT_SHARE of all block rows (so HOT_SHARE pairs at most)
    are fetched by broadcast, the rest by a join without a key above that share.
    """
    rows = aligned.filter("not in_block").select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair"))
    total = counts.agg(F.sum("n_blocks")).first()[0] or 0
    hot = counts.filter(F.col("n_blocks") * HOT_SHARE >= F.lit(total)).select("pair", "n_docs", "is_best")
    cold = counts.filter(F.col("n_blocks") * HOT_SHARE < F.lit(total)).select("pair", "n_docs", "is_best")
    looked = rows.join(F.broadcast(hot), "pair").unionByName(rows.join(cold, "pair"))
    kept = [c for c in aligned.columns if c not in ("in_block", "pairs", "times")]
    docs = aligned.filter("in_block")
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, counts, best = (right.column(c).to_numpy() for c in ("pair", "n_docs", "is_best"))
        order = np.argsort(pairs)
        pairs, counts, best = pairs[order], counts[order], best[order].astype(np.int64)
        held, times = left.column("pairs").combine_chunks(), left.column("times").combine_chunks()
        sizes = np.asarray(held.value_lengths())
        at = np.searchsorted(pairs, held.flatten().to_numpy())
        times = times.flatten().to_numpy()
        doc = np.repeat(np.arange(len(sizes)), sizes)
        sums = [np.zeros(len(sizes), dtype=np.int64) for _ in range(2)]
        for out, weight in zip(sums, (best, counts)):
            np.add.at(out, doc, times * weight[at])
        return pa.table([left.column(c) for c in kept] + [pa.array(x) for x in sums], names=schema.names)

    return docs.groupBy("block").cogroup(looked.groupBy("of_block")).applyInArrow(score, schema).drop("block")


def token_alignment(documents: DataFrame, a_path: str, b_path: str, digest: bool = True) -> DataFrame:
    """``align`` with ``n_best`` and ``count_sum``, over saved tables.

    ``digest``: ``groups_sha256`` (lowercase hex; empty without tokens) in place of
    ``groups``, so that the long group texts are never written.
    """
    aligned = align(documents, a_path, b_path)
    if digest:
        aligned = aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")
    aligned = saved(aligned, "aligned")
    return score_links(aligned, saved(pair_counts(aligned), "pair-counts"))
