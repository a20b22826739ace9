"""Exact substring dedup by a distributed merge sort of sparse suffixes.

A byte is removed when a string of ``length`` bytes around it also starts earlier.
Not all suffixes are sorted: each window of ``length`` bytes names the least of
its short grams (leftmost of equals) as its anchor, so equal windows have equal
anchors at equal places, and neighbouring windows with one anchor form a run.

1. Runs are compared whole by digest: of equal runs all but the earliest are
   removed. An anchor gram that stands in one kind of run only is settled.
2. The earliest run of each kind goes on as a suffix that starts at its anchor.
   Tasks sort their suffixes and exchange them front-coded: each as the length
   of the prefix it shares with the one before, and the rest.
3. The sorted runs of a part are combined by a loser tree that carries common
   prefix lengths and compares bytes only beyond them. The lengths it puts out
   show which windows of a suffix can recur at all; those are matched.

A gram with very many kinds of runs is dealt over several parts; what its parts
leave is matched once more by grouped aggregation, so nothing depends on how
rows were dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from trueform.llm.common import byte_slices, flat_text, saved
from trueform.llm.textbytes import Hashed, U, mix, sliding

LENGTH, GRAM = 100, 16
PART_SUFFIXES = 8192  # suffixes that one merge task takes, about
HOT_GRAM = 2048  # kinds of runs of one gram in one part, at most about
POSITION_BITS = 22
CHUNK = 1 << 21  # bytes of one document handled at once


def anchor_runs(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of one anchor: row, first window start, last one, anchor (positions in ``raw``), gram hash, digest."""
    hashed = Hashed(raw)
    grams = hashed.every(gram)
    width = length - gram + 1
    if len(grams) < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = U((1 << POSITION_BITS) - 1)
    least = sliding((grams & ~place) | np.arange(len(grams), dtype=np.uint64), width, np.minimum)
    anchor = (least & place).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, dtype=np.int32)  # windows that lie within a row
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= length)
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    stops = valid.copy()
    stops[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    at = anchor[first]
    digest = mix(hashed.span(first, last + length) + (at - first).astype(np.uint64))
    return np.searchsorted(offsets, first, "right") - 1, first, last, at, grams[at], digest


def chunks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, doc_ids, base of each row) of parts of a batch; long rows come in overlapping chunks."""
    for part in byte_slices(batch, "text", CHUNK):
        raw, offsets = flat_text(part.column("text"))
        ids = part.column("doc_id").to_numpy(zero_copy_only=False)
        if len(raw) <= 2 * CHUNK:
            yield raw, offsets, ids, np.zeros(len(ids), np.int64)
        else:  # one row: windows that start in a chunk are taken with it
            for at in range(0, len(raw), CHUNK):
                piece = raw[at:at + CHUNK + length - 1]
                yield piece, np.array([0, len(piece)]), ids, np.array([at])


def find_runs(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """(g, digest, doc_id, loc, done): every run; done if an earlier equal one stands in the same slice.

    loc packs the first window's start, the anchor's and the last window's distance from it.
    """
    schema = T.StructType([T.StructField("g", T.LongType()), T.StructField("digest", T.LongType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("loc", T.LongType()), T.StructField("done", T.BooleanType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, offsets, ids, base in chunks(batch, length):
                row, first, last, at, g, digest = anchor_runs(raw, offsets, length, gram)
                start = first - offsets[row] + base[row]
                doc, loc = ids[row].astype(np.int64), (start << 16) | ((at - first) << 8) | (last - first)
                order = np.lexsort((loc, doc, digest, g))
                again = np.zeros(len(order), dtype=bool)
                x, y = order[1:], order[:-1]
                again[x] = (g[x] == g[y]) & (digest[x] == digest[y])
                once = np.ones(len(order), dtype=bool)  # a repeated row of a document adds nothing
                once[x] = ~again[x] | (doc[x] != doc[y]) | (loc[x] != loc[y])
                yield pa.RecordBatch.from_arrays([pa.array(c[once]) for c in (g.view(np.int64), digest.view(np.int64), doc, loc, again)], names=schema.names)

    return documents.mapInArrow(find, schema)


def settle_runs(runs: DataFrame) -> DataFrame:
    """(doc_id, loc, g, kinds): removed runs have null g; the others are the earliest of their
    kind and their gram has ``kinds`` > 1 kinds of runs."""
    # a run that is settled already passes alone, under a key of its own
    keyed = runs.withColumn("g", F.when(F.col("done"), F.xxhash64("doc_id", "loc")).otherwise(F.col("g")))
    by_gram = Window.partitionBy("g", "done").orderBy("digest", "doc_id", "loc")
    new = ~F.col("done") & F.coalesce(F.lag("digest").over(by_gram) != F.col("digest"), F.lit(True))
    same = F.coalesce((F.lag("digest").over(by_gram) == F.col("digest")) & (F.lag("doc_id").over(by_gram) == F.col("doc_id"))
                      & (F.lag("loc").over(by_gram) == F.col("loc")), F.lit(False))  # a repeated row of a document
    kinds = F.sum(F.col("new").cast("int")).over(Window.partitionBy("g", "done"))
    return (keyed.withColumn("new", new).withColumn("same", same).withColumn("kinds", kinds).filter("not same and (not new or kinds > 1)")
            .select("doc_id", "loc", F.when(F.col("new"), F.col("g")).alias("g"), "kinds"))


def shared_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def front_code(suffixes: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Shared prefix lengths, rest lengths and rests of sorted strings of under 256 bytes."""
    shared = [0] + [shared_prefix(a, b) for a, b in zip(suffixes, suffixes[1:])]
    rests = [s[n:] for s, n in zip(suffixes, shared)]
    return bytes(shared), bytes(map(len, rests)), b"".join(rests)


def front_decode(shared: bytes, sizes: bytes, rests: bytes) -> Iterator[tuple[int, bytes]]:
    before, at = b"", 0
    for n, size in zip(shared, sizes):
        before = before[:n] + rests[at:at + size]
        at += size
        yield n, before


def merge_runs(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """(prefix shared with the string before, run, string) in sorted order.

    A loser tree. Each waiting string carries the prefix length it shares with
    the last string put out: the longer one is the lesser string without a look
    at its bytes, and of equals only the bytes beyond are compared.
    """
    k = 1 << max(0, len(runs) - 1).bit_length()
    text: list[bytes | None] = [None] * k
    shared = [-1] * k  # -1: the run has ended

    def advance(r: int) -> None:
        item = next(runs[r], None) if r < len(runs) else None
        shared[r], text[r] = item if item is not None else (-1, None)

    def duel(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's length is then that with the winner."""
        a, b = shared[x], shared[y]
        if a != b:
            return (x, y) if a > b else (y, x)
        if a < 0:
            return x, y
        s, t = text[x][a:], text[y][a:]
        n = a + shared_prefix(s, t)
        if s <= t:
            shared[y] = n
            return x, y
        shared[x] = n
        return y, x

    for r in range(k):
        advance(r)
        if shared[r] > 0:
            shared[r] = 0
    losers, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = duel(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    while shared[top] >= 0:
        yield shared[top], top, text[top]
        advance(top)
        node = (top + k) >> 1
        while node:
            top, losers[node] = duel(top, losers[node])
            node >>= 1


def suffix_runs(documents: DataFrame, wanted: DataFrame, parts: int, length: int) -> DataFrame:
    """Front-coded sorted runs of the wanted suffixes, one row for each slice and part."""
    schema = T.StructType([T.StructField("part", T.IntegerType())] + [T.StructField(n, T.BinaryType()) for n in ("shared", "sizes", "rests", "left_sizes", "lefts", "keys")])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", 4 * CHUNK):
                raw, offsets = flat_text(batch.column("text"))
                wants, of = batch.column("wants"), np.diff(batch.column("wants").offsets.to_numpy())
                fields = wants.flatten()
                loc, g = fields.field("loc").to_numpy(), fields.field("g").to_numpy()
                spread = fields.field("spread").to_numpy().astype(np.uint64)
                row = np.repeat(np.arange(batch.num_rows), of)
                doc = batch.column("doc_id").to_numpy()[row]
                # a gram's part by its hash; a hot gram has ``spread`` parts, dealt by document and place
                salt = mix(doc.astype(np.uint64) * U(31) + loc.astype(np.uint64)) % np.maximum(spread, U(1))
                part = (mix(g.view(np.uint64) + salt * U(0x9E3779B97F4A7C15)) % U(parts)).astype(np.int64)
                start = (loc >> 16) + offsets[:-1][row]
                at, end = start + ((loc >> 8) & 255), start + (loc & 255) + length
                data = raw.tobytes()
                suffix = [data[a:b] for a, b in zip(at.tolist(), end.tolist())]
                left = [data[a:b] for a, b in zip(start.tolist(), at.tolist())]
                keys = np.stack([doc.astype(np.int64), loc, g, spread.astype(np.int64)], axis=1)
                order = sorted(range(len(suffix)), key=lambda i: (part[i], suffix[i]))
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist() + [len(order)]
                out = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    own = order[a:b]
                    lefts = [left[i] for i in own]
                    out.append((int(part[own[0]]), *front_code([suffix[i] for i in own]), bytes(map(len, lefts)), b"".join(lefts), keys[own].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int32() if j == 0 else pa.binary()) for j in range(7)], names=schema.names)

    return documents.join(wanted, "doc_id").select("doc_id", "text", "wants").mapInArrow(code, schema)


def match_suffixes(coded: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, start, end, g, window) of each part's merged suffixes.

    Rows without g are removed spans; rows with g and window are single windows
    of hot grams that are the earliest of their part.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                           T.StructField("g", T.LongType()), T.StructField("window", T.LongType())])

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        merged = list(merge_runs([front_decode(r["shared"], r["sizes"], r["rests"]) for r in rows]))
        n = len(merged)
        keys = [np.frombuffer(r["keys"], np.int64).reshape(-1, 4) for r in rows]
        lefts = [(r["lefts"], np.cumsum(np.frombuffer(b"\0" + r["left_sizes"], np.uint8), dtype=np.int64)) for r in rows]
        seen, key, data = [0] * len(rows), np.zeros((n, 4), np.int64), []
        for i, (_, run, suffix) in enumerate(merged):
            j = seen[run]
            seen[run] = j + 1
            key[i] = keys[run][j]
            data.append(lefts[run][0][lefts[run][1][j]:lefts[run][1][j + 1]] + suffix)
        shared = np.array([m[0] for m in merged], dtype=np.int64)
        doc, loc, g, spread = key.T
        after = np.append(shared[1:], 0)
        shared[:1] = 0
        # the longest prefix that a suffix shares with any other is one with a neighbour
        reach = np.maximum(shared, after)
        before_anchor, more = (loc >> 8) & 255, loc & 255
        hot = spread > 1
        # windows that start j bytes after the run's first hold length - (before_anchor - j) bytes of the suffix
        fit = np.where(hot, more, np.minimum(more, before_anchor + reach - length))
        count = np.maximum(fit + 1, 0)
        item = np.repeat(np.arange(n), count)
        j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        sizes = np.array([len(x) for x in data], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        hashed = Hashed(np.frombuffer(b"".join(data), dtype=np.uint8))
        at = begin[item] + j
        window = hashed.span(at, at + length) if len(at) else np.zeros(0, np.uint64)
        start = (loc[item] >> 16) + j
        order = np.lexsort((start, doc[item], window, g[item]))
        x, y = order[1:], order[:-1]
        again = np.zeros(len(order), dtype=bool)
        again[x] = (g[item[x]] == g[item[y]]) & (window[x] == window[y]) & ((doc[item[x]] != doc[item[y]]) | (start[x] != start[y]))
        # removed windows of one item that touch become one span
        gone = np.flatnonzero(again)
        new = np.ones(len(gone), dtype=bool)
        new[1:] = (item[gone][1:] != item[gone][:-1]) | (start[gone][1:] != start[gone][:-1] + 1)
        begins, ends = gone[new], gone[np.append(new[1:], True)] if len(gone) else gone
        left = np.flatnonzero(~again & hot[item])
        null = np.zeros(len(begins), np.int64)
        mask = np.concatenate([np.ones(len(begins), bool), np.zeros(len(left), bool)])
        return pa.table({
            "doc_id": pa.array(np.concatenate([doc[item[begins]], doc[item[left]]])),
            "start": pa.array(np.concatenate([start[begins], start[left]])),
            "end": pa.array(np.concatenate([start[ends] + length, start[left] + length])),
            "g": pa.array(np.concatenate([null, g[item[left]]]), mask=mask),
            "window": pa.array(np.concatenate([null, window[left].view(np.int64)]), mask=mask)})

    return coded.groupBy("part").applyInArrow(merge, schema)


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, start, end): byte spans that together cover all that is to be removed."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
    settled = saved(settle_runs(find_runs(docs, length, gram)), "runs")
    gone = settled.filter("g is null").select("doc_id", F.shiftright("loc", 16).alias("start"),
                                              (F.shiftright("loc", 16) + F.col("loc").bitwiseAND(255) + length).alias("end"))
    waiting = settled.filter("g is not null")
    parts = max(1, -(-waiting.count() // PART_SUFFIXES))
    spread = F.ceil(F.col("kinds") / HOT_GRAM).cast("long").alias("spread")
    wanted = waiting.groupBy("doc_id").agg(F.collect_list(F.struct("loc", "g", spread)).alias("wants"))
    matched = saved(match_suffixes(suffix_runs(docs, wanted, parts, length), length, gram), "matched")
    rest = matched.filter("g is not null").select("g", "window", "doc_id", "start", "end")
    first = saved(rest.groupBy("g", "window").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "first")
    late = rest.join(first, ["g", "window"]).filter(F.struct("doc_id", "start") > F.col("first"))
    return gone.union(matched.filter("g is null").select("doc_id", "start", "end")).union(late.select("doc_id", "start", "end"))


def suffix_dedup(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, n_bytes, kept (binary), removed_spans (start, end bytes).

    Every byte covered by a string of ``length`` bytes that also starts earlier
    (lesser doc_id, or earlier in the same document) is removed; strings are
    judged on the input. Spans are maximal. Null text is empty; texts shorter
    than ``length`` stay whole; a null doc_id matches nothing. Rows that repeat a
    doc_id are one document: the spans of all of them are cut from each.
    doc_id is an integer. Other columns are ignored.
    """
    packed = F.shiftleft(F.col("start"), 20).bitwiseOR(F.col("end") - F.col("start"))
    spans = repeated_spans(documents, length, gram).groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(packed).alias("__spans"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([documents.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("removed_spans", T.ArrayType(span))])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                texts = batch.column("text").fill_null("").cast(pa.binary()).to_pylist()
                kept, removed = [], []
                for text, spans in zip(texts, batch.column("__spans").to_pylist()):
                    found: list[list[int]] = []
                    for s in sorted(spans or ()):
                        a, b = s >> 20, min(len(text), (s >> 20) + (s & 0xFFFFF))
                        if found and a <= found[-1][1]:
                            found[-1][1] = max(found[-1][1], b)
                        elif a < b:
                            found.append([a, b])
                    at, pieces = 0, []
                    for a, b in found:
                        pieces.append(text[at:a])
                        at = b
                    kept.append(b"".join(pieces) + text[at:])
                    removed.append([{"start": a, "end": b} for a, b in found])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, span_type)], names=schema.names)

    return documents.select("doc_id", "text").join(spans, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "__spans").mapInArrow(cut, schema)
