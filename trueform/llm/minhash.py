"""Near-duplicate documents by a signature-coordinate inverted join of MinHashes.

Every document is posted under each (coordinate, value) pair of its signature.
Documents that agree in at least ``matches`` coordinates share a posting list
among the rarest of each (prefix filter), and a document with fewer than
``matches`` lists of two or more documents meets nobody and is skipped. Pairs
from the lists are confirmed on the full shingle sets.

Equal sets are folded into one representative first. No list is expanded
into all its pairs. First every document meets only the heads of its lists (a
list's head is its document with the most company); links found there join
documents into groups. Documents that share a list share its head, so the
documents of each head that are still in different groups are then compared in
blocks. Pairs inside a group need no test: their documents are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from trueform.llm.common import byte_slices, flat_text, lean, list_array, saved, small_batches
from trueform.llm.components import connected_components
from trueform.llm.textbytes import Hashed, U, lower_ascii, mix, runs, shingles

SHINGLE, THRESHOLD = 5, 80
BLOCK = 256  # documents in a block
COORDINATES, MATCHES = 96, 58  # a pair at similarity 0.8 agrees in fewer than 58 of 96 about twice in a million

_word = np.ones(256, dtype=bool)
_word[[0x20, 9, 10, 11, 12, 13]] = False


def _shingle_rows(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, end to end, and row offsets."""
    raw, offsets = flat_text(texts)
    raw = lower_ascii(raw)
    starts, ends, first = runs(_word[raw], offsets)
    words = Hashed(raw).span(starts, ends)
    full = shingles(words, k)
    parts = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            parts.append(np.unique(full[a:b - k + 1]))
        else:  # fewer words than a shingle: the whole sequence is one
            parts.append(shingles(words[a:b], b - a) + U(b - a) if b > a else words[:0])
    flat = np.concatenate(parts) if parts else words[:0]
    return flat, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def signatures(documents: DataFrame, shingle: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, set digest (d1, d2) and signature of each row; null text is empty."""
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()), T.StructField("sig", T.ArrayType(T.IntegerType()))])
    factors = np.random.default_rng(7).integers(1, 1 << 63, coordinates, dtype=np.uint64) * U(2) + U(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                flat, offsets = _shingle_rows(batch.column("text"), shingle)
                counts = np.diff(offsets)
                full = np.flatnonzero(counts)
                at = offsets[:-1][full]
                sig = np.zeros((batch.num_rows, coordinates), dtype=np.int32)
                digest = np.zeros((2, batch.num_rows), dtype=np.uint64)
                if len(full):
                    for c in range(coordinates):
                        sig[full, c] = (mix(np.minimum.reduceat(flat * factors[c], at)) >> U(32)).astype(np.uint32).view(np.int32)
                    digest[0, full] = np.add.reduceat(mix(flat + U(1)), at)
                    digest[1, full] = np.bitwise_xor.reduceat(mix(flat ^ U(0x5851F42D4C957F2D)), at)
                sizes = np.where(counts > 0, coordinates, 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), *(pa.array(d.view(np.int64)) for d in digest),
                     list_array(sig[full].ravel(), np.concatenate([[0], np.cumsum(sizes)]), pa.int32())], names=schema.names)

    return documents.select("doc_id", "text").mapInArrow(lean(sign), schema)


def shingle_sets(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and its sorted distinct shingle hashes."""
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                flat, offsets = _shingle_rows(batch.column("text"), shingle)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_array(flat.view(np.int64), offsets, pa.int64())], names=schema.names)

    return documents.select("doc_id", "text").mapInArrow(lean(gather), schema)


def postings(representatives: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(list, rep, n, weight): the prefix of each representative, its rarest shared lists;
    weight adds up the sizes of all its shared lists."""
    post = representatives.select("rep", F.col("n_shingles").alias("n"), F.posexplode("sig").alias("c", "v")).select(
        "rep", "n", (F.shiftleft(F.col("c").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(0xFFFFFFFF))).alias("list"))
    shared = saved(post.groupBy("list").agg(F.count("*").alias("size")).filter("size > 1"), "lists")
    by_rep = Window.partitionBy("rep", "n")
    ranked = (post.join(shared, "list").withColumn("m", F.count("*").over(by_rep)).withColumn("weight", F.sum("size").over(by_rep)).filter(F.col("m") >= matches)
              .withColumn("rank", F.row_number().over(by_rep.orderBy("size", "list"))))
    return ranked.filter(F.col("rank") <= F.col("m") - matches + 1).select("list", "rep", "n", "weight")


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those (a, b) whose sets have 100 * intersection >= threshold * union."""
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.select("a", "b").join(right, "b").join(left, "a")
            .filter(both * 100 >= (F.size("x") + F.size("y") - both) * threshold).select("a", "b"))


def across_groups(members: DataFrame, groups: DataFrame, sets: DataFrame, threshold: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between documents of one head that are in different groups so far.

    The members of a head that are not in the head's own group meet each other
    and those in it, block against block; a block pair is one small task that
    puts out a spanning set of its links. Pairs within the head's group are
    connected already and never compared.
    """
    group = groups.select(F.col("node").alias("rep"), F.col("component").alias("g"))
    known = members.select("head", "rep").join(group, "rep", "left").withColumn("g", F.coalesce("g", "rep"))
    own = groups.select(F.col("node").alias("head"), F.col("component").alias("hg"))
    known = saved(known.join(own, "head", "left").withColumn("inside", F.col("g") == F.coalesce("hg", "head")).select("head", "rep", "g", "inside"), "known")
    inside = F.col("inside").cast("int")
    sizes = saved(known.groupBy("head").agg(F.sum(inside).alias("ins"), F.sum(1 - inside).alias("outs"))
                  .filter("outs > 1 or outs = 1 and ins > 1"), "sizes")
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    dealt = known.join(sizes, "head").withColumn("own", F.pmod(F.xxhash64("rep"), F.when(F.col("inside"), blocks("ins")).otherwise(blocks("outs"))).cast("int"))
    outer = F.transform(F.sequence(F.lit(0), blocks("outs") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), F.lit(False).alias("mixed"), (F.col("own") > o).alias("right")))
    with_inside = F.transform(F.sequence(F.lit(0), blocks("ins") - 1), lambda o: F.struct(o.alias("i"), F.col("own").alias("j"), F.lit(True).alias("mixed"), F.lit(True).alias("right")))
    for_inside = F.transform(F.sequence(F.lit(0), blocks("outs") - 1), lambda o: F.struct(F.col("own").alias("i"), o.alias("j"), F.lit(True).alias("mixed"), F.lit(False).alias("right")))
    nothing = F.filter(outer, lambda x: F.lit(False))
    places = F.when(F.col("inside"), for_inside).otherwise(F.concat(outer, F.when(F.col("ins") > 0, with_inside).otherwise(nothing)))
    placed = dealt.select("head", "rep", "g", F.explode(places).alias("p")).select("head", "p.*", "rep", "g")
    rows = placed.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    id_type = members.schema["rep"].dataType
    schema = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)])

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        ids, g = table.column("rep").to_numpy(), table.column("g").to_numpy()
        right = table.column("right").to_numpy()
        flat, sizes = np.asarray(pc.list_flatten(table.column("shingles")).combine_chunks()), np.asarray(pc.list_value_length(table.column("shingles")))
        code, row = np.unique(flat, return_inverse=True)[1], np.repeat(np.arange(len(ids)), sizes)
        shared = np.bincount(code) > 1
        rank = np.cumsum(shared) - 1
        row, code = row[shared[code]], rank[code[shared[code]]]
        left = np.flatnonzero(~right) if right.any() else np.arange(len(ids))
        other = np.flatnonzero(right) if right.any() else left
        both = np.zeros((len(left), len(other)), dtype=np.float32)
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        for at in range(0, int(shared.sum()), 8192):
            a, b = np.searchsorted(code, [at, at + 8192])
            held = np.zeros((len(ids), 8192), dtype=np.float32)
            held[row[a:b], code[a:b] - at] = 1
            both += held[left] @ held[other].T
        total = sizes[left][:, None] + sizes[other][None, :] - both
        x, y = np.nonzero((both * 100 >= total * threshold) & (g[left][:, None] != g[other][None, :]))
        met: dict[int, int] = {}

        def root(k: int) -> int:
            while met.get(k, k) != k:
                met[k] = met.get(met[k], met[k])
                k = met[k]
            return k

        out = []
        for p, q in zip(left[x].tolist(), other[y].tolist()):
            rp, rq = root(int(g[p])), root(int(g[q]))
            if rp != rq:
                met[rp] = rq
                out.append((p, q))
        return pa.table({"a": pa.array(ids[[p for p, _ in out]]), "b": pa.array(ids[[q for _, q in out]])}).cast(pa.schema([("a", table.schema.field("rep").type), ("b", table.schema.field("rep").type)]))

    return rows.groupBy("head", "mixed", "i", "j").applyInArrow(compare, schema)


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD,
                    coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= ``threshold`` * union of
    their shingle sets. A text of fewer words than a shingle is one shingle;
    null, empty or blank text and null doc_id link with nothing (component_id is
    then doc_id). Rows that share a doc_id are one node with the links of each.
    Repeated rows are rows of the result; other columns are ignored.
    """
    small_batches(documents.sparkSession)
    base = saved(signatures(documents, shingle, coordinates), "signatures")
    named = base.filter("doc_id is not null and n_shingles > 0")
    digest = ["d1", "d2", "n_shingles"]
    classes = saved(named.groupBy(*digest).agg(F.min("doc_id").alias("rep")), "classes")
    signed = named.join(classes.withColumnRenamed("rep", "doc_id"), [*digest, "doc_id"], "left_semi")
    prefix = saved(postings(signed.withColumnRenamed("doc_id", "rep").dropDuplicates(["rep", *digest]), coordinates, matches), "postings")

    fits = F.least("n", "hn") * 100 >= F.greatest("n", "hn") * threshold  # sizes alone allow a link
    sets = saved(shingle_sets(documents.join(prefix.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), shingle), "sets")
    heads = saved(prefix.groupBy("list").agg(F.max(F.struct("weight", "rep", "n")).alias("head"), F.count("*").alias("size"))
                  .filter("size > 1").select("list", F.col("head.rep").alias("head"), F.col("head.n").alias("hn")), "heads")
    members = saved(prefix.join(heads, "list").select("head", "hn", "rep", "n").distinct(), "members")
    first = saved(confirm(members.filter((F.col("rep") != F.col("head")) & fits).select(F.col("rep").alias("a"), F.col("head").alias("b")), sets, threshold), "links")
    groups = saved(connected_components(first), "groups")
    second = saved(across_groups(members, groups, sets, threshold), "links")
    final = saved(connected_components(first.union(second)), "components")

    of_class = (classes.join(final.withColumnRenamed("node", "rep"), "rep", "left")
                .select(*digest, F.coalesce("component", "rep").alias("component_id")))
    # a row whose doc_id also heads another class follows that class's component
    own = final.select(F.col("node").alias("doc_id"), F.col("component").alias("own_id"))
    out = base.select("doc_id", *digest).join(saved(of_class, "classes"), digest, "left").join(own, "doc_id", "left")
    component = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce(F.least("component_id", "own_id"), "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
