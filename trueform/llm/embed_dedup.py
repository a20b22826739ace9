"""Near-duplicate embeddings by random-hyperplane sign hashing.

Signs against random hyperplanes put each vector in one bucket of every table.
Vectors that meet in a bucket are compared by exact cosine in double precision.
A bucket of any size is cut into blocks and every pair of blocks is compared as
one small task, so no bucket is capped and none meets whole in one place; block
pairs give counts and a spanning set of links, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trueform.llm.common import saved
from trueform.llm.components import connected_components

THRESHOLD, RECALL = 0.95, 0.99
BUCKET_TARGET, BLOCK = 256, 256  # vectors expected in a bucket; vectors in a block


def table_plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for n vectors: buckets of about BUCKET_TARGET, and tables
    until a pair right at the threshold meets with probability ``recall``."""
    bits = max(4, math.ceil(math.log2(max(2, n) / BUCKET_TARGET)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def hyperplanes(dimension: int, count: int) -> np.ndarray:
    return np.random.default_rng(5).standard_normal((dimension, count))


def usable_vectors(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Distinct usable vectors: cls (least vec_id), weight (how many rows), v (doubles)."""
    v = F.col(vector).cast("array<double>")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    # -0.0 + 0.0 is 0.0, so equal vectors are equal bytes
    rows = embeddings.filter(F.col(vec_id).isNotNull()).select(F.col(vec_id).alias("vec_id"), F.transform(F.when(fine, v), lambda x: x + 0.0).alias("v"))
    return rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("cls"), F.countDistinct("vec_id").alias("weight"))


def bucketed(vectors: DataFrame, bits: int, tables: int, block: int, dimension: int) -> DataFrame:
    """(t, code, cls, weight, codes, v): each vector once for each table."""
    schema = T.StructType([T.StructField("t", T.IntegerType()), T.StructField("code", T.LongType()), vectors.schema["cls"], vectors.schema["weight"],
                           T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("v", T.ArrayType(T.DoubleType()))])

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, powers = hyperplanes(dimension, bits * tables), (1 << np.arange(bits)).astype(np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                column = batch.column("v")
                x = np.asarray(column.flatten()).reshape(len(column), dimension)
                codes = ((x @ planes > 0).reshape(len(x), tables, bits) * powers).sum(2)
                many = pa.array([list(c) for c in codes.tolist()], pa.list_(pa.int64()))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(codes[:, t]), batch.column("cls"), batch.column("weight"), many, column], names=schema.names)

    return vectors.select("cls", "weight", "v").mapInArrow(hash_rows, schema)


def block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """Copies of each vector for every pair of blocks it is part of: (t, code, i, j, side, ...).

    A bucket of s vectors has ceil(s / block) blocks, dealt by hash; a pair (i, j)
    of blocks is one group of at most about two blocks of rows.
    """
    sizes = saved(rows.groupBy("t", "code").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    dealt = rows.join(sizes, ["t", "code"]).withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (dealt.select("*", other).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .withColumn("side", F.when(F.col("own") == F.col("i"), 0).otherwise(1)).drop("own", "other", "blocks", "size"))


def compare(groups: DataFrame, threshold: float, dimension: int) -> DataFrame:
    """(cls, n, link): per block pair and vector, the rows linked to it and one linked class.

    A pair that meets in several tables counts in the first of them.
    """
    cls_type = groups.schema["cls"].dataType
    schema = T.StructType([T.StructField("cls", cls_type), T.StructField("n", T.LongType()), T.StructField("link", cls_type)])

    def one(key: tuple, table: pa.Table) -> pa.Table:
        t, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        side = table.column("side").to_numpy()
        x = np.asarray(table.column("v").combine_chunks().flatten()).reshape(table.num_rows, dimension)
        codes = np.asarray(table.column("codes").combine_chunks().flatten()).reshape(table.num_rows, -1)
        ids, weight = table.column("cls").to_numpy(), table.column("weight").to_numpy()
        x = x / np.abs(x).max(1, keepdims=True)  # before the norm: no overflow
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        left = np.flatnonzero(side == 0)
        right = left if i == j else np.flatnonzero(side == 1)
        a, b = np.nonzero(x[left] @ x[right].T >= threshold - 1e-9)
        a, b = left[a], right[b]
        keep = a < b if i == j else np.ones(len(a), bool)
        a, b = a[keep], b[keep]
        fresh = ~(codes[a, :t] == codes[b, :t]).any(1) if t else np.ones(len(a), bool)
        a, b = a[fresh], b[fresh]
        exact = (x[a] * x[b]).sum(1) >= threshold
        a, b = a[exact], b[exact]
        n = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        parent = list(range(len(ids)))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        link = np.full(len(ids), -1)
        for p, q in zip(a.tolist(), b.tolist()):
            rp, rq = root(p), root(q)
            if rp != rq:  # a spanning forest of the block pair's links
                parent[rp] = rq
        for k in np.flatnonzero(n).tolist():
            link[k] = root(k)
        full = np.flatnonzero(n)
        return pa.table({"cls": pa.array(ids[full]), "n": pa.array(n[full].astype(np.int64)), "link": pa.array(ids[link[full]])})

    return groups.groupBy("t", "code", "i", "j").applyInArrow(one, schema)


def embedding_duplicates(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                         threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Links are pairs found with cosine >= ``threshold``; bits and tables follow
    from the number of distinct vectors so that a pair at the threshold is found
    with probability ``recall`` (closer pairs more surely). Equal vectors are
    folded into one class that keeps their number. Vectors that are null, empty,
    zero, or hold a null or non-finite component link with nothing; so does a
    null vec_id, whose component is null. Rows that share a vec_id are one node:
    n_links counts other vectors, copies under the same id once. Vectors of
    different dimensions never link. Other columns are ignored.
    """
    vectors = saved(usable_vectors(embeddings, vec_id, vector), "vectors")
    classes = vectors.withColumn("d", F.size("v"))
    found = None
    for dimension, n in classes.groupBy("d").count().collect():  # one row for each dimension
        bits, tables = table_plan(n, threshold, recall)
        own = classes.filter(F.col("d") == dimension)
        rows = bucketed(own, bits, tables, BLOCK, dimension)
        part = compare(block_pairs(rows, BLOCK), threshold, dimension)
        found = part if found is None else found.union(part)
    id_type = embeddings.schema[vec_id].dataType
    if found is None:
        found = embeddings.sparkSession.createDataFrame([], T.StructType([T.StructField("cls", id_type), T.StructField("n", T.LongType()), T.StructField("link", id_type)]))
    found = saved(found, "met")
    groups = connected_components(found.select(F.col("cls").alias("a"), F.col("link").alias("b")))
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    of_class = saved(vectors.join(counts, "cls", "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
                     .select("v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "cls").alias("component")), "classes")
    ids = F.col(vec_id).alias("vec_id")
    clean = embeddings.select(ids, F.transform(F.col(vector).cast("array<double>"), lambda x: x + 0.0).alias("v"))
    joined = clean.join(of_class, "v", "left")
    named = F.col("vec_id").isNotNull()
    component = F.when(named, F.coalesce("component", "vec_id"))
    return joined.select("vec_id", F.when(named, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
