"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trueform.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "stars")
    return (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them (edges run from larger a to smaller b)."""
    least = saved(edges.groupBy("a").agg(F.min("b").alias("m")), "stars")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``links``; component is its least reachable node.

    Each round is two star operations: a partial aggregation and a join that AQE
    can split when one node holds many links, so no neighbourhood meets in one
    task. The links stay in saved tables; the driver sees one count and one sum
    a round. Null ends, loops and repeated links are ignored; no links, no rows.
    """
    edges = saved(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                  .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                  .distinct(), "edges")
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = saved(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
