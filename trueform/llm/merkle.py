"""Merkle manifest of a table: a hash tree over its rows, group by group, with nested-interval labels.

Every node carries the interval [lo, hi) of leaf ranks that it covers. Ancestors
are attached by joins of intervals that contain one another, bucketed by level: a
node of level n lies in the one parent whose interval starts in its bucket of
``FAN ** (n + 1)`` ranks. Siblings of a node are what the parent's interval holds
besides the node's own. The groups' roots are in turn the leaves of the tree that
ends in the root of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trueform.llm.common import saved

FAN = 16  # nodes that share a parent
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value as hash input: ``-`` if null, else UTF-8 byte count, colon, value (integers decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``lo``, ``hi`` (rank in the group ``g`` and one more) and ``size`` (rows of the group) for saved rows.

    Rows are dealt by ranges of (g, order), nulls first. A rank is the rows of the
    group in earlier ranges, known from one count for each group of a range, plus
    the place in its own range, so a group of any size is spread over many tasks.
    ``order`` tells all rows apart.
    """
    dealt = saved(rows.repartitionByRange("g", *order).withColumn("part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(F.col("g").alias("_g"), F.col("part").alias("_part")).agg(F.count("*").alias("held"))
    group = Window.partitionBy("_g")
    counts = counts.select("_g", "_part", F.sum("held").over(group).alias("size"),
                           (F.sum("held").over(group.orderBy("_part")) - F.col("held")).alias("before"))
    place = F.row_number().over(Window.partitionBy("g", "part").orderBy(*order))
    joined = dealt.join(counts, F.col("g").eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_part")))
    lo = F.col("before") + place - 1
    return joined.withColumn("lo", lo).withColumn("hi", F.col("lo") + 1).drop("_g", "_part", "part", "before")


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Saved nodes of each level: ``g, lo, hi, size, digest`` and, above the leaves, ``children``.

    ``leaves`` are saved rows with g, lo, hi, size, digest. A group stops at the
    level that has one node; the number of levels is the logarithm of the largest
    group.
    """
    levels, width = [leaves], 1
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while width < largest:
        child = F.struct("lo", "hi", "digest")
        above = (levels[-1].filter(F.col("size") > width)  # several nodes on this level
                 .groupBy("g", F.floor(F.col("lo") / F.lit(width * FAN)).cast("long").alias("bucket"))
                 .agg(F.array_sort(F.collect_list(child)).alias("children"), F.max("size").alias("size")))
        width *= FAN
        levels.append(saved(above.select(
            "g", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), "size",
            F.sha2(F.array_join(F.col("children.digest"), ""), 256).alias("digest"), "children"), "nodes"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """The node of each group that covers all its leaves on the lowest level: ``g, digest``."""
    found = None
    for n, nodes in enumerate(levels):
        tops = nodes.filter(_is_root(n)).select("g", "digest")
        found = tops if found is None else found.unionByName(tops)
    return found


def _is_root(level: int) -> Column:
    above = F.col("size") <= F.lit(FAN ** level)
    return above & (F.col("size") > F.lit(FAN ** (level - 1))) if level else above


def with_paths(levels: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves with ``path``, and the ``carried`` columns of their group's row in ``tops``.

    ``path`` holds a step for each level from the leaf to the root: the digests of
    the siblings on the left, end to end, and those on the right. ``tops`` has for
    each g the path above its root. Groups are joined at their root only and handed
    down from parent to children, so no join has all rows of a group as one key.
    """
    above = None
    for n in range(len(levels) - 1, -1, -1):
        nodes = levels[n]
        own = [c for c in nodes.columns if c not in ("size", "path", *carried)]
        top = tops.select(F.col("g").alias("_g"), "path", *carried)
        here = nodes.filter(_is_root(n)).join(top, F.col("g").eqNullSafe(F.col("_g"))).select(*own, "path", *carried)
        if above is not None:
            bucket = FAN ** (n + 1)
            parents = above.select(F.col("g").alias("_g"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                                   F.col("children").alias("_all"), F.col("path").alias("_path"), *carried)
            inside = (F.col("g").eqNullSafe(F.col("_g"))
                      & (F.floor(F.col("lo") / F.lit(bucket)).cast("long") == F.floor(F.col("_lo") / F.lit(bucket)).cast("long"))
                      & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
            joined = nodes.filter(~_is_root(n)).filter(F.col("size") > F.lit(FAN ** n)).join(parents, inside)
            # the parent's interval without the node's own leaves what lies before it and what lies behind it
            left = F.filter("_all", lambda c: c["hi"] <= F.col("lo"))
            right = F.filter("_all", lambda c: c["lo"] >= F.col("hi"))
            step = F.struct(F.array_join(left["digest"], "").alias("left"), F.array_join(right["digest"], "").alias("right"))
            here = here.unionByName(joined.withColumn("path", F.concat(F.array(step), F.col("_path"))).select(*own, "path", *carried))
        above = here
    return above


def manifest(table: DataFrame, group: str, order: str, columns: list[str], payload: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``table``: its leaf, its path to the root, the root of its group and of the table.

    Result columns: ``order``'s column, the ``payload`` (named expressions over
    the table, such as another digest to be checked), ``leaf``, ``path`` (see
    ``with_paths``; through the group's root to the table's), ``subroot``, ``root``.

    Leaves of a group ascend by ``order``, nulls first, equal ones by digest;
    repeated rows are leaves of their own. Null groups form one group. Null values
    count as ``-``, empty texts as ``0:``. Columns that are not named are ignored,
    and the result holds no others. An empty table gives no row.
    """
    payload = payload or {}
    if clash := {order, *payload} & {"g", "lo", "hi", "size", "digest", "children", "path", "subroot", "root", "row", "part"}:
        raise ValueError(f"columns {sorted(clash)} clash with the tree's own")
    leaves = saved(table.select(F.col(group).alias("g"), F.col(order), leaf_digest([F.col(c) for c in columns]).alias("digest"),
                                *[v.alias(k) for k, v in payload.items()], F.monotonically_increasing_id().alias("row")), "leaves")
    levels = tree(saved(ranked(leaves, [order, "digest", "row"]).drop("row"), "ranks"))
    subroots = saved(roots(levels).withColumnRenamed("g", "group"), "subroots")
    top_levels = tree(saved(ranked(subroots.withColumn("g", F.lit(0)), ["group"]), "subroot-ranks"))
    root = roots(top_levels).select("g", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
    groups = saved(with_paths(top_levels, root, ["root"]).select(F.col("group").alias("g"), F.col("digest").alias("subroot"), "path", "root"), "groups")
    return with_paths(levels, groups, ["subroot", "root"]).select(order, *payload, F.col("digest").alias("leaf"), "path", "subroot", "root")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path end to end, from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")
