"""Expectation workloads (C4, C5, C9, C10) on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trueform.operators import expectations as X
from trueform.workloads.cells_q import ORDERS_DIRT, PRIORITIES, dirty_orders
from trueform.workloads.mapping_q import CUSTOMER_SPEC
from trueform.workloads.registry import register, table

_FAIL_COLS = "CAST(NULL AS VARCHAR[]) AS expected_list"

VALMAP_SQL = """SELECT 'segment' AS field, substr(c_mktsegment, 1, 3) AS input,
       CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS output,
       CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'maybe' END AS approved
FROM customer"""


def value_mapping_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.lit("segment").alias("field"), F.substring("c_mktsegment", 1, 3).alias("input"),
        F.when(F.col("c_custkey") % 4 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("output"),
        F.when(F.col("c_custkey") % 3 == 0, "Yes").when(F.col("c_custkey") % 3 == 1, "No")
        .otherwise("maybe").alias("approved"))


@register("c4_unique", f"""SELECT 'orders' AS dataset, 'expect_column_values_to_be_unique' AS expectation,
  'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS failed_value, {_FAIL_COLS}
FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def c4_unique(spark, sf_dir):
    """C4: distinct duplicated values (aggregation on the one column)."""
    return X.values_unique(table(spark, sf_dir, "orders"), "o_custkey", "orders")


_PRI = ", ".join(f"'{p}'" for p in PRIORITIES)


@register("c5_in_set", f"""WITH d AS (SELECT {ORDERS_DIRT} FROM orders)
SELECT 'orders' AS dataset, 'expect_column_values_to_be_in_set' AS expectation, 'priority_raw' AS column_name,
  priority_raw AS failed_value, {_FAIL_COLS}
FROM d WHERE priority_raw IS NOT NULL AND priority_raw NOT IN ({_PRI})""")
def c5_in_set(spark, sf_dir):
    """Offending values with repeats (nulls ignored)."""
    return X.values_in_set(dirty_orders(spark, sf_dir), "priority_raw", PRIORITIES, "orders")


@register("c9_valmap", f"""WITH m AS ({VALMAP_SQL})
SELECT field AS dataset, 'expect_column_values_to_be_unique' AS expectation, 'input' AS column_name,
  input AS failed_value, {_FAIL_COLS} FROM m WHERE input IS NOT NULL GROUP BY field, input HAVING count(*) > 1
UNION ALL
SELECT field, 'expect_column_values_to_be_in_set', 'output', output, {_FAIL_COLS} FROM m
WHERE output IS NOT NULL AND output NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY','')
UNION ALL
SELECT field, 'expect_column_values_to_be_in_set', 'approved', approved, {_FAIL_COLS} FROM m
WHERE approved IS NOT NULL AND approved NOT IN ('Yes','No','None')""")
def c9_valmap(spark, sf_dir):
    """Value-mapping check on the long mapping frame."""
    return X.check_value_mappings(value_mapping_rows(spark, sf_dir), CUSTOMER_SPEC)


@register("c10_approval", f"""WITH m AS ({VALMAP_SQL})
SELECT field AS dataset, 'expect_column_values_to_be_in_set' AS expectation, 'approved' AS column_name,
  approved AS failed_value, {_FAIL_COLS} FROM m WHERE approved IS NOT NULL AND approved <> 'Yes'""")
def c10_approval(spark, sf_dir):
    """Every mapping row must be approved."""
    return X.check_approvals(value_mapping_rows(spark, sf_dir))


@register("c7_multi", f"""SELECT 'orders' AS dataset, 'expect_column_values_to_be_in_set' AS expectation,
  'status' AS column_name, o_orderstatus AS failed_value, {_FAIL_COLS} FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL
SELECT 'lineitem', 'expect_column_values_to_be_in_set', 'status', l_returnflag, {_FAIL_COLS} FROM lineitem
WHERE l_returnflag NOT IN ('A', 'N')""")
def c7_multi(spark, sf_dir):
    """C6 + C7: one failure table for several datasets, tagged by dataset name."""
    datasets = {"orders": table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")),
                "lineitem": table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("status"))}
    allowed = {"orders": ("F", "O"), "lineitem": ("A", "N")}
    frames = [X.values_in_set(df, "status", allowed[name], name) for name, df in datasets.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
