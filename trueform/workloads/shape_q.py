"""Shape workloads (D1-D10) on part, customer, supplier and a wide orders layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from trueform.operators import shape as S
from trueform.plans.spec import FieldSpec, TableSpec
from trueform.workloads.cells_q import PART_DIRT, dirty_parts
from trueform.workloads.conform_q import _split_select
from trueform.workloads.registry import register, table

PART_COLMAP = {"p_partkey": "ProgramID", "p_name": "ProgramName", "p_brand": None, "p_type": ""}


@register("d1_rename", """SELECT p_partkey AS ProgramID, p_name AS ProgramName, p_size, p_retailprice FROM part""")
def d1_rename(spark, sf_dir):
    """D1 + D2: rename by mapping, drop columns mapped to nothing, others untouched."""
    return S.rename_and_drop(table(spark, sf_dir, "part"), PART_COLMAP)


@register("d2_drop", """SELECT p_partkey, p_name, p_size, p_retailprice FROM part""")
def d2_drop(spark, sf_dir):
    """D2 alone: columns whose target is null or blank are dropped."""
    p = table(spark, sf_dir, "part")
    return p.drop(*S.dropped_columns(PART_COLMAP, p.columns))


_CUST_PAD = """SELECT c_custkey,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('  ', c_name, ' ') END AS c_name,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  c_nationkey FROM customer"""


def _padded(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("c_name"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey")


@register("d4_fill", f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, coalesce(c_name, '') AS c_name,
  coalesce(c_mktsegment, '') AS c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM ({_CUST_PAD}) t""")
def d4_fill(spark, sf_dir):
    """Every column to text, null -> ''."""
    d = _padded(spark, sf_dir)
    return d.select(*[S.to_text(F.col(c)).alias(c) for c in d.columns])


@register("d5_strip", f"""SELECT c_custkey, trim(coalesce(c_name, '')) AS c_name FROM ({_CUST_PAD}) t""")
def d5_strip(spark, sf_dir):
    """Surrounding whitespace stripped."""
    d = _padded(spark, sf_dir)
    return d.select("c_custkey", S.strip_text(S.to_text(F.col("c_name"))).alias("c_name"))


@register("d6_split", f"""WITH d AS (SELECT {PART_DIRT} FROM part)
SELECT p_partkey, array_to_string(list_transform(string_split(types_raw, ';'), lambda x: trim(x)), '|') AS parts,
  CAST(len(string_split(types_raw, ';')) AS BIGINT) AS n_parts FROM d""")
def d6_split(spark, sf_dir):
    """Delimited text -> stripped parts (blank -> [''])."""
    d = dirty_parts(spark, sf_dir)
    arr = S.split_values(F.col("types_raw"), ";")
    return d.select("p_partkey", F.array_join(arr, "|").alias("parts"), F.size(arr).cast("bigint").alias("n_parts"))


@register("d7_constant", """SELECT c_custkey, c_name, 'M-0001' AS MemberOrganization, '1' AS ForceOverWrite FROM customer""")
def d7_constant(spark, sf_dir):
    """Member id and force-overwrite constants replace any source value."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("0").alias("ForceOverWrite"))
    return S.set_constants(c, "M-0001")


@register("d8_union", """SELECT acctbal, id, name, nation, segment FROM (
  SELECT c_acctbal AS acctbal, c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
  UNION ALL
  SELECT s_acctbal, s_suppkey, s_name, s_nationkey, NULL FROM supplier) t""")
def d8_union(spark, sf_dir):
    """Union by name, missing columns null, columns sorted."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("acctbal"))
    return S.union_by_name([c, s])


@register("d9_join", """SELECT p_partkey, array_to_string(string_split(p_name, ' '), ',') AS words FROM part""")
def d9_join(spark, sf_dir):
    """Array -> delimited text."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", S.join_values(F.split("p_name", " ")).alias("words"))


# -- D3: wide -> long ---------------------------------------------------------------------------------
WIDE_SPEC = TableSpec(
    fields=(
        FieldSpec("CaseNumber"),
        FieldSpec("Date", "date", milestones=(0, 1, 2)),
        FieldSpec("Amount", "number", milestones=(0, 1), custom_names=((1, "ExitTotal"),)),
        FieldSpec("Status", "string", milestones=(2,)),
    ),
    milestone_names=("Intake", "Exit", "NinetyDays"),
)

WIDE_DIRT = """
  CAST(o_orderkey AS STRING) AS CaseNumber,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS IntakeDate,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS ExitDate,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS IntakeAmount,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey AS STRING) END AS ExitTotal
"""


def wide_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*_split_select(WIDE_DIRT))


_WIDE_W = f"WITH w AS (SELECT {WIDE_DIRT} FROM orders)"


@register("d3_wide_to_long", f"""{_WIDE_W}
SELECT CaseNumber, 'Intake' AS MilestoneFlag, IntakeAmount AS Amount, IntakeDate AS "Date" FROM w
UNION ALL SELECT CaseNumber, 'Exit', ExitTotal, ExitDate FROM w""")
def d3_wide_to_long(spark, sf_dir):
    """D3 (keep): one row per case and milestone with data anywhere; empty milestones skipped."""
    return S.wide_to_long(wide_orders(spark, sf_dir), WIDE_SPEC, empty_rows="keep")


@register("d3_wide_to_long_drop", f"""{_WIDE_W}
SELECT CaseNumber, 'Intake' AS MilestoneFlag, IntakeAmount AS Amount, IntakeDate AS "Date" FROM w
WHERE IntakeAmount IS NOT NULL OR IntakeDate IS NOT NULL
UNION ALL SELECT CaseNumber, 'Exit', ExitTotal, ExitDate FROM w WHERE ExitTotal IS NOT NULL OR ExitDate IS NOT NULL""")
def d3_wide_to_long_drop(spark, sf_dir):
    """D3 (drop): rows empty for a milestone are removed as well."""
    return S.wide_to_long(wide_orders(spark, sf_dir), WIDE_SPEC, empty_rows="drop")


# -- D10: shape composite ---------------------------------------------------------------------------------
SHAPE_SPEC = TableSpec(
    fields=(
        FieldSpec("CaseNumber", required=True),
        FieldSpec("MilestoneFlag", required=True),
        FieldSpec("MemberOrganization", required=True),
        FieldSpec("ForceOverWrite", "integer"),
        FieldSpec("Tags", "string", allows_multiple=True),
        FieldSpec("ProgramName"),
    ),
)
SHAPE_COLMAP = {"c_custkey": "CaseNumber", "c_mktsegment": "MilestoneFlag", "tags": "Tags",
                "c_name": "ProgramName", "c_acctbal": None}


@register("d10_shape", """SELECT trim(CAST(c_custkey AS VARCHAR)) AS CaseNumber, '1' AS ForceOverWrite,
  'M-0001' AS MemberOrganization, trim(c_mktsegment) AS MilestoneFlag, trim(concat(' ', c_name)) AS ProgramName,
  array_to_string(list_transform(string_split(trim(concat(c_mktsegment, ' ; n', CAST(c_nationkey AS VARCHAR))), ';'),
                                 lambda x: trim(x)), '|') AS Tags
FROM customer""")
def d10_shape(spark, sf_dir):
    """D2 -> D1 -> D4 -> D5 -> D6 -> D7 in one projection chain."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.concat(F.lit(" "), "c_name").alias("c_name"), "c_acctbal",
        F.concat("c_mktsegment", F.lit(" ; n"), F.col("c_nationkey").cast("string")).alias("tags"))
    out = S.shape(c, SHAPE_SPEC, SHAPE_COLMAP, member_id="M-0001", delimiter=";")
    return out.withColumn("Tags", F.array_join("Tags", "|"))
