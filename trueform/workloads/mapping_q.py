"""Value-mapping workloads (E1, E3-E5, E7-E9) over customer segments with typos."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueform.operators import mapping
from trueform.plans.spec import FieldSpec, TableSpec
from trueform.workloads.conform_q import NUM_RE, _split_select
from trueform.session import scratch_path, spread
from trueform.workloads.registry import register, table

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

CUSTOMER_SPEC = TableSpec(
    fields=(
        FieldSpec("segment", "string", enum=SEGMENTS),
        FieldSpec("active", "boolean"),
    ),
    primary_key=("c_custkey",),
    case_field="c_custkey",
    flag_field="segment",
)

CUSTOMER_DIRT = """
  c_custkey,
  CASE c_custkey % 7 WHEN 0 THEN substr(c_mktsegment, 1, length(c_mktsegment) - 1)
       WHEN 1 THEN concat(c_mktsegment, 's')
       WHEN 2 THEN lower(c_mktsegment)
       WHEN 3 THEN 'misc'
       WHEN 4 THEN concat(substr(c_mktsegment, 2, 3), '-', substr(c_mktsegment, 5, 2))
       WHEN 5 THEN CAST(c_nationkey AS STRING)
       ELSE concat(lower(c_mktsegment), '_', CAST(c_nationkey AS STRING)) END AS segment,
  CASE c_custkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'Nope' WHEN 2 THEN 'ture' WHEN 3 THEN 'y'
       ELSE '1' END AS active
"""

# Approved/unapproved source mappings, a pure function of the customer rows.
SOURCE_MAP_SQL = """
  SELECT DISTINCT 'segment' AS field,
         concat(lower(c_mktsegment), '_', CAST(c_nationkey AS STRING)) AS input,
         CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS output,
         CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS approved
  FROM customer
"""


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "customer")).selectExpr(*_split_select(CUSTOMER_DIRT))


def source_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.lit("segment").alias("field"),
        F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_nationkey").cast("string")).alias("input"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("output"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("approved"),
    ).distinct()


# -- oracle pieces ---------------------------------------------------------------------------
_SEG_LOWER = "('automobile','building','furniture','household','machinery')"
_BOOL_LOWER = "('yes','y','true','t','1','no','n','false','f','2')"

CANDS_CTE = f"""d AS (SELECT {CUSTOMER_DIRT} FROM customer),
p AS (SELECT 'segment' AS field, segment AS raw FROM d UNION ALL SELECT 'active', active FROM d),
cands AS (SELECT DISTINCT field, raw FROM p
  WHERE raw IS NOT NULL AND trim(raw) <> '' AND NOT regexp_matches(raw, '{NUM_RE}')
    AND NOT (field = 'segment' AND lower(raw) IN {_SEG_LOWER})
    AND NOT (field = 'active' AND lower(raw) IN {_BOOL_LOWER}))"""

_KEY = ("array_to_string(list_sort(list_filter(string_split_regex(trim(lower(regexp_replace("
        "regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9_]', ' ', 'g'))), '\\s+'), "
        "lambda t: t <> '')), ' ')")

_LCS = ("list_last(list_reduce(list_transform(range(1, length(a) + 1), lambda i: substr(a, i, 1)), "
        "lambda prev, ch: list_reduce(range(1, length(b) + 1), lambda row, j: list_append(row, "
        "CASE WHEN substr(b, j, 1) = ch THEN prev[j] + 1 ELSE greatest(prev[j + 1], row[-1]) END), "
        "[0::BIGINT]), list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT)))")

OPTIONS_VALUES = ", ".join(
    [f"('segment', '{o}', {i})" for i, o in enumerate(SEGMENTS)]
    + [f"('active', '{o}', {i})" for i, o in enumerate(("yes", "Y", "true", "T", "1", "no", "N", "false", "F", "2"))]
)

BEST_CTE = f"""{CANDS_CTE},
opts AS (SELECT * FROM (VALUES {OPTIONS_VALUES}) AS t(field, option, pos)),
pairs AS (SELECT c.field, c.raw, o.option, o.pos, {_KEY.format(x='c.raw')} AS a, {_KEY.format(x='o.option')} AS b
          FROM cands c JOIN opts o ON c.field = o.field),
scored AS (SELECT field, raw, option, pos,
             CASE WHEN length(a) + length(b) = 0 THEN 0
                  WHEN length(a) = 0 OR length(b) = 0 THEN 0
                  ELSE CAST(round_even(100.0 * ((2.0 * {_LCS}) / (length(a) + length(b))), 0) AS INTEGER) END AS score
           FROM pairs),
best AS (SELECT field, raw, arg_max(option, score * 1000 - pos) AS option, max(score) AS score
         FROM scored GROUP BY field, raw)"""


@register("e3_candidates", f"WITH {CANDS_CTE} SELECT field, raw FROM cands")
def e3_candidates(spark, sf_dir):
    """Distinct raw values needing a suggestion (one pass, partial aggregation)."""
    return mapping.candidates(dirty_customers(spark, sf_dir), CUSTOMER_SPEC)


@register("e4_fuzzy", f"WITH {BEST_CTE} SELECT field, raw, option, score FROM best")
def e4_fuzzy(spark, sf_dir):
    """Best option by token-sort similarity; first option on a tie."""
    c = mapping.candidates(dirty_customers(spark, sf_dir), CUSTOMER_SPEC)
    return mapping.best_options(c, CUSTOMER_SPEC)


@register("e5_threshold", f"""WITH {BEST_CTE}
SELECT field, raw AS input, CASE WHEN score > 70 THEN option END AS output, 'No' AS approved FROM best""")
def e5_threshold(spark, sf_dir):
    """E5 with a stricter threshold (70)."""
    c = mapping.candidates(dirty_customers(spark, sf_dir), CUSTOMER_SPEC)
    return mapping.suggest(mapping.best_options(c, CUSTOMER_SPEC), threshold=70)


GEN_SQL = f"""WITH {BEST_CTE}
SELECT field, raw AS input, CASE WHEN score > 50 THEN option END AS output, 'No' AS approved FROM best"""


@register("e7_generate", GEN_SQL)
def e7_generate(spark, sf_dir):
    """Generated suggestions (E2-E6), never approved."""
    return mapping.generate(dirty_customers(spark, sf_dir), CUSTOMER_SPEC)


@register("e7_undecided", f"""WITH g AS ({GEN_SQL})
SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM ({SOURCE_MAP_SQL}) s
  WHERE s.approved = 'Yes' AND s.field = g.field AND s.input = g.input)""")
def e7_undecided(spark, sf_dir):
    """E7 for the inputs that no approved mapping decides; the others are never scored."""
    decided = mapping.approved_only(source_mappings(spark, sf_dir))
    return mapping.generate(dirty_customers(spark, sf_dir), CUSTOMER_SPEC, decided=decided)


@register("e7_rerun", GEN_SQL)
def e7_rerun(spark, sf_dir):
    """E7 in two runs that share a dictionary: one of the customers in debt, then one of all."""
    dirty = dirty_customers(spark, sf_dir)
    debtors = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    path = scratch_path(spark, f"suggestions-{uuid.uuid4().hex[:12]}")
    mapping.generate(dirty.join(debtors, "c_custkey", "left_semi"), CUSTOMER_SPEC, dictionary=path)
    return mapping.generate(dirty, CUSTOMER_SPEC, dictionary=path)


@register("e8_approved", f"SELECT * FROM ({SOURCE_MAP_SQL}) s WHERE approved = 'Yes'")
def e8_approved(spark, sf_dir):
    return mapping.approved_only(source_mappings(spark, sf_dir))


_RESOLVE = """WITH n AS ({gen}),
s AS (SELECT * FROM ({src}) s0 WHERE approved = 'Yes')
SELECT coalesce(n.field, s.field) AS field, coalesce(n.input, s.input) AS input,
  CASE WHEN {pick_new} THEN n.output ELSE s.output END AS output,
  CASE WHEN {pick_new} THEN n.approved ELSE s.approved END AS approved
FROM n FULL OUTER JOIN s ON n.field = s.field AND n.input = s.input"""


def _resolve_sql(overwrite: bool) -> str:
    pick_new = "n.field IS NOT NULL" if overwrite else "s.field IS NULL"
    gen = f"WITH {BEST_CTE} SELECT field, raw AS input, CASE WHEN score > 50 THEN option END AS output, " \
          f"'No' AS approved FROM best"
    return _RESOLVE.format(gen=gen, src=SOURCE_MAP_SQL, pick_new=pick_new)


@register("e9_resolve_source", _resolve_sql(False))
def e9_resolve_source(spark, sf_dir):
    """Approved source mappings win on a clash."""
    new = mapping.generate(dirty_customers(spark, sf_dir), CUSTOMER_SPEC)
    return mapping.resolve(new, source_mappings(spark, sf_dir), overwrite=False)


@register("e9_resolve_new", _resolve_sql(True))
def e9_resolve_new(spark, sf_dir):
    """E9 with overwrite: generated suggestions win on a clash."""
    new = mapping.generate(dirty_customers(spark, sf_dir), CUSTOMER_SPEC)
    return mapping.resolve(new, source_mappings(spark, sf_dir), overwrite=True)


@register("e1_last_wins", """
SELECT field, input, arg_max(output, pos) AS output, arg_max(approved, pos) AS approved FROM (
  SELECT 'segment' AS field, lower(c_mktsegment) AS input, c_mktsegment AS output,
         CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS approved, c_custkey AS pos FROM customer) t
GROUP BY field, input""")
def e1_last_wins(spark, sf_dir):
    """A mapping listed several times keeps its last row."""
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.lit("segment").alias("field"), F.lower("c_mktsegment").alias("input"),
                    F.col("c_mktsegment").alias("output"),
                    F.when(F.col("c_custkey") % 2 == 0, "Yes").otherwise("No").alias("approved"),
                    F.col("c_custkey").alias("position"))
    return mapping.last_wins(rows)


CONFLICT_SQL = """SELECT 'segment' AS field, concat('n', CAST(c_nationkey % 5 AS STRING)) AS input, c_mktsegment AS output
  FROM customer
  UNION ALL
  SELECT 'segment', concat('c', CAST(c_custkey AS STRING)), c_mktsegment FROM customer"""


@register("e6_conflicts", f"""SELECT field, input, CAST(count(DISTINCT output) AS BIGINT) AS n
FROM ({CONFLICT_SQL}) m GROUP BY field, input HAVING count(DISTINCT output) > 1""")
def e6_conflicts(spark, sf_dir):
    """Inputs mapped to more than one output (aggregation on the key columns)."""
    c = table(spark, sf_dir, "customer")
    m = c.select(F.lit("segment").alias("field"),
                 F.concat(F.lit("n"), (F.col("c_nationkey") % 5).cast("string")).alias("input"),
                 F.col("c_mktsegment").alias("output")).unionByName(
        c.select(F.lit("segment").alias("field"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("input"),
                 F.col("c_mktsegment").alias("output")))
    return mapping.conflicts(m)
