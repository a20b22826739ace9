"""Spec checks and wide names over specs held as a table (B2-B9), derived from parts and customers."""

from __future__ import annotations

from trueform.plans import spec_relation as R
from trueform.workloads.registry import register, table

# One spec row per part; coded labels come from the customers that share its group.
SPEC_FIELDS = {
    "site": "concat('site-', CAST(p_size AS STRING))",
    "field": "concat('Field', CAST(p_partkey AS STRING))",
    "type": "CASE WHEN p_partkey % 5 = 0 THEN 'string' ELSE 'integer' END",
    "minimum": "CASE WHEN p_partkey % 13 > 0 THEN p_partkey % 3 END",
    "maximum": "CASE WHEN p_partkey % 17 > 0 THEN p_partkey % 3 + p_partkey % 7 - 1 END",
}
SITE_MILESTONES = ("Intake", "Start", "Exit", "Follow")


def spec_rows(spark, sf_dir):
    """One spec row per part; the labels that a group of parts shares are named, not copied (:func:`label_rows`)."""
    names = ", ".join(f"'{m}'" for m in SITE_MILESTONES)
    part = table(spark, sf_dir, "part").selectExpr(
        *[f"{sql} AS {name}" for name, sql in SPEC_FIELDS.items()], "p_partkey % 400 AS label_set",
        f"CASE WHEN p_size % 11 > 0 THEN array({names}) END AS milestone_names",
        "CASE WHEN p_partkey % 4 > 0 THEN transform(sequence(0, p_partkey % 6), x -> CAST(x AS INT)) END AS milestones",
        "CASE WHEN p_partkey % 8 = 1 THEN array(named_struct('position', CAST(p_partkey % 9 AS INT), 'name', p_brand)) ELSE array() END AS custom_names")
    return part.selectExpr(
        "site", "milestone_names", "field", "type", "CAST(minimum AS BIGINT) AS minimum", "CAST(maximum AS BIGINT) AS maximum",
        "milestones", "CAST(custom_names AS array<struct<position:int,name:string>>) AS custom_names", "label_set")


def label_rows(spark, sf_dir):
    """(label_set, label, code): the coded labels, one row per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey % 300 AS label_set", "c_name AS label", "CAST(c_nationkey % 6 AS BIGINT) AS code")


_NAMES = ", ".join(f"'{m}'" for m in SITE_MILESTONES)
SPEC_CTE = f"""lab AS (SELECT c_custkey % 300 AS grp, list_sort(list_distinct(list(c_nationkey % 6))) AS codes FROM customer GROUP BY 1),
sp AS (SELECT {', '.join(f'{sql} AS "{name}"' for name, sql in SPEC_FIELDS.items())}, codes, p_size % 11 > 0 AS named,
         CASE WHEN p_partkey % 4 > 0 THEN range(0, p_partkey % 6 + 1) END AS ms,
         CASE WHEN p_partkey % 8 = 1 THEN p_partkey % 9 END AS cpos, p_brand AS cname
       FROM part LEFT JOIN lab ON lab.grp = p_partkey % 400)"""
_TEXT = "'[' || array_to_string(list_sort(list_filter({0}, lambda x: NOT list_contains({1}, x))), ', ') || ']'"
B_SQL = f"""WITH {SPEC_CTE},
cov AS (SELECT *, CASE WHEN maximum >= minimum THEN range(minimum, maximum + 1) ELSE [] END AS span FROM sp WHERE codes IS NOT NULL AND minimum IS NOT NULL AND maximum IS NOT NULL)
SELECT DISTINCT site, CAST(NULL AS VARCHAR) AS field, 'milestone_names' AS "check", 'the spec names no milestones' AS detail FROM sp WHERE NOT named
UNION ALL SELECT site, field, 'milestone_index', 'no milestone has position ' || p FROM (SELECT site, field, named, unnest(ms) AS p FROM sp) WHERE named AND p >= {len(SITE_MILESTONES)}
UNION ALL SELECT site, field, 'custom_name_index', 'a wide column is named for milestone position ' || cpos || ' (column ' || cname || '), which does not exist' FROM sp WHERE named AND cpos >= {len(SITE_MILESTONES)}
UNION ALL SELECT site, field, 'label_map_type', 'coded labels need type integer, not ' || type FROM sp WHERE codes IS NOT NULL AND type <> 'integer'
UNION ALL SELECT site, field, 'label_map_bounds', 'coded labels need a minimum and a maximum' FROM sp WHERE codes IS NOT NULL AND (minimum IS NULL OR maximum IS NULL)
UNION ALL SELECT site, field, 'label_map_cover', 'codes without a label: ' || {_TEXT.format('span', 'codes')} || ', codes beyond the bounds: ' || {_TEXT.format('codes', 'span')}
  FROM cov WHERE list_sort(span) <> codes"""


@register("b4_spec_checks", B_SQL)
def b4_spec_checks(spark, sf_dir):
    """Problems of all sites' specs in one pass."""
    return R.check_specs(spec_rows(spark, sf_dir), label_rows(spark, sf_dir))


B2_SQL = f"""WITH {SPEC_CTE}
SELECT site, CAST(NULL AS VARCHAR) AS milestone, field AS wide_name, field FROM sp WHERE ms IS NULL
UNION ALL SELECT site, m, CASE WHEN cpos = p THEN cname ELSE m || field END, field
FROM (SELECT site, field, cpos, cname, p, ([{_NAMES}])[p + 1] AS m FROM (SELECT *, unnest(ms) AS p FROM sp WHERE named)) WHERE p < {len(SITE_MILESTONES)}"""


@register("b2_wide_names", B2_SQL)
def b2_wide_names(spark, sf_dir):
    """Wide column names of all sites' specs."""
    return R.wide_names(spec_rows(spark, sf_dir))
