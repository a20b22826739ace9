"""Report workloads (H2-H6) over the flagship run and the mapping checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from trueform.operators import reports as R
from trueform.operators import rows
from trueform.workloads.conform_q import EVENTS_ORACLE_CTE, EVENTS_SPEC, run_events
from trueform.workloads.expect_q import value_mapping_rows, VALMAP_SQL
from trueform.workloads.mapping_q import GEN_SQL, CUSTOMER_SPEC, dirty_customers
from trueform.operators import mapping as M
from trueform.operators import expectations as X
from trueform.workloads.registry import register

_DUP = R.DUPLICATE_TEXT.replace("'", "''")


@register("h2_dropped_explain", f"""WITH {EVENTS_ORACLE_CTE}
SELECT event_id AS case_number,
  CASE WHEN status = 'duplicate' THEN et ELSE et_raw END AS milestone_flag, status AS drop_kind,
  concat('(CaseNumber: ''', event_id, ''', MilestoneFlag: ''',
         coalesce(CASE WHEN status = 'duplicate' THEN et ELSE et_raw END, 'None'), ''') ',
    CASE WHEN status = 'duplicate' THEN '{_DUP}'
         ELSE concat('Dropped because of ', array_to_string(list_filter([
           CASE WHEN et IS NULL THEN CASE WHEN coalesce(et_raw, '') <> '' THEN concat('event_type (Invalid value: ', et_raw, ')')
                                          ELSE 'event_type (missing)' END END,
           CASE WHEN uid IS NULL THEN CASE WHEN coalesce(uid_raw, '') <> '' THEN concat('user_id (Invalid value: ', uid_raw, ')')
                                           ELSE 'user_id (missing)' END END,
           CASE WHEN dday IS NULL THEN CASE WHEN coalesce(day_raw, '') <> '' THEN concat('day (Invalid value: ', day_raw, ')')
                                            ELSE 'day (missing)' END END], lambda x: x IS NOT NULL), ', ')) END)
    AS explanation
FROM st WHERE status <> 'kept'""")
def h2_dropped_explain(spark, sf_dir):
    """H2: one explanation line per dropped row."""
    d = run_events(spark, sf_dir).dropped
    return R.dropped_explanations(d, case_field="event_id", flag_field="event_type",
                                  fields=[f.name for f in EVENTS_SPEC.fields])


@register("h3_invalid_explain", f"""WITH {EVENTS_ORACLE_CTE},
inv AS (
  SELECT event_id AS case_number, 'event_type' AS field_name, et_raw AS milestone_flag, et_raw AS original_value,
         et_r AS reason FROM st WHERE et_r IS NOT NULL
  UNION ALL SELECT event_id, 'user_id', et, uid_raw, uid_r FROM st WHERE uid_r IS NOT NULL
  UNION ALL SELECT event_id, 'day', et, day_raw, day_r FROM st WHERE day_r IS NOT NULL
  UNION ALL SELECT event_id, 'value', et, val_raw, val_r FROM st WHERE val_r IS NOT NULL AND status = 'kept')
SELECT case_number, field_name,
  concat('(CaseNumber: ''', coalesce(case_number, 'None'), ''', Milestone: ''', coalesce(milestone_flag, 'None'),
         ''') Invalid value for ', field_name, ': ''', coalesce(original_value, 'None'), '''. Reason: ', reason)
    AS explanation
FROM inv""")
def h3_invalid_explain(spark, sf_dir):
    """H3: one explanation line per invalid value."""
    return R.invalid_explanations(run_events(spark, sf_dir).invalid)


@register("h4_failures_explain", f"""WITH m AS ({VALMAP_SQL}),
f AS (
  SELECT field AS dataset, 'expect_column_values_to_be_unique' AS expectation, 'input' AS column_name, input AS failed_value
  FROM m WHERE input IS NOT NULL GROUP BY field, input HAVING count(*) > 1
  UNION ALL SELECT field, 'expect_column_values_to_be_in_set', 'output', output FROM m
  WHERE output IS NOT NULL AND output NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY','')
  UNION ALL SELECT field, 'expect_column_values_to_be_in_set', 'approved', approved FROM m
  WHERE approved IS NOT NULL AND approved NOT IN ('Yes','No','None'))
SELECT dataset, expectation, column_name, failed_value,
  CASE WHEN expectation = 'expect_column_values_to_be_unique'
       THEN concat('No duplicates allowed for "', column_name, '". This value had duplicates: ', failed_value)
       ELSE concat('Some values for "', column_name, '" are invalid: ', failed_value) END AS explanation
FROM f""")
def h4_failures_explain(spark, sf_dir):
    """H4: one explanation line per failed expectation value."""
    return R.failure_explanations(X.check_value_mappings(value_mapping_rows(spark, sf_dir), CUSTOMER_SPEC))


@register("h5_unapproved", f"""WITH g AS ({GEN_SQL})
SELECT field, input, concat('''', input, ''' -> ''', coalesce(output, 'None'), '''') AS line FROM g
WHERE coalesce(approved, '') <> 'Yes'""")
def h5_unapproved(spark, sf_dir):
    """H5: unapproved suggestions per field."""
    return R.unapproved_lines(M.generate(dirty_customers(spark, sf_dir), CUSTOMER_SPEC))


@register("h6_adjust", f"""WITH {EVENTS_ORACLE_CTE}
SELECT CAST(count(*) FILTER (WHERE status = 'kept') - count(*) FILTER (WHERE status = 'kept' AND CAST(event_id AS BIGINT) % 50 = 0) AS BIGINT)
         AS rows_to_upload,
       CAST(count(*) FILTER (WHERE status <> 'kept') + count(*) FILTER (WHERE status = 'kept' AND CAST(event_id AS BIGINT) % 50 = 0) AS BIGINT)
         AS rows_dropped,
       CAST(count(et_r) + count(uid_r) + count(day_r) + count(val_r) FILTER (WHERE status = 'kept') AS BIGINT)
         AS values_dropped
FROM st""")
def h6_adjust(spark, sf_dir):
    """H6: summary after rejecting listed cases from the conformed rows."""
    res = run_events(spark, sf_dir)
    listed = res.conformed.where(F.col("event_id").cast("bigint") % 50 == 0).select("event_id")
    _, rejected = rows.reject_by_keys(res.conformed, listed, key_col="event_id")
    return R.adjust_summary(res.summary(), rejected)
