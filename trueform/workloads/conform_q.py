"""Flagship: events -> spec -> process (F20, G1, G3, F22) -> summary (H1).

The driver tables are clean, so each workload first derives dirty text
deterministically from the row key. The dirt is plain SQL valid in Spark and
DuckDB, so both sides start from identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trueform.operators.process import process
from trueform.plans.spec import FieldSpec, TableSpec
from trueform.session import spread
from trueform.workloads.registry import register, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

EVENTS_SPEC = TableSpec(
    fields=(
        FieldSpec("event_type", "string", required=True, enum=EVENT_TYPES),
        FieldSpec("user_id", "integer", required=True),
        FieldSpec("day", "date", required=True),
        FieldSpec("value", "number", minimum=0, maximum=400, group_char=","),
    ),
    primary_key=("user_id", "event_type", "day"),
    case_field="event_id",
    flag_field="event_type",
)

# Dirty text per event, a pure function of event_id (valid in both dialects).
EVENTS_DIRT = """
  CAST(event_id AS STRING) AS event_id,
  CASE WHEN event_id % 17 = 0 THEN ''
       WHEN event_id % 19 = 0 THEN upper(event_type)
       WHEN event_id % 23 = 0 THEN concat(event_type, 'x')
       ELSE concat(' ', event_type) END AS event_type,
  CASE WHEN event_id % 29 = 0 THEN 'abc'
       WHEN event_id % 31 = 0 THEN concat(CAST(user_id AS STRING), '.0')
       WHEN event_id % 37 = 0 THEN concat(CAST(user_id AS STRING), '.5')
       ELSE CAST(user_id AS STRING) END AS user_id,
  CASE WHEN event_id % 7 = 0 THEN concat(CAST(month(ts) AS STRING), '/', CAST(day(ts) AS STRING), '/', CAST(year(ts) AS STRING))
       WHEN event_id % 41 = 0 THEN 'not a date'
       ELSE CAST(CAST(ts AS DATE) AS STRING) END AS day,
  CASE WHEN event_id % 13 = 0 THEN concat('1,', CAST(CAST(value AS DECIMAL(18,2)) AS STRING))
       WHEN event_id % 43 = 0 THEN 'n/a'
       ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS value
"""


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events")).selectExpr(*_split_select(EVENTS_DIRT))


def _split_select(sql: str) -> list[str]:
    """Split a SELECT list on top-level commas (outside brackets and quotes)."""
    out, depth, cur, quoted = [], 0, [], False
    for ch in sql:
        if ch == "'":
            quoted = not quoted
        elif not quoted and ch == "(":
            depth += 1
        elif not quoted and ch == ")":
            depth -= 1
        if ch == "," and depth == 0 and not quoted:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def run_events(spark: SparkSession, sf_dir: str, materialize: str | None = "persist"):
    return process(dirty_events(spark, sf_dir), EVENTS_SPEC, materialize=materialize)


# -- oracle ---------------------------------------------------------------------------------
NUM_RE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"

EVENTS_ORACLE_CTE = f"""
d AS (SELECT {EVENTS_DIRT} FROM events),
p AS (
  SELECT d.*,
    (event_type IS NULL OR trim(event_type) = '') AS et_blank,
    (user_id IS NULL OR trim(user_id) = '') AS uid_blank,
    (day IS NULL OR trim(day) = '') AS day_blank,
    (value IS NULL OR trim(value) = '') AS val_blank,
    CASE WHEN regexp_matches(user_id, '{NUM_RE}') THEN TRY_CAST(trim(user_id) AS DOUBLE) END AS uid_d,
    coalesce(TRY_CAST(try_strptime(trim(day), '%Y-%m-%d') AS DATE),
             TRY_CAST(try_strptime(trim(day), '%m/%d/%Y') AS DATE)) AS day_d,
    TRY_CAST(replace(trim(value), ',', '') AS DECIMAL(18,6)) AS val_d
  FROM d),
c AS (
  SELECT event_id, event_type AS et_raw, user_id AS uid_raw, day AS day_raw, value AS val_raw,
    CASE WHEN NOT et_blank AND lower(event_type) IN ('click','error','purchase','signup','view')
         THEN lower(event_type) END AS et,
    CASE WHEN NOT et_blank AND lower(event_type) NOT IN ('click','error','purchase','signup','view')
         THEN concat(event_type, ' is not in field mapping or valid value set') END AS et_r,
    CASE WHEN NOT uid_blank AND uid_d IS NOT NULL AND NOT isnan(uid_d) AND NOT isinf(uid_d) AND uid_d = round(uid_d)
         THEN CAST(uid_d AS BIGINT) END AS uid,
    CASE WHEN NOT uid_blank AND NOT (uid_d IS NOT NULL AND NOT isnan(uid_d) AND NOT isinf(uid_d) AND uid_d = round(uid_d))
         THEN concat(user_id, ' is not an integer') END AS uid_r,
    CASE WHEN NOT day_blank THEN day_d END AS dday,
    CASE WHEN NOT day_blank AND day_d IS NULL THEN concat(day, ' is not a valid date') END AS day_r,
    CASE WHEN NOT val_blank AND val_d IS NOT NULL AND val_d BETWEEN 0 AND 400 THEN val_d END AS val,
    CASE WHEN val_blank THEN NULL
         WHEN val_d IS NULL THEN concat(value, ' is not a valid number')
         WHEN val_d < 0 OR val_d > 400 THEN 'value must be within the range [0, 400]' END AS val_r
  FROM p),
s AS (SELECT c.*, (et IS NULL OR uid IS NULL OR dday IS NULL) AS miss FROM c),
k AS (SELECT s.*,
        sum(CASE WHEN miss THEN 0 ELSE 1 END) OVER (PARTITION BY uid, et, dday) AS n_key
      FROM s),
st AS (SELECT k.*, CASE WHEN miss THEN 'missing' WHEN n_key > 1 THEN 'duplicate' ELSE 'kept' END AS status FROM k)
"""

I4_SQL = f"""WITH {EVENTS_ORACLE_CTE}
SELECT event_id, et AS event_type, uid AS user_id, dday AS day, val AS value
FROM st WHERE status = 'kept'"""

G3_DROPPED_SQL = f"""WITH {EVENTS_ORACLE_CTE}
SELECT event_id,
  CASE WHEN status = 'duplicate' THEN et ELSE et_raw END AS event_type,
  CASE WHEN status = 'duplicate' THEN CAST(uid AS STRING) ELSE uid_raw END AS user_id,
  CASE WHEN status = 'duplicate' THEN CAST(dday AS STRING) ELSE day_raw END AS day,
  val_raw AS value,
  status AS drop_kind,
  CASE WHEN status = 'missing' THEN array_to_string(list_filter(
      [CASE WHEN et IS NULL THEN 'event_type' END, CASE WHEN uid IS NULL THEN 'user_id' END,
       CASE WHEN dday IS NULL THEN 'day' END], lambda x: x IS NOT NULL), ',') END AS missing_fields
FROM st WHERE status <> 'kept'"""

F22_SQL = f"""WITH {EVENTS_ORACLE_CTE}
SELECT event_id AS case_number, 'event_type' AS field_name, et_raw AS milestone_flag,
       et_raw AS original_value, et_r AS reason FROM st WHERE et_r IS NOT NULL
UNION ALL
SELECT event_id, 'user_id', et, uid_raw, uid_r FROM st WHERE uid_r IS NOT NULL
UNION ALL
SELECT event_id, 'day', et, day_raw, day_r FROM st WHERE day_r IS NOT NULL
UNION ALL
SELECT event_id, 'value', et, val_raw, val_r FROM st WHERE val_r IS NOT NULL AND status = 'kept'"""

H1_SQL = f"""WITH {EVENTS_ORACLE_CTE}
SELECT CAST(count(*) FILTER (WHERE status = 'kept') AS BIGINT) AS rows_to_upload,
       CAST(count(*) FILTER (WHERE status <> 'kept') AS BIGINT) AS rows_dropped,
       CAST(count(et_r) + count(uid_r) + count(day_r) + count(val_r) FILTER (WHERE status = 'kept') AS BIGINT)
         AS values_dropped
FROM st"""


@register("i4_process", I4_SQL)
def i4_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: conformed rows of the dirty events."""
    return run_events(spark, sf_dir).conformed


@register("g3_dropped", G3_DROPPED_SQL)
def g3_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + G3: rows dropped for a missing required field or a duplicated key."""
    from pyspark.sql import functions as F
    d = run_events(spark, sf_dir).dropped
    return d.withColumn("missing_fields", F.array_join("missing_fields", ","))


@register("f22_invalid_values", F22_SQL)
def f22_invalid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F21 + F22 + G4: one record per invalid cell, optional ones only for kept rows."""
    return run_events(spark, sf_dir).invalid


@register("h1_summary", H1_SQL)
def h1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: rows to upload, rows dropped, values dropped."""
    return run_events(spark, sf_dir).summary()


G2_SQL = "WITH " + EVENTS_ORACLE_CTE.replace(
    "CASE WHEN NOT day_blank THEN day_d END AS dday", "CAST(NULL AS DATE) AS dday").replace(
    "CASE WHEN NOT day_blank AND day_d IS NULL THEN concat(day, ' is not a valid date') END AS day_r",
    "CAST(NULL AS VARCHAR) AS day_r") + """
SELECT event_id, et_raw AS event_type, uid_raw AS user_id, val_raw AS value, status AS drop_kind,
  array_to_string(list_filter([CASE WHEN et IS NULL THEN 'event_type' END, CASE WHEN uid IS NULL THEN 'user_id' END,
                               'day'], lambda x: x IS NOT NULL), ',') AS missing_fields
FROM st"""


@register("g2_absent", G2_SQL)
def g2_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required column missing from the data reads as all null, so every row drops."""
    from pyspark.sql import functions as F
    res = process(dirty_events(spark, sf_dir).drop("day"), EVENTS_SPEC)
    return res.dropped.withColumn("missing_fields", F.array_join("missing_fields", ","))


I4_STORED_SQL = f"""WITH {EVENTS_ORACLE_CTE},
inv AS ({F22_SQL.split(EVENTS_ORACLE_CTE, 1)[1]}),
kinds AS (SELECT 'conformed' AS kind, event_id, et AS event_type, CAST(uid AS STRING) AS user_id, NULL AS reason FROM st WHERE status = 'kept'
  UNION ALL SELECT 'dropped', event_id, CASE WHEN status = 'duplicate' THEN et ELSE et_raw END,
    CASE WHEN status = 'duplicate' THEN CAST(uid AS STRING) ELSE uid_raw END, status FROM st WHERE status <> 'kept'
  UNION ALL SELECT 'invalid', case_number, field_name, original_value, reason FROM inv)
SELECT kinds.*, s.* FROM kinds CROSS JOIN ({H1_SQL.split(EVENTS_ORACLE_CTE, 1)[1]}) s"""


@register("i4_stored", I4_STORED_SQL)
def i4_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4, F22, G4, H1 in one pass: every output row by kind, with the summary observed while they were written."""
    from pyspark.sql import functions as F
    res = run_events(spark, sf_dir).store()
    rows = (res.conformed.select(F.lit("conformed").alias("kind"), "event_id", "event_type", F.col("user_id").cast("string"), F.lit(None).cast("string").alias("reason"))
            .unionByName(res.dropped.select(F.lit("dropped").alias("kind"), "event_id", "event_type", "user_id", F.col("drop_kind").alias("reason")))
            .unionByName(res.invalid.select(F.lit("invalid").alias("kind"), F.col("case_number").alias("event_id"), F.col("field_name").alias("event_type"),
                                            F.col("original_value").alias("user_id"), "reason")))
    return rows.select("*", *[F.lit(n).alias(k) for k, n in res.counts.items()])
