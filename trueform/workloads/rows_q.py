"""Row-filter workloads (G3, G5-G7, G9, G10, A8) on events and orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trueform.operators import rows
from trueform.workloads.registry import register, table

# -- G3 on clean events -----------------------------------------------------------------------
@register("g3_keep_none", """
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS n FROM events) t
WHERE n = 1""")
def g3_keep_none(spark, sf_dir):
    """Every copy of a duplicated (user, type, day) key is dropped."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    kept, _ = rows.keep_none_dedupe(e, ["user_id", "event_type", "day"])
    return kept


# -- gateway responses built from order keys ------------------------------------------------------
RESPONSES_SQL = """SELECT o_orderkey AS response_id,
  CASE WHEN o_orderkey % 10 = 0 THEN concat('No ''Intake'' records found<br/><br/>Case: C', CAST(o_orderkey AS VARCHAR),
         '  Member: M', CAST(o_custkey AS VARCHAR), '<br/>Case: C', CAST(o_orderkey + 5 AS VARCHAR),
         '    Member: M', CAST(o_custkey AS VARCHAR), '<br/>')
       WHEN o_orderkey % 10 = 1 THEN 'Internal error'
       ELSE 'ok' END AS text,
  CASE WHEN o_orderkey % 10 = 1 THEN 500 WHEN o_orderkey % 10 = 0 THEN 400 ELSE 202 END AS status
FROM orders"""


def responses(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    text = (F.when(F.col("o_orderkey") % 10 == 0,
                   F.concat(F.lit("No 'Intake' records found<br/><br/>Case: C"), k, F.lit("  Member: M"), c,
                            F.lit("<br/>Case: C"), (F.col("o_orderkey") + 5).cast("string"),
                            F.lit("    Member: M"), c, F.lit("<br/>")))
            .when(F.col("o_orderkey") % 10 == 1, F.lit("Internal error")).otherwise(F.lit("ok")))
    status = (F.when(F.col("o_orderkey") % 10 == 1, 500).when(F.col("o_orderkey") % 10 == 0, 400)
              .otherwise(202))
    return o.select(F.col("o_orderkey").alias("response_id"), text.alias("text"), status.alias("status"))


def cases(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("CaseNumber"),
                    F.col("o_orderpriority").alias("MilestoneFlag"), F.col("o_custkey").alias("member"))


_KEYS_SQL = f"""SELECT DISTINCT unnest(regexp_extract_all(text, 'Case:\\s+(.*?)\\s+Member:', 1)) AS CaseNumber
FROM ({RESPONSES_SQL}) r"""
_CASES_SQL = """SELECT concat('C', CAST(o_orderkey AS VARCHAR)) AS CaseNumber, o_orderpriority AS MilestoneFlag,
  o_custkey AS member FROM orders"""


@register("g5_extract_keys", _KEYS_SQL)
def g5_extract_keys(spark, sf_dir):
    """All Case tokens of the response texts, distinct."""
    return rows.extract_keys(responses(spark, sf_dir))


@register("g6_reject", f"""SELECT * FROM ({_CASES_SQL}) c WHERE CaseNumber NOT IN ({_KEYS_SQL})""")
def g6_reject(spark, sf_dir):
    """Rows kept after rejecting the listed cases."""
    kept, _ = rows.reject_by_keys(cases(spark, sf_dir), rows.extract_keys(responses(spark, sf_dir)))
    return kept


@register("g6_rejected", f"""SELECT *, 'missing_intake_record' AS drop_kind FROM ({_CASES_SQL}) c
WHERE CaseNumber IN ({_KEYS_SQL})""")
def g6_rejected(spark, sf_dir):
    """Rejected rows, tagged."""
    _, dropped = rows.reject_by_keys(cases(spark, sf_dir), rows.extract_keys(responses(spark, sf_dir)))
    return dropped


@register("g10_classify", f"""SELECT response_id, text, status,
  CASE WHEN contains(text, 'No ''Intake'' records found') THEN 'retry' WHEN status <> 202 THEN 'error'
       ELSE 'accepted' END AS outcome FROM ({RESPONSES_SQL}) r""")
def g10_classify(spark, sf_dir):
    """Retry after a key rejection / error / accepted."""
    return rows.classify_responses(responses(spark, sf_dir))


# -- G7, G9, A8: run windows -----------------------------------------------------------------------
@register("g7_range", """SELECT event_id, user_id, event_type, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'""")
def g7_range(spark, sf_dir):
    """G7 + G8: inclusive day-bounded window on the last-modified column, column dropped."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value",
                                              F.col("ts").alias(rows.LAST_MODIFIED))
    return rows.time_range_filter(e, dt.date(2024, 1, 5), dt.date(2024, 1, 20))


WINDOWS_SQL = """SELECT m.user_id AS member_id,
  CAST(coalesce(w.last_success_date, DATE '2023-12-31') + INTERVAL 1 DAY AS DATE) AS window_start,
  DATE '2024-01-30' AS window_end
FROM (SELECT DISTINCT user_id FROM events) m
LEFT JOIN (SELECT DISTINCT user_id, DATE '2024-01-10' + CAST(user_id % 5 AS INTEGER) AS last_success_date
           FROM events WHERE user_id % 3 = 0) w ON m.user_id = w.user_id"""


def windows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    members = e.select(F.col("user_id").alias("member_id")).distinct()
    marks = (e.where(F.col("user_id") % 3 == 0)
             .select(F.col("user_id").alias("member_id"),
                     F.date_add(F.lit(dt.date(2024, 1, 10)), (F.col("user_id") % 5).cast("int"))
                     .alias("last_success_date")).distinct())
    return rows.incremental_windows(members, marks, dt.date(2024, 1, 1), dt.date(2024, 1, 30))


@register("g9_incremental", WINDOWS_SQL)
def g9_incremental(spark, sf_dir):
    """Per member window from the day after the last success to the run date."""
    return windows(spark, sf_dir)


@register("a8_run_window", f"""SELECT e.event_id, e.user_id, e.event_type FROM events e
JOIN ({WINDOWS_SQL}) w ON e.user_id = w.member_id
WHERE e.ts BETWEEN CAST(w.window_start AS TIMESTAMP)
              AND CAST(w.window_end AS TIMESTAMP) + INTERVAL 86399 SECOND""")
def a8_run_window(spark, sf_dir):
    """Each member's rows inside its own run window (day bounds, inclusive)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    found = rows.run_window_scan(e, windows(spark, sf_dir), "ts", "user_id",
                                 earliest=dt.date(2024, 1, 1), latest=dt.date(2024, 1, 30))
    return found.select("event_id", "user_id", "event_type")
