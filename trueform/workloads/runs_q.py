"""Gated conform runs (I1-I3) on dirty events with site column names."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trueform.plans import pipeline as P
from trueform.plans.spec import FieldSpec, TableSpec
from trueform.session import scratch_path
from trueform.sources import files
from trueform.sources import mappings_io as MIO
from trueform.workloads.conform_q import EVENTS_DIRT, EVENTS_ORACLE_CTE, EVENTS_SPEC, dirty_events
from trueform.workloads.conform_q import EVENT_TYPES
from trueform.workloads.registry import register, table

RUN_SPEC = TableSpec(fields=EVENTS_SPEC.fields + (FieldSpec("event_id"),), milestone_names=(),
                     primary_key=EVENTS_SPEC.primary_key, case_field="event_id", flag_field="event_type")
SITE_COLMAP = {"EventKind": "event_type", "UserRef": "user_id", "Day": "day", "Amount": "value",
               "event_id": "event_id"}


def site_events(spark, sf_dir):
    d = dirty_events(spark, sf_dir)
    return d.select("event_id", *[F.col(src).alias(dst) for dst, src in
                                  (("EventKind", "event_type"), ("UserRef", "user_id"), ("Day", "day"),
                                   ("Amount", "value"))])


def site_mappings(spark, sf_dir):
    """Approved mappings for the typo spellings, derived from the events."""
    e = table(spark, sf_dir, "events")
    return e.select(F.lit("event_type").alias("field"), F.concat("event_type", F.lit("x")).alias("input"),
                    F.col("event_type").alias("output"), F.lit("Yes").alias("approved")).distinct()


def colmap_frame(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), "`Internal Column Name` string, `Mission Impact Field Name` string")


_TYPES = ", ".join(f"'{t}x'" for t in EVENT_TYPES)
I1_SQL = "WITH " + EVENTS_ORACLE_CTE.replace(
    f"d AS (SELECT {EVENTS_DIRT} FROM events),",
    f"""d0 AS (SELECT {EVENTS_DIRT} FROM events),
d AS (SELECT event_id,
        CASE WHEN trim(event_type) IN ({_TYPES}) THEN substr(trim(event_type), 1, length(trim(event_type)) - 1)
             ELSE trim(event_type) END AS event_type,
        trim(user_id) AS user_id, trim(day) AS day, trim(value) AS value FROM d0),""") + """
SELECT event_id, et AS event_type, uid AS user_id, dday AS day, val AS value FROM st WHERE status = 'kept'"""


@register("i1_conform", I1_SQL)
def i1_conform(spark, sf_dir):
    """Spec check, C8, C9, C11, shape, suggestions, resolve, approval gate, process."""
    res = P.conform({"site": site_events(spark, sf_dir)}, RUN_SPEC, colmap_frame(spark, SITE_COLMAP),
                    site_mappings(spark, sf_dir), member_id=None)
    if res.status != P.SUCCESS:
        raise RuntimeError(f"conform ended with {res.status}")
    return res.dataset.select("event_id", "event_type", "user_id", "day", "value")


@register("i2_conform_files", I1_SQL)
def i2_conform_files(spark, sf_dir):
    """The same run from delimited files: two site extracts, a column-mapping
    file and a value-mapping folder (A1, A14, A10)."""
    root = scratch_path(spark, f"i2-{uuid.uuid4().hex[:12]}")
    ev = site_events(spark, sf_dir)
    files.write_delimited(ev.where(F.col("event_id").cast("bigint") % 2 == 0), f"{root}/site_even")
    files.write_delimited(ev.where(F.col("event_id").cast("bigint") % 2 == 1), f"{root}/site_odd")
    files.write_delimited(colmap_frame(spark, SITE_COLMAP), f"{root}/colmap")
    MIO.write_value_mappings(site_mappings(spark, sf_dir), f"{root}/maps")
    res = P.conform_files(spark, [f"{root}/site_even", f"{root}/site_odd"], RUN_SPEC, f"{root}/colmap",
                          f"{root}/maps", member_id=None)
    if res.status != P.SUCCESS:
        raise RuntimeError(f"conform ended with {res.status}")
    return res.dataset.select("event_id", "event_type", "user_id", "day", "value")


@register("i3_status", """SELECT * FROM (VALUES
  ('approval', 'approval_needed', 'request_approval'),
  ('bad_column_mapping', 'column_mapping_invalid', 'report_failure'),
  ('bad_shape', 'shape_invalid', 'report_failure'),
  ('bad_value_mapping', 'value_mapping_invalid', 'report_failure'),
  ('empty', 'no_data', 'nothing_to_do'),
  ('ok', 'success', 'upload')) AS t(scenario, status, route)""")
def i3_status(spark, sf_dir):
    """I3 (+A3): the outcome of each kind of run over the events."""
    ev = site_events(spark, sf_dir)
    maps = site_mappings(spark, sf_dir)
    cm = colmap_frame(spark, SITE_COLMAP)
    bad_cm = colmap_frame(spark, {**SITE_COLMAP, "Amount": "NoSuchField"})
    bad_maps = maps.withColumn("approved", F.lit("Perhaps"))
    runs = {
        "ok": P.conform({"s": ev}, RUN_SPEC, cm, maps, None),
        "approval": P.conform({"s": ev}, RUN_SPEC, cm, None, None),
        "empty": P.conform({"s": ev.where(F.col("Day") == "never")}, RUN_SPEC, cm, maps, None),
        "bad_column_mapping": P.conform({"s": ev}, RUN_SPEC, bad_cm, maps, None),
        "bad_value_mapping": P.conform({"s": ev}, RUN_SPEC, cm, bad_maps, None),
        "bad_shape": P.conform({"s": ev.withColumn("Extra", F.lit("x"))}, RUN_SPEC, cm, maps, None),
    }
    rows_ = [(k, r.status, P.route(r)) for k, r in runs.items()]
    return spark.createDataFrame(rows_, "scenario string, status string, route string")
