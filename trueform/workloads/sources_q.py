"""Source and sink workloads."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from trueform.operators import shape as S
from trueform.session import scratch_path
from trueform.sources import files, records, sheets
from trueform.sources import mappings_io as MIO
from trueform.workloads.conform_q import I4_SQL, run_events
from trueform.workloads.mapping_q import CUSTOMER_SPEC, SOURCE_MAP_SQL, source_mappings
from trueform.workloads.registry import register, table


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("a1_csv_roundtrip", """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey,
  CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 5 = 1 THEN NULL ELSE n_name END AS n_name,
  CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""")
def a1_csv_roundtrip(spark, sf_dir):
    """A1 + A9: write delimited text, read it back as text; NA tokens -> null."""
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("n_nationkey"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit("N/A")).when(F.col("n_nationkey") % 5 == 1, F.lit("null"))
        .otherwise(F.col("n_name")).alias("n_name"),
        F.col("n_regionkey").cast("string").alias("n_regionkey"))
    path = _scratch(spark, "a1")
    files.write_delimited(n, path)
    return files.read_delimited(spark, path)


@register("a9_sink", I4_SQL.replace("SELECT event_id, et AS event_type, uid AS user_id, dday AS day, val AS value",
                                    "SELECT event_id, et AS event_type, CAST(uid AS VARCHAR) AS user_id, "
                                    "CAST(dday AS VARCHAR) AS day, CAST(val AS VARCHAR) AS value"))
def a9_sink(spark, sf_dir):
    """The conformed table written as delimited text and read back."""
    path = _scratch(spark, "a9")
    files.write_delimited(run_events(spark, sf_dir).conformed, path)
    return files.read_delimited(spark, path)


@register("a4_promote_header", """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name,
  CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS n_regionkey FROM nation""")
def a4_promote_header(spark, sf_dir):
    """A4: the first cell row names the columns; ragged rows padded with null."""
    n = table(spark, sf_dir, "nation")
    body = n.select((F.col("n_nationkey") + 1).alias("row_no"), F.when(
        F.col("n_nationkey") % 7 == 0, F.array(F.col("n_nationkey").cast("string"), "n_name"))
        .otherwise(F.array(F.col("n_nationkey").cast("string"), "n_name", F.col("n_regionkey").cast("string")))
        .alias("cells"))
    header = spark.createDataFrame([(0, [" n_nationkey", "n_name ", "n_regionkey"])], "row_no bigint, cells array<string>")
    return sheets.promote_header(header.unionByName(body))


@register("a5_flatten_record", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS "props.k",
  event_type AS "meta.kind" FROM events""")
def a5_flatten_record(spark, sf_dir):
    """A5: nested records -> flat ``a.b`` columns; ``attributes`` members dropped."""
    e = table(spark, sf_dir, "events")
    nested = records.parse_json(e, "props", "k bigint").select(
        "event_id", "props",
        F.struct(F.col("event_type").alias("kind"),
                 F.struct(F.lit("Event").alias("type")).alias("attributes")).alias("meta"),
        F.struct(F.lit("Event").alias("type")).alias("attributes"))
    return records.flatten(nested)


_WINDOW = (dt.datetime(2024, 1, 3, 0, 0, 0), dt.datetime(2024, 1, 4, 23, 59, 59))


@register("a6_param_extract", """SELECT event_id, user_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-04 23:59:59'""")
def a6_param_extract(spark, sf_dir):
    """The run window bound as query parameters."""
    q = ("SELECT event_id, user_id FROM {events} "
         "WHERE ts BETWEEN CAST(:start_datetime AS TIMESTAMP_NTZ) AND CAST(:end_datetime AS TIMESTAMP_NTZ)")
    return records.param_extract(spark, q, *_WINDOW, events=table(spark, sf_dir, "events"))


@register("a7_multi_extract", """SELECT 'clicks' AS source, event_id FROM events
WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-04 23:59:59'
UNION ALL SELECT 'views', event_id FROM events
WHERE event_type = 'view' AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-04 23:59:59'""")
def a7_multi_extract(spark, sf_dir):
    """Several extraction queries; empty results are not datasets."""
    base = ("SELECT event_id FROM {events} WHERE event_type = '%s' AND ts BETWEEN "
            "CAST(:start_datetime AS TIMESTAMP_NTZ) AND CAST(:end_datetime AS TIMESTAMP_NTZ)")
    qs = {"clicks": base % "click", "nothing": base % "no-such-type", "views": base % "view"}
    got = records.multi_extract(spark, qs, *_WINDOW, events=table(spark, sf_dir, "events"))
    return S.union_by_name([df.select(F.lit(name).alias("source"), "event_id") for name, df in got.items()])


@register("a10_mapping_load", f"""SELECT field, input, coalesce(output, '') AS output, approved
FROM ({SOURCE_MAP_SQL}) s""")
def a10_mapping_load(spark, sf_dir):
    """A12 then A10: write one folder per field (null output -> ''), load back in one read."""
    path = _scratch(spark, "a10")
    MIO.write_value_mappings(source_mappings(spark, sf_dir), path)
    return MIO.load_value_mappings(spark, path, CUSTOMER_SPEC).select(
        "field", "input", F.coalesce("output", F.lit("")).alias("output"), "approved")


@register("a13_review_sheet", f"""SELECT field, input, output, approved,
  'AUTOMOBILE|BUILDING|FURNITURE|HOUSEHOLD|MACHINERY' AS allowed_outputs, 'Yes|No' AS allowed_approvals
FROM ({SOURCE_MAP_SQL}) s""")
def a13_review_sheet(spark, sf_dir):
    """Mapping rows with the allowed outputs and approvals of their field."""
    r = MIO.review_table(source_mappings(spark, sf_dir), CUSTOMER_SPEC)
    return r.select("field", "input", "output", "approved", F.array_join("allowed_outputs", "|").alias("allowed_outputs"),
                    F.array_join("allowed_approvals", "|").alias("allowed_approvals"))


@register("a15_org_lookup", """SELECT 'NATION_7' AS name, CAST(min(n_nationkey) AS VARCHAR) AS id,
  CAST(count(*) AS BIGINT) AS n_rows FROM nation WHERE n_name = 'NATION_7'""")
def a15_org_lookup(spark, sf_dir):
    """Id of the first organisation with a given name (nation as the organisation list)."""
    orgs = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"),
                                                 F.col("n_nationkey").cast("string").alias("id"),
                                                 F.col("n_nationkey").alias("position"))
    oid = MIO.org_id(orgs, "NATION_7")
    return orgs.where(F.col("name") == "NATION_7").agg(
        F.lit("NATION_7").alias("name"), F.lit(oid).alias("id"), F.count(F.lit(1)).cast("bigint").alias("n_rows"))


_SEG_IDX = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 "
            "WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END")
SHEET_ROWS_SQL = f"""SELECT DISTINCT 'segment' AS sheet, 1 + {_SEG_IDX} * 100 + c_nationkey AS row_no,
    concat(lower(c_mktsegment), '_', CAST(c_nationkey AS STRING)) AS input, c_mktsegment AS output,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS approved FROM customer
  UNION ALL
  SELECT DISTINCT 'active', 1 + c_nationkey, concat('act', CAST(c_nationkey AS STRING)),
    CASE WHEN c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END, 'No' FROM customer
  UNION ALL
  SELECT DISTINCT 'unknown', 1 + c_nationkey, CAST(c_nationkey AS STRING), 'x', 'No' FROM customer"""


@register("a11_sheet_load", f"""SELECT sheet AS field, input, output, approved FROM ({SHEET_ROWS_SQL}) s
WHERE sheet IN ('segment', 'active')""")
def a11_sheet_load(spark, sf_dir):
    """A workbook of per-field sheets (header row + cell rows) -> long mapping frame;
    sheets not named after a spec field are ignored."""
    rows = spark.sql(SHEET_ROWS_SQL.replace("FROM customer", "FROM {customer}"),
                     customer=table(spark, sf_dir, "customer"))
    body = rows.select("sheet", F.col("row_no").cast("bigint").alias("row_no"),
                       F.array("input", "output", "approved").alias("cells"))
    heads = rows.select("sheet").distinct().select(
        "sheet", F.lit(0).cast("bigint").alias("row_no"),
        F.array(F.lit("Input "), F.lit(" Output"), F.lit("Approved")).alias("cells"))
    return MIO.load_sheet_mappings(heads.unionByName(body), CUSTOMER_SPEC)


C9_HEADER_SQL = """SELECT n_name AS dataset, 'expect_table_columns_to_match_ordered_list' AS expectation,
  CASE n_nationkey % 3 WHEN 1 THEN 'Inputs' END AS failed_value, 'Input,Output,Approved' AS expected
FROM nation WHERE n_nationkey % 3 > 0"""


@register("c9_header", C9_HEADER_SQL)
def c9_header(spark, sf_dir):
    """C9, first step: mapping files, one a nation, some with a wrong or short header."""
    root = scratch_path(spark, f"c9-{uuid.uuid4().hex[:12]}")
    n = table(spark, sf_dir, "nation").withColumn("field", F.col("n_name"))
    for kind, names in enumerate((("Input", "Output", "Approved"), ("Inputs", "Output", "Approved"), ("Input", "Output"))):
        cells = [c.alias(x) for c, x in zip((F.lower("n_name"), F.col("n_name"), F.lit("Yes")), names)]
        (n.where(F.col("n_nationkey") % 3 == kind).select("field", *cells).write.mode("append")
         .partitionBy("field").option("header", True).csv(root))
    fails = MIO.header_problems(spark, root)
    return fails.select("dataset", "expectation", "failed_value", F.array_join("expected_list", ",").alias("expected"))
