"""Mapping tables in and out (A10, A12-A14) and the organisation lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trueform.operators.expectations import COLUMN_MAPPING_COLUMNS, COLUMNS_MATCH, VALUE_MAPPING_COLUMNS
from trueform.operators.mapping import APPROVED, NOT_APPROVED, VALID_APPROVED_VALUES
from trueform.plans.spec import TableSpec
from trueform.sources.files import _reader, list_files

_FIELD_FROM_PATH = r"(?:field=([^/]+)/[^/]*|([^/]+)\.csv)$"


#: cells read of a mapping row; a header must have three, more are reported
MAPPING_CELLS = 16


def _field_of(file: Column) -> Column:
    """Field of a mapping file, from its (URL-encoded) path."""
    name = F.coalesce(F.nullif(F.regexp_extract(file, _FIELD_FROM_PATH, 1), F.lit("")), F.regexp_extract(file, _FIELD_FROM_PATH, 2))
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _mapping_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows of every CSV under ``folder``, one scan: field, file, position, cells, and the file's header.

    The field is the file name (``<field>.csv``) or the ``field=`` folder written by
    :func:`write_value_mappings`. ``position`` follows the rows of a file; inputs may
    hold line breaks, so a file is never split.
    """
    names = [f"c{i}" for i in range(MAPPING_CELLS)]
    found = list_files(spark, folder, "*.csv", recursive=True)
    if not found:
        return spark.createDataFrame([], "field string, file string, position bigint, cells array<string>, header array<string>")
    raw = (_reader(spark, multi_line=True).option("header", False).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
           .schema(", ".join(f"{n} string" for n in names)).csv(folder))
    file = F.col("_metadata.file_path")
    rows = raw.select(_field_of(file).alias("field"), file.alias("file"), F.monotonically_increasing_id().alias("position"), F.array(*names).alias("cells"))
    tops = rows.groupBy("file").agg(F.min_by("cells", "position").alias("header"), F.min("position").alias("top"))
    return rows.join(tops, "file").where(F.col("position") > F.col("top")).select("field", "file", "position", "cells", "header") \
        .unionByName(tops.select(F.lit(None).cast("string").alias("field"), "file", F.lit(None).cast("bigint").alias("position"),
                                 F.lit(None).cast("array<string>").alias("cells"), "header"))


def _of_spec(rows: DataFrame, spec: TableSpec | None) -> DataFrame:
    return rows if spec is None else rows.where(F.col("field").isin(*[f.name for f in spec.fields if f.is_mappable]))


def load_value_mappings(spark: SparkSession, folder: str, spec: TableSpec | None = None) -> DataFrame:
    """A10: one read of every CSV under ``folder`` as (field, input, output, approved, position).

    Files of unknown fields are ignored. Columns are taken by name, file by file; a
    file whose header lacks one gives its rows as nulls (:func:`header_problems` names
    such files). ``position`` is the order of a file's rows, by which the later of
    repeated inputs wins (E1).
    """
    rows = _of_spec(_mapping_cells(spark, folder).where(F.col("position").isNotNull()), spec)
    cell = lambda name: F.try_element_at("cells", F.nullif(F.array_position("header", name), F.lit(0)).cast("int"))
    i, o, a = (cell(n) for n in VALUE_MAPPING_COLUMNS)
    return rows.select("field", i.alias("input"), o.alias("output"), a.alias("approved"), "position")


def header_problems(spark: SparkSession, folder: str, spec: TableSpec | None = None) -> DataFrame:
    """C9's first step: a failure line for each place where a mapping file's header is not Input, Output, Approved.

    The dataset is the field; the failed value is the name found (null where the
    header is too short). Empty files have no header and no rows.
    """
    rows = _mapping_cells(spark, folder).where(F.col("position").isNull())
    tops = _of_spec(rows.withColumn("field", _field_of(F.col("file"))).select("field", "header"), spec).distinct()
    wanted = F.array(*[F.lit(n) for n in VALUE_MAPPING_COLUMNS])
    width = F.greatest(F.size(wanted), F.coalesce(F.array_max(F.transform("header", lambda x, i: F.when(x.isNotNull(), i + 1))), F.lit(0)))
    at = F.explode(F.sequence(F.lit(1), width)).alias("at")
    found, want = F.try_element_at("header", F.col("at")), F.try_element_at(wanted, F.col("at"))
    return (tops.select("field", "header", at).where(~found.eqNullSafe(want))
            .select(F.col("field").alias("dataset"), F.lit(COLUMNS_MATCH).alias("expectation"), F.lit(None).cast("string").alias("column_name"),
                    found.alias("failed_value"), wanted.alias("expected_list")))


def write_value_mappings(mappings: DataFrame, folder: str) -> None:
    """Overwrite; null output -> '', null approval -> 'No'; one folder per field."""
    i, o, a = VALUE_MAPPING_COLUMNS
    (mappings.select("field", F.col("input").alias(i), F.coalesce("output", F.lit("")).alias(o),
                     F.coalesce("approved", F.lit(NOT_APPROVED)).alias(a))
     .write.mode("overwrite").partitionBy("field").option("header", True).option("emptyValue", '""')
     .csv(folder))


def review_table(mappings: DataFrame, spec: TableSpec) -> DataFrame:
    """Mapping rows with the allowed outputs and approval values of their field."""
    spark = mappings.sparkSession
    opts = (spec.options_frame(spark).groupBy("field")
            .agg(F.array_sort(F.collect_list(F.struct("position", "option"))).alias("o"))
            .select("field", F.transform("o", lambda x: x["option"]).alias("allowed_outputs")))
    return (mappings.join(F.broadcast(opts), "field", "left")
            .withColumn("allowed_approvals", F.array(*[F.lit(v) for v in VALID_APPROVED_VALUES])))


def load_column_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The 2-column mapping table (checked by C8 before use)."""
    return _reader(spark, multi_line=True).csv(path)


def column_mapping_dict(colmap: DataFrame) -> dict[str, str | None]:
    """Schema-sized: collected to drive ``select``/``alias``."""
    src, tgt = COLUMN_MAPPING_COLUMNS
    return {r[0]: r[1] for r in colmap.select(src, tgt).collect()}


def org_id(orgs: DataFrame, name: str, name_col: str = "name", id_col: str = "id",
           position_col: str = "position") -> str:
    """Id of the first organisation whose name equals ``name``; error when none."""
    r = (orgs.where(F.col(name_col) == F.lit(name))
         .agg(F.min_by(F.col(id_col), F.col(position_col)).alias("id"), F.count(F.lit(1)).alias("n"))
         .collect()[0])
    if not r["n"]:
        raise LookupError(f"no organisation named {name!r}")
    return r["id"]


__all__ = ["load_value_mappings", "write_value_mappings", "review_table", "load_column_mapping",
           "column_mapping_dict", "org_id", "APPROVED"]


def load_sheet_mappings(sheets: DataFrame, spec: TableSpec, sheet_col: str = "sheet") -> DataFrame:
    """Per-field sheets of raw cell rows -> long mapping frame.

    Headers are promoted per sheet (A4), sheets not named after a mappable
    spec field are dropped, empty sheets give no rows.
    """
    from trueform.sources.sheets import promote_headers_by_sheet
    names = [f.name for f in spec.fields if f.is_mappable]
    long = promote_headers_by_sheet(sheets.where(F.col(sheet_col).isin(*names)), sheet_col=sheet_col)
    i, o, a = VALUE_MAPPING_COLUMNS
    wide = (long.groupBy(sheet_col, "row_no").pivot("column", [i, o, a]).agg(F.first("value")))
    return wide.select(F.col(sheet_col).alias("field"), F.col(i).alias("input"), F.col(o).alias("output"),
                       F.col(a).alias("approved"))
