"""Data-quality expectations (C1-C11) and the failure table.

Failures are a *long* DataFrame, one row per failed value:
``(dataset, expectation, column_name, failed_value, expected_list)``.
Name checks (C1-C3) are plan-time on ``df.columns``; value checks (C4, C5)
are aggregations/filters that never gather a value list into one row.
"""

from __future__ import annotations

import itertools
import re
from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueform.operators.mapping import VALID_APPROVED_VALUES
from trueform.plans.spec import TableSpec

# Expectation names of the failure table.
COLUMNS_IN_SET = "expect_table_columns_to_be_in_set"
NAMED_COLUMNS = "expect_named_cols"
COLUMNS_MATCH = "expect_table_columns_to_match_ordered_list"
VALUES_IN_SET = "expect_column_values_to_be_in_set"
VALUES_UNIQUE = "expect_column_values_to_be_unique"

COLUMN_MAPPING_COLUMNS = ("Internal Column Name", "Mission Impact Field Name")
VALUE_MAPPING_COLUMNS = ("Input", "Output", "Approved")

FAILURE_SCHEMA = ("dataset string, expectation string, column_name string, failed_value string, "
                  "expected_list array<string>")

_UNNAMED = re.compile(r"^(?:_c(\d+)|Unnamed: ?(\d+))$")


def failure_frame(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    rows = [(r.get("dataset"), r["expectation"], r.get("column_name"), r.get("failed_value"),
             r.get("expected_list")) for r in records]
    return spark.createDataFrame(rows, FAILURE_SCHEMA)


# -- C1-C3: names (plan time) ------------------------------------------------------------

def columns_in_set(columns: Sequence[str], allowed: Iterable[str], dataset: str | None = None) -> list[dict]:
    """Named columns must be allowed; offenders sorted."""
    allowed = set(allowed)
    named = [c for c in columns if not _UNNAMED.match(c)]
    bad = sorted(set(named) - allowed)
    return [{"dataset": dataset, "expectation": COLUMNS_IN_SET, "failed_value": b} for b in bad]


def named_columns(columns: Sequence[str], dataset: str | None = None) -> list[dict]:
    """Positions (0-based) of columns without a header."""
    out = []
    for c in columns:
        m = _UNNAMED.match(c)
        if m:
            out.append({"dataset": dataset, "expectation": NAMED_COLUMNS,
                        "failed_value": m.group(1) or m.group(2)})
    return out


def columns_match(columns: Sequence[str], expected: Sequence[str], dataset: str | None = None) -> list[dict]:
    """Columns equal an ordered list; failure lists the found names (null if missing)."""
    out = []
    for found, want in itertools.zip_longest(columns, expected):
        if found != want:
            out.append({"dataset": dataset, "expectation": COLUMNS_MATCH, "failed_value": found,
                        "expected_list": list(expected)})
    return out


# -- C4, C5: values ------------------------------------------------------------------------------

def values_unique(df: DataFrame, column: str, dataset: str | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """C4: distinct values occurring more than once (nulls ignored); ``by`` scopes it."""
    keys = [F.col(b) for b in by] + [F.col(column)]
    d = (df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
         .where(F.col("__n") > 1))
    ds = F.col(by[0]) if (dataset is None and by) else F.lit(dataset)
    return d.select(ds.cast("string").alias("dataset"), F.lit(VALUES_UNIQUE).alias("expectation"),
                    F.lit(column).alias("column_name"), F.col(column).cast("string").alias("failed_value"),
                    F.lit(None).cast("array<string>").alias("expected_list"))


def values_in_set(df: DataFrame, column: str, allowed: Iterable[str | None], dataset: str | None = None,
                  by: str | None = None, allowed_by: Mapping[str, Iterable] | None = None) -> DataFrame:
    """Every non-null value outside the set, with repeats.

    With ``allowed_by`` the set depends on the ``by`` column (one set per field).
    """
    c = F.col(column)
    if allowed_by is not None:
        pairs = [(k, v) for k, vs in allowed_by.items() for v in vs if v is not None]
        allowed_df = df.sparkSession.createDataFrame(pairs, "__k string, __v string")
        bad = df.where(c.isNotNull()).join(F.broadcast(allowed_df),
                                           (F.col(by) == F.col("__k")) & (c == F.col("__v")), "left_anti")
    else:
        vals = [v for v in allowed if v is not None]
        bad = df.where(c.isNotNull() & ~c.isin(*vals))
    ds = F.col(by) if (dataset is None and by) else F.lit(dataset)
    return bad.select(ds.cast("string").alias("dataset"), F.lit(VALUES_IN_SET).alias("expectation"),
                      F.lit(column).alias("column_name"), c.cast("string").alias("failed_value"),
                      F.lit(None).cast("array<string>").alias("expected_list"))


# -- C8-C11: composites --------------------------------------------------------------------------------

def check_column_mapping(colmap: DataFrame, spec: TableSpec, row_format: bool = True) -> DataFrame:
    """C3 on the header; stop if it fails; else C4 on source and C5 on target."""
    spark = colmap.sparkSession
    shape = columns_match(colmap.columns, COLUMN_MAPPING_COLUMNS)
    if shape:
        return failure_frame(spark, shape)
    src, tgt = COLUMN_MAPPING_COLUMNS
    return values_unique(colmap, src).unionByName(values_in_set(colmap, tgt, spec.valid_names(row_format)))


def check_value_mappings(mappings: DataFrame, spec: TableSpec) -> DataFrame:
    """C9 on the long mapping frame: unique inputs, outputs among options (or blank),
    approval among Yes/No/None; the dataset column carries the field name."""
    names = [f.name for f in spec.fields if f.is_mappable]
    opts = {n: list(spec.field(n).options) + [""] for n in names}
    m = mappings.where(F.col("field").isin(*names)) if names else mappings.limit(0)
    return (values_unique(m, "input", by=["field"])
            .unionByName(values_in_set(m, "output", [], by="field", allowed_by=opts))
            .unionByName(values_in_set(m, "approved", list(VALID_APPROVED_VALUES) + ["None"], by="field")))


def check_approvals(mappings: DataFrame) -> DataFrame:
    """Every mapping row approved 'Yes' (nulls ignored), per field."""
    return values_in_set(mappings, "approved", ["Yes"], by="field")


def shape_problems(datasets: Mapping[str, DataFrame], spec: TableSpec,
                   column_mapping: Mapping[str, str | None], row_format: bool = True) -> list[dict]:
    """C11 (+C7) at plan time: C1 against mapped and spec names, and C2, per dataset."""
    allowed = list(column_mapping.keys()) + spec.valid_names(row_format)
    recs: list[dict] = []
    for name, df in datasets.items():
        recs += columns_in_set(df.columns, allowed, name)
        recs += named_columns(df.columns, name)
    return recs


def check_shape(datasets: Mapping[str, DataFrame], spec: TableSpec,
                column_mapping: Mapping[str, str | None], row_format: bool = True) -> DataFrame:
    """C11 (+C7) as a failure frame."""
    if not datasets:
        raise ValueError("no datasets")
    spark = next(iter(datasets.values())).sparkSession
    return failure_frame(spark, shape_problems(datasets, spec, column_mapping, row_format))
