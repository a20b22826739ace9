"""Reports (H1-H6) as DataFrames of facts and one explanation line per record.

Lines are built per row (no value lists gathered into one row), so report
size follows the number of dropped rows / invalid values, in parallel.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trueform.operators import expectations as X
from trueform.operators.mapping import APPROVED

# Explanation texts.
DUPLICATE_TEXT = ("Dropped because the uploaded data has duplicate instances of this record. Duplicate "
                  "records have the same MileStoneFlag, CaseNumber, and MemberOrganization.")
MISSING_INTAKE_TEXT = ("Dropped because the row does not have a corresponding 'Intake' record in the "
                       "registry")


def _py(c: Column) -> Column:
    """Text as Python's ``format`` prints it (None for null)."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def dropped_explanations(dropped: DataFrame, case_field: str = "CaseNumber",
                         flag_field: str = "MilestoneFlag", fields: Iterable[str] | None = None) -> DataFrame:
    """H2: one line per dropped row."""
    cols = dropped.columns
    case = F.col(case_field) if case_field in cols else F.lit(None)
    flag = F.col(flag_field) if flag_field in cols else F.lit(None)
    names = [f for f in (fields or cols) if f in cols and f not in ("drop_kind", "missing_fields")]
    row = F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"`{n}`").cast("string"))]) \
        if names else F.create_map().cast("map<string,string>")
    missing = F.col("missing_fields") if "missing_fields" in cols else F.array().cast("array<string>")
    reasons = F.transform(missing, lambda f: F.when(
        F.coalesce(F.try_element_at(row, f), F.lit("")) != F.lit(""),
        F.concat(f, F.lit(" (Invalid value: "), F.try_element_at(row, f), F.lit(")"))
    ).otherwise(F.concat(f, F.lit(" (missing)"))))
    why = (F.when(F.col("drop_kind") == "missing_intake_record", F.lit(MISSING_INTAKE_TEXT))
           .when(F.col("drop_kind") == "duplicate", F.lit(DUPLICATE_TEXT))
           .otherwise(F.concat(F.lit("Dropped because of "), F.array_join(reasons, ", "))))
    head = F.concat(F.lit("(CaseNumber: '"), _py(case), F.lit("', MilestoneFlag: '"), _py(flag), F.lit("') "))
    return dropped.select(case.cast("string").alias("case_number"), flag.cast("string").alias("milestone_flag"),
                          "drop_kind", F.concat(head, why).alias("explanation"))


def invalid_explanations(invalid: DataFrame) -> DataFrame:
    """H3: one line per invalid value."""
    text = F.concat(F.lit("(CaseNumber: '"), _py(F.col("case_number")), F.lit("', Milestone: '"),
                    _py(F.col("milestone_flag")), F.lit("') Invalid value for "), F.col("field_name"),
                    F.lit(": '"), _py(F.col("original_value")), F.lit("'. Reason: "),
                    F.coalesce(F.col("reason"), F.lit("")))
    return invalid.select("case_number", "field_name", text.alias("explanation"))


def failure_explanations(failures: DataFrame) -> DataFrame:
    """H4: one line per failed value, ordered by expectation when collected."""
    e, v, c = F.col("expectation"), _py(F.col("failed_value")), F.col("column_name")
    text = (F.when(e == X.COLUMNS_IN_SET, F.concat(F.lit("Invalid column in dataset: "), v))
            .when(e == X.NAMED_COLUMNS, F.concat(F.lit("Empty column header at position: "), v))
            .when(e == X.COLUMNS_MATCH, F.concat(F.lit("Headers are incorrect. Header row should exactly match ["),
                                                 F.array_join(F.col("expected_list"), ", "), F.lit("]")))
            .when(e == X.VALUES_IN_SET, F.concat(F.lit('Some values for "'), c, F.lit('" are invalid: '), v))
            .when(e == X.VALUES_UNIQUE, F.concat(F.lit('No duplicates allowed for "'), c,
                                                 F.lit('". This value had duplicates: '), v)))
    # a wrong header fails once for each column but is one line
    header = e == X.COLUMNS_MATCH
    once = failures.where(header).dropDuplicates(["dataset", "expectation"])
    return failures.where(~header).unionByName(once).select(
        "dataset", "expectation", "column_name", "failed_value", text.alias("explanation"))


def unapproved_lines(mappings: DataFrame) -> DataFrame:
    """H5: one line per unapproved mapping, by field (fields without any are absent)."""
    line = F.concat(F.lit("'"), _py(F.col("input")), F.lit("' -> '"), _py(F.col("output")), F.lit("'"))
    return (mappings.where(F.coalesce(F.col("approved"), F.lit("")) != APPROVED)
            .select("field", "input", line.alias("line")))


def adjust_summary(summary: DataFrame, rejected: DataFrame) -> DataFrame:
    """H6: after a key rejection, rows to upload -n and rows dropped +n."""
    moved = rejected.agg(F.count(F.lit(1)).alias("n")).select(
        (-F.col("n")).alias("rows_to_upload"), F.col("n").alias("rows_dropped"), F.lit(0).cast("bigint").alias("values_dropped"))
    names = ("rows_to_upload", "rows_dropped", "values_dropped")
    return summary.select(*names).unionByName(moved).agg(*[F.sum(c).cast("bigint").alias(c) for c in names])
