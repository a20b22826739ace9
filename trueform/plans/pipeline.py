"""Gated conform run.

spec check -> column-mapping check (C8) -> value-mapping check (C9) -> shape
check (C11) -> shape + union (D10, D8) -> suggestions (E7) -> resolve (E9) ->
approval gate (C10) -> process (I4) -> lists to text (D9) -> summary (H1).

Each gate is a small job over configuration-sized frames or a cheap emptiness
probe; a failed gate returns early with its own status and failure frame. The
shaped union is materialised once, because the suggestion job and the process
job both read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueform.operators import expectations as X
from trueform.operators import mapping as M
from trueform.operators import shape as S
from trueform.operators.process import ProcessResult, StoredResult, process
from trueform.plans.spec import TableSpec
from trueform.session import materialize as _materialize
from trueform.sources import files
from trueform.sources.mappings_io import column_mapping_dict, header_problems, load_column_mapping, load_value_mappings

# Run outcomes.
SUCCESS = "success"
NO_DATA = "no_data"
SPEC_INVALID = "spec_invalid"
COLMAP_INVALID = "column_mapping_invalid"
VALMAP_INVALID = "value_mapping_invalid"
SHAPE_INVALID = "shape_invalid"
APPROVAL_NEEDED = "approval_needed"


@dataclass
class ConformResult:
    status: str
    dataset: DataFrame | None = None
    field_mappings: DataFrame | None = None
    failures: DataFrame | None = None
    processed: ProcessResult | StoredResult | None = None
    details: dict = dc_field(default_factory=dict)
    held: list[DataFrame] = dc_field(default_factory=list)

    def release(self) -> None:
        """Frees the frames that the run held; call it when the result's frames have been used."""
        for df in self.held:
            df.unpersist()
        if isinstance(self.processed, ProcessResult):
            self.processed.unpersist()

    @property
    def summary(self) -> DataFrame | None:
        return self.processed.summary() if self.processed else None

    @property
    def dropped(self) -> DataFrame | None:
        return self.processed.dropped if self.processed else None

    @property
    def invalid(self) -> DataFrame | None:
        return self.processed.invalid if self.processed else None


def conform(datasets: Mapping[str, DataFrame], spec: TableSpec, column_mapping: DataFrame | Mapping,
            source_mappings: DataFrame | None, member_id: str | None, *, row_format: bool = True,
            delimiter: str = ";", overwrite: bool = False, materialize: str | None = "persist",
            dictionary: str | None = None, mapping_headers: DataFrame | None = None,
            stored: bool = False) -> ConformResult:
    """The gated run; see the module docstring for the order of gates. ``mapping_headers``:
    header failures of the mapping files, checked before their rows. ``stored``: conformed,
    dropped and invalid rows are written in one pass and read from there. ``dictionary``: a table
    that keeps suggestions between runs, so that a rerun scores only new spellings."""
    problems = spec.check()
    if problems:
        spark = next(iter(datasets.values())).sparkSession if datasets else SparkSession.getActiveSession()
        return ConformResult(SPEC_INVALID, failures=spec.check_frame(spark))
    if files.is_empty_input(dict(datasets)):  # A3
        return ConformResult(NO_DATA)
    spark = next(iter(datasets.values())).sparkSession
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(_materialize(df, materialize))
        return held[-1]

    if isinstance(column_mapping, DataFrame):
        fails = X.check_column_mapping(column_mapping, spec, row_format)
        if not fails.isEmpty():
            return ConformResult(COLMAP_INVALID, failures=fails)
        colmap = column_mapping_dict(column_mapping)
    else:
        colmap = dict(column_mapping)

    if mapping_headers is not None and not mapping_headers.isEmpty():
        return ConformResult(VALMAP_INVALID, failures=mapping_headers)
    if source_mappings is not None:
        # read by the check and by the resolve step: materialise once
        source_mappings = hold(source_mappings)
        fails = X.check_value_mappings(source_mappings, spec)
        if not fails.isEmpty():
            return ConformResult(VALMAP_INVALID, failures=fails, held=held)

    shape_problems = X.shape_problems(dict(datasets), spec, colmap, row_format)  # plan time, no job
    if shape_problems:
        return ConformResult(SHAPE_INVALID, failures=X.failure_frame(spark, shape_problems), held=held)

    shaped = [S.shape(df, spec, colmap, member_id, row_format, delimiter) for df in datasets.values()]
    combined = S.union_by_name(shaped)
    combined = combined.select(*[
        F.coalesce(S.col(c), F.lit("")).alias(c) if t == "string" else S.col(c) for c, t in combined.dtypes])
    combined = hold(combined)

    # suggestions come from distinct (field, raw) pairs, one best option each, so
    # they cannot conflict; the E6 guard is for mappings assembled elsewhere
    if source_mappings is None:
        source_mappings = spark.createDataFrame([], M.MAPPING_SCHEMA)
    # an approved mapping wins over a suggestion unless overwritten, so its input needs none
    decided = None if overwrite else M.approved_only(source_mappings)
    generated = M.generate(combined, spec, decided=decided, dictionary=dictionary)
    resolved = M.resolve(generated, source_mappings, overwrite=overwrite, remove_unapproved_source=True)
    resolved = hold(resolved)
    if not X.check_approvals(resolved).isEmpty():  # C10
        return ConformResult(APPROVAL_NEEDED, field_mappings=resolved, held=held)

    result = process(combined, spec, resolved, materialize=materialize)
    if stored:
        result = result.store()
    out = S.arrays_to_text(result.conformed, spec)
    return ConformResult(SUCCESS, dataset=out, field_mappings=resolved, processed=result, held=held)


def conform_files(spark: SparkSession, paths, spec: TableSpec, column_mapping_path: str,
                  value_mapping_folder: str | None, member_id: str | None, *, multi_line: bool | None = None,
                  **kw) -> ConformResult:
    """Load every input from paths (A1, A14, A10), then :func:`conform`. Files whose cells hold
    line breaks are read whole, all others are split, unless ``multi_line`` settles it for all.
    A mapping file with a wrong header ends the run before its rows are used (C9)."""
    datasets = files.read_datasets(spark, paths, multi_line=multi_line)
    colmap = load_column_mapping(spark, column_mapping_path)
    maps = None
    if value_mapping_folder:
        maps = load_value_mappings(spark, value_mapping_folder, spec)
        kw["mapping_headers"] = header_problems(spark, value_mapping_folder, spec)
    return conform(datasets, spec, colmap, maps, member_id, **kw)


def route(result: ConformResult) -> str:
    """Which follow-up a run needs."""
    if result.status == SUCCESS:
        return "upload"
    if result.status == NO_DATA:
        return "nothing_to_do"
    if result.status == APPROVAL_NEEDED:
        return "request_approval"
    return "report_failure"
