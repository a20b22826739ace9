"""Row filters, keep-none dedupe and key anti-joins."""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trueform.functions.dates import day_bounds

# Response texts of the upload gateway.
INTAKE_MESSAGE = "No 'Intake' records found"
CASE_KEY_PATTERN = r"Case:\s+(.*?)\s+Member:"


def _null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lk, rk in pairs:
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once.

    Aggregates only the key columns; the partial (map-side) aggregation folds a
    hot key into one row per task before the shuffle, so skew does not reach
    the reducers.
    """
    return (df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > 1).drop("__n"))


def flag_duplicates(df: DataFrame, keys: Sequence[str], flag: str = "__dup",
                    eligible: Column | None = None) -> DataFrame:
    """G3 core: add boolean ``flag`` = the row's key occurs more than once.

    ``eligible`` restricts which rows count (and can be flagged); the others,
    often null in the key, go round the join. The join carries no hint: AQE
    broadcasts a small duplicate-key set by its bytes, else splits hot keys.
    """
    src = df if eligible is None else df.where(F.coalesce(eligible, F.lit(False)))
    renamed = [f"__dk{i}" for i in range(len(keys))]
    dups = duplicate_keys(src, keys)
    dups = dups.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).withColumn(flag, F.lit(True))
    out = src.join(dups, _null_safe_on(src, dups, list(zip(keys, renamed))), "left").drop(*renamed)
    out = out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    if eligible is None:
        return out
    rest = df.where(~F.coalesce(eligible, F.lit(False))).withColumn(flag, F.lit(False))
    return out.unionByName(rest)


def keep_none_dedupe(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Drop every copy of a duplicated key; returns (kept, dropped)."""
    flagged = flag_duplicates(df, keys)
    kept = flagged.where(~F.col("__dup")).drop("__dup")
    dropped = flagged.where(F.col("__dup")).drop("__dup").withColumn("drop_kind", F.lit("duplicate"))
    return kept, dropped


def missing_required(values: dict[str, Column], required: Iterable[str]) -> Column:
    """G1: array of required field names whose conformed value is null, in spec order."""
    names = list(required)
    if not names:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(values[n].isNull(), F.lit(n)) for n in names]),
                    lambda x: x.isNotNull())


# -- G5, G6, G10: gateway responses ---------------------------------------------------

def extract_keys(responses: DataFrame, text_col: str = "text", key_col: str = "CaseNumber") -> DataFrame:
    """Every ``Case: <id>  Member:`` token of the response texts, distinct."""
    return (responses
            .select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(CASE_KEY_PATTERN), 1)).alias(key_col))
            .distinct())


def reject_by_keys(df: DataFrame, keys: DataFrame, key_col: str = "CaseNumber") -> tuple[DataFrame, DataFrame]:
    """kept = key not listed, dropped = key listed (every milestone of the case).

    Both frames read ``keys``; a caller that runs both materialises it first.
    """
    side = keys.select(F.col(key_col).alias("__rk")).distinct()
    cond = df[key_col] == side["__rk"]
    kept = df.join(side, cond, "left_anti")
    dropped = df.join(side, cond, "left_semi").withColumn("drop_kind", F.lit("missing_intake_record"))
    return kept, dropped


def classify_responses(responses: DataFrame, text_col: str = "text", status_col: str = "status") -> DataFrame:
    """``retry`` after a key rejection / ``error`` / ``accepted``."""
    return responses.withColumn(
        "outcome",
        F.when(F.col(text_col).contains(INTAKE_MESSAGE), F.lit("retry"))
        .when(F.col(status_col) != F.lit(202), F.lit("error"))
        .otherwise(F.lit("accepted")),
    )


# -- G7-G9: run windows -----------------------------------------------------------------

LAST_MODIFIED = "LastModifiedDate"


def time_range_filter(df: DataFrame, start: _dt.date, end: _dt.date, col: str = LAST_MODIFIED,
                      drop: bool = True) -> DataFrame:
    """Inclusive [start 00:00:00, end 23:59:59] filter; absent column -> unchanged.

    On a parquet source the comparison is pushed to the scan.
    """
    if col not in df.columns:
        return df
    lo, hi = day_bounds(start, end)
    ts = F.col(col).cast("timestamp_ntz")
    out = df.where(ts.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
    return out.drop(col) if drop else out


def incremental_windows(members: DataFrame, watermarks: DataFrame, start_date: _dt.date,
                        run_date: _dt.date, member_col: str = "member_id",
                        last_col: str = "last_success_date") -> DataFrame:
    """Per member, window from (last success + 1 day) to the run date.

    A member without a watermark starts at ``start_date``; of repeated ones the latest counts.
    """
    w = (watermarks.groupBy(F.col(member_col).alias("__m"))
         .agg(F.max(F.col(last_col).cast("date")).alias("__last")))
    j = members.join(w, members[member_col] == w["__m"], "left")
    first = F.coalesce(F.col("__last"), F.date_sub(F.lit(start_date), 1))
    return j.select(
        *[members[c] for c in members.columns],
        F.date_add(first, 1).alias("window_start"),
        F.lit(run_date).alias("window_end"),
    )


def run_window_scan(df: DataFrame, windows: DataFrame, ts_col: str, member_col: str, *,
                    earliest: _dt.date | None = None, latest: _dt.date | None = None,
                    window_member: str = "member_id") -> DataFrame:
    """Rows of ``df`` inside their member's run window (G9), day bounds included.

    ``earliest`` / ``latest`` bound every window; given, they reach the scan as
    literals. A member without a window has no rows.
    """
    ts = F.col(ts_col).cast("timestamp_ntz")
    if earliest is not None:
        df = df.where(ts >= F.lit(day_bounds(earliest, earliest)[0]).cast("timestamp_ntz"))
    if latest is not None:
        df = df.where(ts <= F.lit(day_bounds(latest, latest)[1]).cast("timestamp_ntz"))
    w = windows.select(F.col(window_member).alias("__wm"), F.col("window_start").cast("timestamp_ntz").alias("__lo"),
                       (F.col("window_end").cast("timestamp_ntz") + F.expr("INTERVAL 86399 SECONDS")).alias("__hi"))
    j = df.join(w, df[member_col] == w["__wm"])
    return j.where(ts.between(F.col("__lo"), F.col("__hi"))).drop("__wm", "__lo", "__hi")
