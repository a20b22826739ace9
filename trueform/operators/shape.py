"""Projection and reshaping.

Everything is a single projection chain (Catalyst collapses it), except the
union of datasets. Wide -> long (D3) scans the input once and explodes an
array of per-milestone structs, instead of one scan per milestone.
"""

from __future__ import annotations

import re
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueform.functions.cells import WHITESPACE
from trueform.plans.spec import TableSpec

FORCE_OVERWRITE_VALUE = "1"


def _q(name: str) -> str:
    """Backtick-quote a column name (names may contain dots)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(_q(name))


def dropped_columns(mapping: Mapping[str, str | None], columns: Iterable[str]) -> list[str]:
    """Source columns mapped to nothing (null or blank target)."""
    cols = set(columns)
    return [k for k, v in mapping.items() if k in cols and (v is None or str(v).strip() == "")]


def rename_and_drop(df: DataFrame, mapping: Mapping[str, str | None]) -> DataFrame:
    """D2 then D1: drop columns mapped to nothing, rename the rest; others untouched."""
    drop = set(dropped_columns(mapping, df.columns))
    out = []
    targets = []
    for c in df.columns:
        if c in drop:
            continue
        name = mapping.get(c, c) if c in mapping else c
        targets.append(name)
        out.append(col(c).alias(name))
    dup = sorted({t for t in targets if targets.count(t) > 1})
    if dup:
        raise ValueError(f"columns mapped to the same target in one dataset: {dup}")
    return df.select(*out)


def to_text(c: Column) -> Column:
    """Everything to text, null -> ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_text(c: Column) -> Column:
    """Strip surrounding whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def split_values(c: Column, delimiter: str) -> Column:
    """Delimited text -> array of stripped parts; blank -> ['']."""
    parts = F.split(c, re.escape(delimiter))
    strip_ = lambda x: F.when((x < "!") | (F.substring(x, -1, 1) < "!"), F.btrim(x, F.lit(WHITESPACE))).otherwise(x)
    edge, sep = r"[ \t\n\r\f\x0B]", f"(?:{re.escape(delimiter)})"  # whitespace beside a delimiter or at an end
    return (F.when(c.rlike(rf"{sep}{edge}|{edge}{sep}|^{edge}|{edge}\z"), F.transform(parts, strip_))
            .otherwise(parts))


def _any_not_null(names: list[str]) -> Column:
    out = col(names[0]).isNotNull()
    for n in names[1:]:
        out = out | col(n).isNotNull()
    return out


def wide_to_long(df: DataFrame, spec: TableSpec, empty_rows: str = "keep",
                 flag_field: str = "MilestoneFlag") -> DataFrame:
    """D3: one row per (input row, milestone with any data).

    A milestone is skipped when none of its columns holds data in any row
    (``empty_rows="keep"``, the reference behaviour); ``"drop"`` also removes
    the individual rows that are empty for a milestone. Missing columns read
    as null. Which milestones are live is a scalar subquery of the plan: no job
    runs while it is built, and the columns follow from the spec and the header.
    ``"drop"`` needs no such pass.
    """
    by_milestone, admin = spec.column_format_fields()
    cols = set(df.columns)
    admin_present = [a for a in admin if a in cols]
    present = {m: {w: f for w, f in fields.items() if w in cols} for m, fields in by_milestone.items()}
    present = {m: f for m, f in present.items() if f}
    if not present:
        return df.sparkSession.createDataFrame([], T.StructType([]))
    out_fields = sorted({f for fields in present.values() for f in fields.values()})
    structs = []
    for i, (m, fields) in enumerate(present.items(), 1):
        inv = {f: w for w, f in fields.items()}
        members = [F.lit(m).alias(flag_field)]
        for f in out_fields:
            members.append((col(inv[f]).cast("string") if f in inv else F.lit(None).cast("string")).alias(f))
        members += [_any_not_null(list(fields)).alias("__any"), F.lit(i).alias("__at")]
        structs.append(F.struct(*members))
    exploded = df.select(*[col(a) for a in admin_present], F.explode(F.array(*structs)).alias("__m"))
    if empty_rows == "drop":
        exploded = exploded.where(F.col("__m.__any"))
    else:
        live = df.select(F.array(*[F.bool_or(_any_not_null(list(f))) for f in present.values()]).alias("live")).scalar()
        exploded = exploded.where(F.element_at(live, F.col("__m.__at")))
    sel = [col(a) for a in admin_present if a != flag_field]
    sel += [F.col("__m." + _q(flag_field)).alias(flag_field)]
    sel += [F.col("__m." + _q(f)).alias(f) for f in out_fields if f != flag_field]
    return exploded.select(*sel)


def set_constants(df: DataFrame, member_id: str | None,
                  force_overwrite: str | None = FORCE_OVERWRITE_VALUE) -> DataFrame:
    """MemberOrganization = member id, ForceOverWrite = '1' (overwrites)."""
    consts = {}
    if member_id is not None:
        consts["MemberOrganization"] = F.lit(member_id)
    if force_overwrite is not None:
        consts["ForceOverWrite"] = F.lit(force_overwrite)
    return df.withColumns(consts) if consts else df


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of datasets by column name, missing columns null, columns sorted."""
    frames = list(frames)
    if not frames:
        raise ValueError("no datasets")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[col(c) for c in sorted(out.columns)])


def join_values(c: Column, sep: str = ",") -> Column:
    """Array -> delimited text; null stays null."""
    return F.array_join(c.cast("array<string>"), sep)


def arrays_to_text(df: DataFrame, spec: TableSpec, sep: str = ",") -> DataFrame:
    """D9 over every multi-value spec column."""
    out = []
    for name, dtype in df.dtypes:
        if spec.has(name) and spec.field(name).allows_multiple and dtype.startswith("array"):
            out.append(join_values(col(name), sep).alias(name))
        else:
            out.append(col(name))
    return df.select(*out)


def shape(df: DataFrame, spec: TableSpec, column_mapping: Mapping[str, str | None],
          member_id: str | None, row_format: bool = True, delimiter: str = ";",
          empty_rows: str = "keep") -> DataFrame:
    """D2 -> D1 -> (D3) -> D4 -> D5 -> D6 -> D7 as one projection chain."""
    out = rename_and_drop(df, column_mapping)
    if not row_format:
        out = wide_to_long(out, spec, empty_rows=empty_rows)
    multi = {f.name for f in spec.fields if f.allows_multiple}
    sel = []
    for c in out.columns:
        text = strip_text(to_text(col(c)))
        sel.append((split_values(text, delimiter) if c in multi else text).alias(c))
    out = out.select(*sel)
    return set_constants(out, member_id)
