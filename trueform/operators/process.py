"""Row processing job (I4): cells (F18-F22) + required split, dedupe.

Order of effects, as in the target contract:

1. required fields are conformed for every row;
2. rows with a missing/invalid required field are dropped (G1);
3. rows whose key occurs more than once among the survivors are dropped, every
   copy (G3);
4. optional fields are reported only for the surviving rows (G4).

Required and key fields are conformed first and materialised once, because the
conformed, dropped and invalid frames and the duplicate keys all read them.
Optional fields are conformed for the surviving rows only and are not held.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueform.functions import cells
from trueform.operators import rows
from trueform.operators.mapping import last_wins
from trueform.plans.spec import FieldSpec, TableSpec
from trueform.session import materialize as _materialize, scratch_path, spread

#: fields with up to this many inputs get a literal map; beyond it they join the mapping (AQE
#: picks the join; multi-value cells element by element). Repeated inputs are settled before.
LITERAL_MAP_LIMIT = 256

MAPPING_SCHEMA = "field string, input string, output string, approved string"

INVALID_SCHEMA = T.StructType([
    T.StructField("case_number", T.StringType()),
    T.StructField("field_name", T.StringType()),
    T.StructField("milestone_flag", T.StringType()),
    T.StructField("original_value", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def _v(name: str) -> str:
    return f"__v_{name}"


def _r(name: str) -> str:
    return f"__r_{name}"


class ProcessResult:
    """Conformed rows plus the dropped-row and invalid-value frames.

    ``dropped`` and ``invalid`` are built on first access, so a caller that only
    needs the conformed rows does not pay for planning them. A caller that needs
    them all takes :meth:`store`, which computes every cell once.
    """

    def __init__(self, conformed: DataFrame, held: DataFrame, make_dropped, make_invalid, make_summary, make_tagged):
        self.conformed = conformed
        self.held = held  # the materialised frame
        self._make_dropped, self._make_invalid, self._make_summary, self._make_tagged = make_dropped, make_invalid, make_summary, make_tagged
        self._dropped = self._invalid = None

    @property
    def dropped(self) -> DataFrame:
        if self._dropped is None:
            self._dropped = self._make_dropped()
        return self._dropped

    @property
    def invalid(self) -> DataFrame:
        if self._invalid is None:
            self._invalid = self._make_invalid()
        return self._invalid

    def summary(self) -> DataFrame:
        """H1: rows to upload, rows dropped, values dropped."""
        return self._make_summary()

    def store(self, path: str | None = None) -> StoredResult:
        """Conformed, dropped and invalid rows in one pass, as one table with a folder for each kind.

        The summary is observed while the rows are written, after the last shuffle,
        so each task's rows count once; it needs no job of its own. ``path`` is a
        folder that the whole cluster shares, by default one in the checkpoint folder.
        """
        tagged, observed = self._make_tagged(), Observation()
        spark = tagged.sparkSession
        path = path or scratch_path(spark, f"conformed-{uuid.uuid4().hex[:12]}")
        of_kind = lambda k: F.count_if(F.col("kind") == k)
        (tagged.observe(observed, of_kind("conformed").alias("rows_to_upload"), of_kind("dropped").alias("rows_dropped"),
                        of_kind("invalid").alias("values_dropped"))
         .write.partitionBy("kind").parquet(path))
        self.unpersist()
        frames = {}
        for kind in ("conformed", "dropped", "invalid"):
            schema = T.StructType([tagged.schema[kind]])  # a kind without rows has no folder
            rows_ = spark.read.schema(schema).parquet(f"{path}/kind={kind}") if observed.get[_KIND_COUNTS[kind]] else spark.createDataFrame([], schema)
            frames[kind] = rows_.select(f"{kind}.*")
        return StoredResult(path=path, counts={k: int(v) for k, v in observed.get.items()}, **frames)

    def unpersist(self) -> None:
        self.held.unpersist()


_KIND_COUNTS = {"conformed": "rows_to_upload", "dropped": "rows_dropped", "invalid": "values_dropped"}


@dataclass(frozen=True)
class StoredResult:
    """The outputs of :meth:`ProcessResult.store`, read from where they were written."""

    path: str
    counts: dict[str, int]
    conformed: DataFrame
    dropped: DataFrame
    invalid: DataFrame

    def summary(self) -> DataFrame:
        """H1, from the counts of the write."""
        n = self.counts
        return self.conformed.sparkSession.sql(
            f"SELECT {n['rows_to_upload']}L AS rows_to_upload, {n['rows_dropped']}L AS rows_dropped, {n['values_dropped']}L AS values_dropped")


def mapping_frame(spark, mappings) -> DataFrame | None:
    """Accept a long DataFrame or ``{field: {input: (output, approved)}}``."""
    if mappings is None or isinstance(mappings, DataFrame):
        return mappings
    rows_ = [(f, i, o, a) for f, m in mappings.items() for i, (o, a) in m.items()]
    return spark.createDataFrame(rows_, MAPPING_SCHEMA)


def settled_mappings(mappings: DataFrame | None, spec: TableSpec) -> tuple[DataFrame, dict[str, int], dict[str, cells.Lookup]] | None:
    """Mappings with one output an input (E1: the later row wins), inputs per field, literal maps of the small fields.

    The order is the ``position`` column, else the frame's own row order. A blank
    input loads as null and matches no cell. Two small jobs for the whole run.
    """
    wanted = [f.name for f in spec.fields if f.is_mappable]
    if mappings is None or not wanted:
        return None
    m = mappings.where(F.col("field").isin(*wanted) & F.col("input").isNotNull())
    if "position" not in m.columns:
        m = m.withColumn("position", F.monotonically_increasing_id())
    m = last_wins(m)
    counts = {r["field"]: r["n"] for r in m.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = [f for f, n in counts.items() if n <= LITERAL_MAP_LIMIT]
    pairs: dict[str, dict[str, str | None]] = {}
    if small:
        for r in m.where(F.col("field").isin(*small)).select("field", "input", "output").collect():
            pairs.setdefault(r["field"], {})[r["input"]] = r["output"]
    return m, counts, {f: cells.MapLookup(p) for f, p in pairs.items()}


def _lookups(df: DataFrame, fields: list[FieldSpec], settled, array_fields: set[str]) -> tuple[DataFrame, dict[str, cells.Lookup]]:
    """Per-field lookups: literal maps for small mappings, joins for large."""
    if settled is None:
        return df, {}
    m, counts, literal = settled
    names = {f.name for f in fields}
    out: dict[str, cells.Lookup] = {f: p for f, p in literal.items() if f in names}
    by_name = {f.name: f for f in fields}
    for name in counts:
        if name in out or name not in names:
            continue
        fs = by_name[name]
        hit, res, inp, cell = f"__mh_{name}", f"__mo_{name}", f"__mi_{name}", f"__mc_{name}"
        side = (m.where(F.col("field") == name)
                .select(F.col("input").alias(inp), F.col("output").alias(res)))
        if name in array_fields:
            # distinct cells, element by element against the mapping, regrouped by cell
            keys = F.array_distinct(F.transform(F.col(cell), lambda x: cells.mapping_key(fs, x)))
            elements = (df.where(F.col(name).isNotNull()).select(F.col(name).alias(cell)).distinct()
                        .select(cell, F.explode(keys).alias("__key")))
            found = (elements.join(side, F.col("__key") == F.col(inp)).groupBy(cell)
                     .agg(F.map_from_entries(F.collect_list(F.struct(inp, res))).alias(res)))
            df = df.join(found, df[name] == found[cell], "left").drop(cell)
            out[name] = cells.CellLookup(F.col(res))
            continue
        side = side.withColumn(hit, F.lit(True))
        df = df.join(side, cells.mapping_key(fs, F.col(name)) == side[inp], "left").drop(inp)
        out[name] = cells.ColumnLookup(F.coalesce(F.col(hit), F.lit(False)), F.col(res))
    return df, out


def _identifier(spec: TableSpec, df_cols: list[str], key_field: str, for_field: str) -> Column:
    """Identifier reported with an invalid value.

    Required fields are processed in spec order, so a key field reads as
    conformed for fields processed after it and raw before.
    """
    if key_field not in df_cols:
        return F.lit(None).cast("string")
    req = spec.required_names
    if for_field not in req:
        conformed = key_field in req
    else:
        conformed = key_field in req and req.index(key_field) < req.index(for_field)
    if conformed and spec.has(key_field):
        return F.col(_v(key_field)).cast("string")
    return F.col(key_field).cast("string")


def conform_columns(df: DataFrame, cols: list[str], fields: list[FieldSpec], array_fields: set[str],
                    lookups: dict[str, cells.Lookup]) -> DataFrame:
    """Value and reason columns per field, as four narrow projections.

    numeric parse -> transform -> cast -> final value/reason. Each stage reads
    the previous stage's columns, so an expensive piece (a parse, a lookup) is
    computed once per cell instead of being repeated inside every expression
    that needs it; the stages stay in one whole-stage-codegen span. Fields that
    :func:`cells.direct` names need only the second and the last.
    """
    keep = [F.col(c) for c in cols]
    joined = [F.col(c) for c in df.columns if c.startswith(("__mh_", "__mo_"))]  # outputs of joined mappings, read by stage 2
    types = dict(df.dtypes)
    direct = [f for f in fields if cells.direct(f, lookups.get(f.name), types[f.name])]
    staged = [f for f in fields if f not in direct]
    scalar = [f for f in staged if not f.allows_multiple and f.name not in array_fields]
    multi = [f for f in staged if f.allows_multiple and f.name in array_fields]
    # 1: float view of the text, for the fields that test numbers (per element for lists)
    s1 = df.select(*keep, *joined,
                   *[cells.as_double(F.col(f.name)).alias(f"__d_{f.name}") for f in scalar if cells.needs_number(f)],
                   *[cells.multi_parse(F.col(f.name), f).alias(f"__xa_{f.name}") for f in multi])
    # 2: transform phase (+ the complete cells that cannot be conformed)
    results = {f.name: c for f in direct if (c := cells.direct_stage(f.name, f)) is not None}
    t_cols, done = [c.alias(f"__t_{n}") for n, c in results.items()], []
    for f in staged:
        raw = F.col(f.name)
        if f.allows_multiple and f.name not in array_fields:
            v, r = cells.conform_multi(raw, f, lookups.get(f.name), raw_is_array=False)
            t_cols += [v.alias(_v(f.name)), r.alias(_r(f.name))]
            done.append(f.name)
        elif f.allows_multiple:
            t_cols.append(cells.multi_transform(F.col(f"__xa_{f.name}"), f, lookups.get(f.name))
                          .alias(f"__ta_{f.name}"))
        elif f.name in array_fields:
            v = F.lit(None).cast(f.spark_type)
            r = F.when(raw.isNotNull(), F.concat(cells.original_text(raw, True), F.lit(" is not a valid " + f.type)))
            t_cols += [v.alias(_v(f.name)), r.alias(_r(f.name))]
            done.append(f.name)
        else:
            d = f"__d_{f.name}" if cells.needs_number(f) else None
            tr = cells.transform_named(f.name, f, lookups.get(f.name), d) if cells.has_transform(f) else None
            tv, trr = (raw, F.lit(None).cast("string")) if tr is None else tr
            t_cols += [tv.alias(f"__t_{f.name}"), trr.alias(f"__tr_{f.name}"),
                       cells.is_blank(raw).alias(f"__b_{f.name}")]
    s2 = s1.select(*keep, *t_cols)
    # 3: cast phase on the transformed value
    c_cols, carry = [], [F.col(_v(n)) for n in done] + [F.col(_r(n)) for n in done]
    made = [F.col(f"__t_{n}") for n in results]
    for f in scalar:
        x = F.col(f"__t_{f.name}")
        cv, cr = cells.cast_named(f"__t_{f.name}", f)
        c_cols += [F.col(f"__tr_{f.name}"), F.col(f"__b_{f.name}"),
                   cells.blank_after_transform(x, f, cells.has_transform(f)).alias(f"__xb_{f.name}"),
                   cv.alias(f"__c_{f.name}"), cr.alias(f"__cr_{f.name}")]
    for f in multi:
        ta = F.col(f"__ta_{f.name}")
        c_cols += [cells.first_reason(ta).alias(f"__mtr_{f.name}"),
                   cells.multi_cast(ta, f).alias(f"__mca_{f.name}")]
    s3 = s2.select(*keep, *carry, *made, *c_cols)
    # 4: first reason wins; blanks are neither values nor errors
    out = []
    for f in direct:
        v, r = cells.direct_final(f.name, f"__t_{f.name}", f)
        out += [v.alias(_v(f.name)), r.alias(_r(f.name))]
    for f in scalar:
        b, xb = F.col(f"__b_{f.name}"), F.col(f"__xb_{f.name}")
        reason = F.when(~b, F.coalesce(F.col(f"__tr_{f.name}"), F.when(~xb, F.col(f"__cr_{f.name}"))))
        value = F.when(~b & ~xb & F.col(f"__tr_{f.name}").isNull() & F.col(f"__cr_{f.name}").isNull(),
                       F.col(f"__c_{f.name}"))
        out += [value.alias(_v(f.name)), reason.alias(_r(f.name))]
    for f in multi:
        v, r = cells.multi_final(F.col(f.name), F.col(f"__mtr_{f.name}"), F.col(f"__mca_{f.name}"))
        out += [v.alias(_v(f.name)), r.alias(_r(f.name))]
    s4 = s3.select(*keep, *carry, *out)
    order = [F.col(c) for c in cols]
    for f in fields:
        order += [F.col(_v(f.name)), F.col(_r(f.name))]
    return s4.select(*order)


def process(df: DataFrame, spec: TableSpec, mappings: DataFrame | Mapping | None = None, *,
            materialize: str | None = "persist", dedupe: bool = True,
            derive: Mapping[str, Column] | None = None) -> ProcessResult:
    """Conform ``df`` to ``spec``; returns conformed, dropped and invalid frames.

    ``dedupe=False`` leaves repeated keys in (a stream settles them over its sink).
    ``derive`` makes the columns to conform, by name, from ``df``'s own (row by row,
    deterministic, other names): only ``df``'s columns are held and go through the
    key shuffle, and each column is made where it is read.
    """
    spark = df.sparkSession
    settled = settled_mappings(mapping_frame(spark, mappings), spec)
    df = spread(df)
    narrow, derive = list(df.columns), dict(derive or {})
    if clash := set(narrow) & set(derive):
        raise ValueError(f"derived columns named like the input's: {sorted(clash)}")
    if derive:
        df = df.select(*narrow, *[c.alias(n) for n, c in derive.items()])
    src_cols = list(derive or narrow)
    required = spec.required_names
    for r in required:  # G2: absent required column reads as all null
        if r not in df.columns:
            if derive:
                derive[r] = F.lit(None).cast("string")
            df = df.withColumn(r, F.lit(None).cast("string"))
    cols = [c for c in df.columns if not derive or c not in narrow]
    fields = [f for f in spec.fields if f.name in cols]
    array_fields = {f.name for f in fields if isinstance(df.schema[f.name].dataType, T.ArrayType)}
    keys = [k for k in spec.primary_key if k in cols]
    first = [f for f in fields if f.required or f.name in keys]
    later = [f for f in fields if not f.required and f.name not in keys]

    # required and key fields of every row
    df, lookups = _lookups(df, first, settled, array_fields)
    made = [f.name for f in first if f.name in derive]
    staged = conform_columns(df, [*narrow, *made] if derive else cols, first, array_fields, lookups).drop(*made)
    missing = rows.missing_required({f.name: F.col(_v(f.name)) for f in first}, required)
    base = _materialize(staged.withColumn("__missing", missing), materialize)

    ok = reduce(Column.__and__, [F.col(_v(r)).isNotNull() for r in required], F.lit(True))
    if keys and dedupe:
        flagged = rows.flag_duplicates(base, [_v(k) if spec.has(k) else k for k in keys], eligible=ok)
    else:
        flagged = base.withColumn("__dup", F.lit(False))
    status = F.when(~ok, F.lit("missing")).when(F.col("__dup"), F.lit("duplicate")).otherwise(F.lit("kept"))
    parent = flagged.withColumns({"__status": status, **derive})

    # optional fields of the survivors
    full = parent.where(F.col("__status") == "kept")
    if later:
        full, lookups = _lookups(full, later, settled, array_fields)
        done = [*cols, *[name(f.name) for f in first for name in (_v, _r)], "__status"]
        full = conform_columns(full, done, later, array_fields, lookups)

    # conformed: input column order, spec columns replaced by their values
    out_cols = []
    for c in cols:
        if spec.has(c):
            out_cols.append(F.col(_v(c)).alias(c))
        elif not c.startswith("__"):
            out_cols.append(F.col(c))
    conformed = full.select(*out_cols)

    def dropped_columns() -> list[Column]:
        # pre-transform rows; duplicates carry conformed required fields
        d_cols = []
        for c in src_cols:
            if c in required and spec.has(c):
                d_cols.append(F.when(F.col("__status") == "duplicate", F.col(_v(c)).cast("string"))
                              .otherwise(F.col(c).cast("string")).alias(c))
            else:
                d_cols.append(F.col(c))
        return [*d_cols, F.col("__status").alias("drop_kind"),
                F.when(F.col("__status") == "missing", F.col("__missing")).alias("missing_fields")]

    def make_dropped() -> DataFrame:
        return parent.where(F.col("__status") != "kept").select(*dropped_columns())

    def make_invalid() -> DataFrame:
        early = invalid_values(parent, spec, first, array_fields, cols)
        return early.unionByName(invalid_values(full, spec, later, array_fields, cols)) if later else early

    def make_summary() -> DataFrame:
        return summary_frame([_counts(parent, first), _counts(full, later, values_only=True)])

    def make_tagged() -> DataFrame:
        # optional cells of dropped rows are hidden, so that conforming them costs nothing
        kept = F.col("__status") == "kept"
        rest = [f.name for f in later]
        whole = parent.withColumn("__dropped", F.when(~kept, F.struct(*dropped_columns())))
        if later:
            whole = whole.withColumns({n: F.when(kept, F.col(n)) for n in rest})
            whole, lookups = _lookups(whole, later, settled, array_fields)
            done = [*cols, *[name(f.name) for f in first for name in (_v, _r)], "__status", "__dropped"]
            whole = conform_columns(whole, done, later, array_fields, lookups)
        row = F.when(kept, F.struct(*out_cols))
        bad = _invalid_records(spec, [*first, *later], array_fields, cols)
        whole = whole.select(row.alias("__row"), "__dropped", bad.alias("__bad"))
        tag = lambda kind, **held: F.struct(F.lit(kind).alias("kind"), *[held.get(k, F.lit(None)).alias(k) for k in ("conformed", "dropped", "invalid")])
        types = whole.schema
        null = {"conformed": F.lit(None).cast(types["__row"].dataType), "dropped": F.lit(None).cast(types["__dropped"].dataType),
                "invalid": F.lit(None).cast(INVALID_SCHEMA)}
        tags = F.concat(
            F.filter(F.array(tag("conformed", **{**null, "conformed": F.col("__row")}), tag("dropped", **{**null, "dropped": F.col("__dropped")})),
                     lambda x: x["conformed"].isNotNull() | x["dropped"].isNotNull()),
            F.transform("__bad", lambda x: tag("invalid", **{**null, "invalid": x})))
        return whole.select(F.explode(tags).alias("t")).select("t.*")

    return ProcessResult(conformed, base, make_dropped, make_invalid, make_summary, make_tagged)


def _invalid_records(spec: TableSpec, fields: list[FieldSpec], array_fields: set[str], cols: list[str]) -> Column:
    """the invalid cells of a row; optional fields only if the row is kept."""
    kept = F.col("__status") == "kept"
    recs = []
    for f in fields:
        reason = F.col(_r(f.name))
        if not f.required:
            reason = F.when(kept, reason)
        recs.append(F.struct(
            _identifier(spec, cols, spec.case_field, f.name).alias("case_number"),
            F.lit(f.name).alias("field_name"),
            _identifier(spec, cols, spec.flag_field, f.name).alias("milestone_flag"),
            cells.original_text(F.col(f.name), f.name in array_fields).alias("original_value"),
            reason.alias("reason"),
        ))
    empty = F.array().cast(T.ArrayType(INVALID_SCHEMA))
    return F.filter(F.array(*recs), lambda x: x["reason"].isNotNull()) if recs else empty


def invalid_values(parent: DataFrame, spec: TableSpec, fields: list[FieldSpec],
                   array_fields: set[str], cols: list[str]) -> DataFrame:
    """one record per invalid cell; optional fields only for kept rows."""
    return parent.select(F.explode(_invalid_records(spec, fields, array_fields, cols)).alias("r")).select("r.*")


def _counts(frame: DataFrame, fields: list[FieldSpec], values_only: bool = False) -> DataFrame:
    """One row: rows kept, rows dropped (0 if ``values_only``) and invalid cells of ``fields``."""
    kept = F.col("__status") == "kept"
    reasons = [F.col(_r(f.name)) if f.required else F.when(kept, F.col(_r(f.name))) for f in fields]
    bad = F.size(F.filter(F.array(*reasons), lambda x: x.isNotNull())) if reasons else F.lit(0)
    up, down = (F.lit(0), F.lit(0)) if values_only else (F.count_if(kept), F.count_if(~kept))
    return frame.agg(up.cast("bigint").alias("rows_to_upload"), down.cast("bigint").alias("rows_dropped"),
                     F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("values_dropped"))


def summary_frame(parts: list[DataFrame]) -> DataFrame:
    """H1: rows to upload, rows dropped, values dropped, summed over one-row counts."""
    names = ["rows_to_upload", "rows_dropped", "values_dropped"]
    return reduce(DataFrame.unionByName, parts).agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
