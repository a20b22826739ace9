"""The rebuilt 93-field target spec over lineitem: wide cell conformance at scale.

Each lineitem row becomes one dirty wide record (every spec field as text,
derived by a per-type rule from the row key), which the process job conforms.
The DuckDB statement is generated per field *type* from the same spec, written
independently of the Column builders (plain CASE / regexp / strptime / list
functions), so the pair cross-checks the whole cell library at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trueform.functions.cells import sql_literal
from trueform.operators.process import process
from trueform.operators.shape import arrays_to_text, split_values
from trueform.plans.spec import FieldSpec, TableSpec, load_spec
from trueform.workloads.conform_q import NUM_RE, _split_select
from trueform.workloads.registry import register, table

SPEC: TableSpec = load_spec()

_DEC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_NOT_MAPPED = " is not in field mapping or valid value set"


def _h(k: int) -> str:
    return f"((l_orderkey * 7 + l_linenumber * 13 + {k} * 17) % 97)"


def _case_index(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {expr} % {len(values)} {whens} END)"


def _element(expr: str, values: list[str]) -> str:
    """:func:`_case_index` as one array access (Spark)."""
    return f"get(array({', '.join(map(sql_literal, values))}), CAST({expr} % {len(values)} AS INT))"


def _case_upper(expr: str, values: list[str]) -> str:
    return f"upper({_case_index(expr, values)})"


def _element_upper(expr: str, values: list[str]) -> str:
    return f"get(array({', '.join(f'upper({sql_literal(v)})' for v in values)}), CAST({expr} % {len(values)} AS INT))"


def _labels(f: FieldSpec) -> list[str]:
    return [label for label, _ in f.enum_mapping if "'" not in label]


def _dirt(k: int, f: FieldSpec, pick=_case_index, pick_upper=_case_upper) -> str:
    """Dirty text for field ``f`` (index ``k``): valid in Spark SQL and, with the default picks, DuckDB."""
    h = _h(k)
    n = f.name
    if n == "MilestoneFlag":
        return ("CASE l_linenumber WHEN 1 THEN 'Intake' WHEN 2 THEN 'exit' WHEN 3 THEN 'Midpoint' "
                "WHEN 4 THEN 'Intake' WHEN 5 THEN 'TwoYear' WHEN 6 THEN 'Update' ELSE '' END")
    if n == "CaseNumber":
        return "CASE WHEN l_orderkey % 50 = 0 THEN '' ELSE concat('CASE-', CAST(l_orderkey AS STRING)) END"
    if n == "MemberOrganization":
        return "'M-1'"
    if f.transform == "prefix":
        return (f"CASE {h} % 4 WHEN 0 THEN concat(lpad(CAST({h} AS STRING), 2, '0'), '-', "
                f"lpad(CAST(l_orderkey % 10000 AS STRING), 4, '0'), '.00') WHEN 1 THEN '123-45' WHEN 2 THEN '' "
                f"ELSE concat(lpad(CAST({h} % 100 AS STRING), 2, '0'), '-1234') END")
    if f.transform == "state":
        return f"CASE {h} % 5 WHEN 0 THEN 'IL' WHEN 1 THEN 'texas' WHEN 2 THEN '06' WHEN 3 THEN 'Narnia' ELSE '' END"
    if f.enum_mapping is not None:
        lab = pick(h, _labels(f))
        lo, hi = int(f.minimum), int(f.maximum)
        if f.allows_multiple:
            return (f"CASE {h} % 4 WHEN 0 THEN concat({lab}, ';', CAST({lo} AS STRING)) "
                    f"WHEN 1 THEN concat({lab}, ' ; bogus') WHEN 2 THEN '' "
                    f"ELSE concat(CAST({hi + 1} AS STRING), ';', {lab}) END")
        return (f"CASE {h} % 6 WHEN 0 THEN {lab} WHEN 1 THEN {pick_upper(h, _labels(f))} "
                f"WHEN 2 THEN CAST({lo} + {h} % {hi - lo + 1} AS STRING) WHEN 3 THEN 'unknown' WHEN 4 THEN '' "
                f"ELSE CAST({hi + 1} AS STRING) END")
    if f.type == "boolean":
        return (f"CASE {h} % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'N' WHEN 2 THEN 'True' WHEN 3 THEN '1.0' "
                f"WHEN 4 THEN 'maybe' WHEN 5 THEN '' ELSE '2' END")
    if f.type == "integer":
        lo, hi = int(f.minimum), int(f.maximum)
        return (f"CASE {h} % 5 WHEN 0 THEN CAST({lo} + {h} % {hi - lo + 1} AS STRING) "
                f"WHEN 1 THEN concat(CAST({lo} AS STRING), '.0') WHEN 2 THEN 'abc' "
                f"WHEN 3 THEN CAST({hi + 1} AS STRING) ELSE '' END")
    if f.type == "number":
        return (f"CASE {h} % 5 WHEN 0 THEN concat(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 100 AS STRING), '.25') "
                f"WHEN 1 THEN '1,234.50' WHEN 2 THEN 'n/a' WHEN 3 THEN '-1' ELSE '' END")
    if f.type == "date":
        return (f"CASE {h} % 5 WHEN 0 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) "
                f"WHEN 1 THEN concat(CAST(month(l_shipdate) AS STRING), '/', CAST(day(l_shipdate) AS STRING), '/', "
                f"CAST(year(l_shipdate) AS STRING)) WHEN 2 THEN 'someday' WHEN 3 THEN '' "
                f"ELSE concat(CAST(year(l_shipdate) AS STRING), '-', CAST(month(l_shipdate) AS STRING), '-', "
                f"CAST(day(l_shipdate) AS STRING)) END")
    return f"CASE WHEN {h} % 10 = 0 THEN '' ELSE concat('p', CAST({h} AS STRING)) END"


def _dirt_select(quote: str) -> list[str]:
    return [f"{_dirt(k, f)} AS {quote}{f.name}{quote}" for k, f in enumerate(SPEC.fields)]


def dirty_columns() -> dict[str, Column]:
    """The fields of a dirty wide record over a lineitem row; multi-value fields split on ';' (D6)."""
    dirt = {f.name: (f, F.expr(_dirt(k, f, _element, _element_upper))) for k, f in enumerate(SPEC.fields)}
    return {n: split_values(c, ";") if f.allows_multiple else c for n, (f, c) in dirt.items()}


def run_mission(spark: SparkSession, sf_dir: str, materialize: str | None = None):
    """The 93 columns are made from the few that a lineitem row has, after the key shuffle; nothing wide is held."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    return process(items, SPEC, materialize=materialize, derive=dirty_columns())


# -- oracle generation ---------------------------------------------------------------------------

def _q(n: str) -> str:
    return f'"{n}"'


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _blank(r: str) -> str:
    return f"({r} IS NULL OR trim({r}) = '')"


def _dbl(r: str) -> str:
    return f"(CASE WHEN regexp_matches({r}, '{NUM_RE}') THEN TRY_CAST(trim({r}) AS DOUBLE) END)"


def _whole(r: str) -> str:
    d = _dbl(r)
    return f"coalesce(NOT isnan({d}) AND NOT isinf({d}) AND {d} = round({d}), false)"


def _ci(expr: str, pairs: list[tuple[str, str]]) -> str:
    """CASE lower(expr) -> first option whose lower-case form matches."""
    seen, whens = set(), []
    for k, v in pairs:
        lk = k.lower()
        if lk in seen:
            continue
        seen.add(lk)
        whens.append(f"WHEN {_sql_str(lk)} THEN {v}")
    return f"(CASE lower({expr}) {' '.join(whens)} END)"


def _range_sql(v: str, f: FieldSpec) -> str:
    lo, hi = f.minimum, f.maximum
    if lo is None and hi is None:
        return "NULL"
    if lo is not None and hi is not None:
        return f"CASE WHEN {v} < {lo} OR {v} > {hi} THEN '{f.name} must be within the range [{lo}, {hi}]' END"
    if hi is not None:
        return f"CASE WHEN {v} > {hi} THEN '{f.name} must be less than or equal to {hi}' END"
    return f"CASE WHEN {v} < {lo} THEN '{f.name} must be greater than or equal to {lo}' END"


def _scalar_sql(f: FieldSpec, r: str) -> tuple[str, str]:
    """(value, reason) SQL for a single-value field read from text column ``r``."""
    blank = _blank(r)
    if f.enum_mapping is not None:
        ci = _ci(r, [(lab, str(code)) for lab, code in f.enum_mapping])
        tv = f"(CASE WHEN {_whole(r)} THEN CAST({_dbl(r)} AS BIGINT) ELSE {ci} END)"
        tr = f"(CASE WHEN NOT {_whole(r)} AND {ci} IS NULL THEN concat({r}, '{_NOT_MAPPED}') END)"
        cr = f"({_range_sql(tv, f)})"
    elif f.type == "boolean":
        vn = f"(CASE WHEN {_whole(r)} THEN CAST(CAST({_dbl(r)} AS BIGINT) AS VARCHAR) ELSE {r} END)"
        opts = f.options
        tok = _ci(vn, [(o, _sql_str(o)) for o in opts])
        rep = _sql_str(f" ({opts!r})")
        tr = f"(CASE WHEN {tok} IS NULL THEN concat({vn}, '{_NOT_MAPPED}', {rep}) END)"
        tv = (f"(CASE WHEN {tok} IN ({', '.join(map(_sql_str, f.true_values))}) THEN true "
              f"WHEN {tok} IN ({', '.join(map(_sql_str, f.false_values))}) THEN false END)")
        cr = "NULL"
    elif f.enum is not None:
        tv = _ci(r, [(o, _sql_str(o)) for o in f.enum])
        tr = f"(CASE WHEN {tv} IS NULL THEN concat({r}, '{_NOT_MAPPED}') END)"
        cr = "NULL"
    elif f.transform == "prefix":
        p = f"split_part(trim({r}), '.', 1)"
        ok = f"regexp_full_match({p}, '{f.pattern}')"
        value = f"CASE WHEN NOT {blank} AND {p} <> '' AND {ok} THEN {p} END"
        reason = f"CASE WHEN NOT {blank} AND {p} <> '' AND NOT {ok} THEN '{f.name} should be in the format {f.pattern_hint}' END"
        return value, reason
    elif f.transform == "state":
        st = "(CASE upper(trim({r})) WHEN 'IL' THEN 'IL' WHEN 'TEXAS' THEN 'TX' WHEN '06' THEN 'CA' END)".format(r=r)
        return (f"CASE WHEN NOT {blank} THEN {st} END",
                f"CASE WHEN NOT {blank} AND {st} IS NULL THEN concat({r}, ' is not a valid state') END")
    elif f.type == "integer":
        tv = f"(CASE WHEN {_whole(r)} THEN CAST({_dbl(r)} AS BIGINT) END)"
        tr = f"(CASE WHEN {tv} IS NULL THEN concat({r}, ' is not an integer') END)"
        cr = f"({_range_sql(tv, f)})"
    elif f.type == "number":
        t = f"replace(trim({r}), ',', '')"
        tv = f"(CASE WHEN regexp_matches({t}, '{_DEC_RE}') THEN TRY_CAST({t} AS DECIMAL(18,6)) END)"
        tr = "NULL"
        cr = f"(CASE WHEN {tv} IS NULL THEN concat({r}, ' is not a valid number') ELSE {_range_sql(tv, f)} END)"
    elif f.type == "date":
        tv = (f"coalesce(TRY_CAST(try_strptime(trim({r}), '%Y-%m-%d') AS DATE), "
              f"TRY_CAST(try_strptime(trim({r}), '%m/%d/%Y') AS DATE))")
        tr = "NULL"
        cr = f"(CASE WHEN {tv} IS NULL THEN concat({r}, ' is not a valid date') END)"
    else:
        return f"CASE WHEN NOT {blank} THEN {r} END", "CAST(NULL AS VARCHAR)"
    value = f"CASE WHEN NOT {blank} AND {tr} IS NULL AND {cr} IS NULL THEN {tv} END"
    reason = f"CASE WHEN NOT {blank} THEN coalesce({tr}, {cr}) END"
    return value, reason


def _multi_sql(f: FieldSpec, r: str) -> tuple[str, str]:
    """(joined value, reason) for a multi-value integer-enum field (split on ';')."""
    parts = f"list_transform(string_split({r}, ';'), lambda x: trim(x))"
    ci = _ci("x", [(lab, str(code)) for lab, code in f.enum_mapping])
    xw = _whole("x")
    tv = f"CASE WHEN x = '' THEN NULL WHEN {xw} THEN CAST({_dbl('x')} AS BIGINT) ELSE {ci} END"
    trx = f"CASE WHEN x = '' OR {xw} OR {ci} IS NOT NULL THEN NULL ELSE concat(x, '{_NOT_MAPPED}') END"
    tr = f"list_filter(list_transform({parts}, lambda x: {trx}), lambda e: e IS NOT NULL)[1]"
    vals = f"list_filter(list_transform({parts}, lambda x: {tv}), lambda v: v IS NOT NULL)"
    lo, hi = f.minimum, f.maximum
    cr = (f"CASE WHEN len(list_filter({vals}, lambda v: v < {lo} OR v > {hi})) > 0 "
          f"THEN '{f.name} must be within the range [{lo}, {hi}]' END")
    reason = f"CASE WHEN {r} IS NULL THEN NULL ELSE coalesce({tr}, {cr}) END"
    value = f"CASE WHEN {r} IS NOT NULL AND ({reason}) IS NULL AND len({vals}) > 0 THEN array_to_string({vals}, ',') END"
    return value, reason


def oracle_sql() -> str:
    req = SPEC.required_names
    cols = []
    for f in SPEC.fields:
        v, r = (_multi_sql if f.allows_multiple else _scalar_sql)(f, _q(f.name))
        cols.append(f"{v} AS {_q('v_' + f.name)}")
        if f.required:
            cols.append(f"{r} AS {_q('r_' + f.name)}")
    miss = " OR ".join(f"{_q('v_' + n)} IS NULL" for n in req)
    keys = ", ".join(_q("v_" + k) for k in SPEC.primary_key)
    out = ", ".join(f"{_q('v_' + f.name)} AS {_q(f.name)}" for f in SPEC.fields)
    return f"""WITH d AS (SELECT {', '.join(_dirt_select('"'))} FROM lineitem),
c AS (SELECT {', '.join(cols)} FROM d),
s AS (SELECT *, ({miss}) AS miss FROM c),
k AS (SELECT *, sum(CASE WHEN miss THEN 0 ELSE 1 END) OVER (PARTITION BY {keys}) AS n_key FROM s)
SELECT {out} FROM k WHERE NOT miss AND n_key = 1"""


@register("i4_mission", oracle_sql())
def i4_mission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 on the full 93-field target spec: one dirty wide record per lineitem row,
    conformed, duplicates and incomplete rows removed, lists joined (D9)."""
    return arrays_to_text(run_mission(spark, sf_dir).conformed, SPEC)
