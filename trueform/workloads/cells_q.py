"""Cell-function workloads (F1-F18) over dirty text derived from orders and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueform.functions import cells
from trueform.operators.shape import join_values, split_values
from trueform.plans.spec import FieldSpec, TableSpec
from trueform.workloads.conform_q import NUM_RE, _split_select
from trueform.session import spread
from trueform.workloads.registry import register, table

ORDERS_DIRT = """
  o_orderkey,
  CASE WHEN o_orderkey % 11 = 0 THEN ''
       WHEN o_orderkey % 13 = 0 THEN NULL
       WHEN o_orderkey % 17 = 0 THEN CAST(o_orderkey % 7 AS STRING)
       WHEN o_orderkey % 7 = 0 THEN lower(o_orderpriority)
       WHEN o_orderkey % 5 = 0 THEN concat(o_orderpriority, '!')
       WHEN o_orderkey % 3 = 0 THEN concat('  ', o_orderpriority, ' ')
       ELSE o_orderpriority END AS priority_raw,
  CASE o_orderkey % 10 WHEN 0 THEN '3.0' WHEN 1 THEN '3.5' WHEN 2 THEN 'abc' WHEN 3 THEN ' 7 '
       WHEN 4 THEN '1,234' WHEN 5 THEN '' WHEN 6 THEN '-2' WHEN 7 THEN '1e3' WHEN 8 THEN 'nan'
       ELSE CAST(o_custkey AS STRING) END AS num_raw,
  CASE o_orderkey % 9 WHEN 0 THEN 'yes' WHEN 1 THEN 'Y' WHEN 2 THEN 'FALSE' WHEN 3 THEN '1.0'
       WHEN 4 THEN '2' WHEN 5 THEN 'maybe' WHEN 6 THEN '3' WHEN 7 THEN ' ' ELSE 'n' END AS bool_raw,
  CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
       WHEN 1 THEN concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/',
                          CAST(year(o_orderdate) AS STRING))
       WHEN 2 THEN 'soon'
       WHEN 3 THEN concat(CAST(year(o_orderdate) AS STRING), '-13-01')
       WHEN 4 THEN ''
       ELSE concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-',
                   CAST(day(o_orderdate) AS STRING)) END AS date_raw,
  CASE o_orderkey % 5 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
       WHEN 1 THEN concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',',
                          lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0'), '.50')
       WHEN 2 THEN 'n/a' WHEN 3 THEN '-5'
       ELSE concat(' ', CAST(o_custkey AS STRING), ' ') END AS price_raw,
  CASE o_orderkey % 7 WHEN 0 THEN concat(lpad(CAST(o_custkey % 100 AS STRING), 2, '0'), '-',
                                          lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'))
       WHEN 1 THEN concat(lpad(CAST(o_custkey % 100 AS STRING), 2, '0'), '-',
                          lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'), '.00')
       WHEN 2 THEN concat(' ', CAST(o_custkey % 1000 AS STRING), '-12.5')
       WHEN 3 THEN '.7' WHEN 4 THEN 'ab-cdef' WHEN 5 THEN ''
       ELSE concat(CAST(o_custkey AS STRING), '-1') END AS soc_raw,
  CASE o_custkey % 10 WHEN 0 THEN 'AL' WHEN 1 THEN 'California' WHEN 2 THEN '06' WHEN 3 THEN 'ca'
       WHEN 4 THEN ' Texas ' WHEN 5 THEN 'zz' WHEN 6 THEN 'new  york' WHEN 7 THEN 'Puerto Rico'
       WHEN 8 THEN '6' ELSE 'Atlantis' END AS state_raw
"""

PART_DIRT = """
  p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN concat(p_type, ';', lower(p_type))
       WHEN 1 THEN concat(p_type, ' ; ', CAST(p_size % 8 AS STRING))
       WHEN 2 THEN concat(p_type, ';;X')
       WHEN 3 THEN ''
       WHEN 4 THEN concat(' ', p_type, ';')
       ELSE concat('9;', p_type, ';bogus') END AS types_raw
"""

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

BOOL_FIELD = FieldSpec("flag", "boolean")
BOOL_MAPPING = cells.MapLookup({"maybe": ""})
PRIORITY_INT = FieldSpec("priority", "integer", enum_mapping=tuple((p, i + 1) for i, p in enumerate(PRIORITIES)),
                         minimum=1, maximum=5)
PRIORITY_INT_MAPPING = cells.MapLookup({"1-URGENT!": "1-URGENT", "5-LOW!": ""})
PRIORITY_STR = FieldSpec("priority", "string", enum=PRIORITIES)
PRIORITY_STR_MAPPING = cells.MapLookup({"2-HIGH!": "2-HIGH", "3-MEDIUM!": ""})
SOC_FIELD = FieldSpec("SOC", "string", pattern=r"\d{2}-\d{4}", pattern_hint="##-####", transform="prefix")
STATE_FIELD = FieldSpec("State", "string", transform="state")
PRICE_FIELD = FieldSpec("price", "number", minimum=0, group_char=",")
DATE_FIELD = FieldSpec("when", "date")
QTY_BOTH = FieldSpec("qty", "integer", minimum=0, maximum=100)
QTY_MIN = FieldSpec("qty", "integer", minimum=0)
QTY_MAX = FieldSpec("qty", "integer", maximum=100)
TYPES_FIELD = FieldSpec("types", "integer", enum_mapping=tuple((p, i + 1) for i, p in enumerate(PART_TYPES)),
                        minimum=1, maximum=6, allows_multiple=True)


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "orders")).selectExpr(*_split_select(ORDERS_DIRT))


def dirty_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "part")).selectExpr(*_split_select(PART_DIRT))


def _guarded(raw, pair):
    blank = cells.is_blank(raw)
    return F.when(~blank, pair[0]).alias("value"), F.when(~blank, pair[1]).alias("reason")


W = f"WITH d AS (SELECT {ORDERS_DIRT} FROM orders)"
BLANK = "({c} IS NULL OR trim({c}) = '')"
DBL = f"(CASE WHEN regexp_matches({{c}}, '{NUM_RE}') THEN TRY_CAST(trim({{c}}) AS DOUBLE) END)"
WHOLE = "coalesce(NOT isnan({d}) AND NOT isinf({d}) AND {d} = round({d}), false)"


def _whole(c: str) -> str:
    return WHOLE.format(d=DBL.format(c=c))


# F1 -----------------------------------------------------------------------------------
@register("f1_blank", f"{W} SELECT o_orderkey, {BLANK.format(c='priority_raw')} AS blank FROM d")
def f1_blank(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    return d.select("o_orderkey", cells.is_blank(F.col("priority_raw")).alias("blank"))


# F2 / F3 -------------------------------------------------------------------------------
@register("f2_int_test", f"{W} SELECT o_orderkey, {_whole('num_raw')} AS is_int FROM d")
def f2_int_test(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    return d.select("o_orderkey", cells.is_int(F.col("num_raw")).alias("is_int"))


@register("f3_num_test", f"{W} SELECT o_orderkey, regexp_matches(num_raw, '{NUM_RE}') AS is_num FROM d")
def f3_num_test(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    return d.select("o_orderkey", cells.is_num(F.col("num_raw")).alias("is_num"))


# Booleans ----------------------------------------------------------------------
_BOOL_OPTS = "([''yes'', ''Y'', ''true'', ''T'', ''1'', ''no'', ''N'', ''false'', ''F'', ''2''])"
_BOOL_CI = ("CASE lower(vn) WHEN 'yes' THEN 'yes' WHEN 'y' THEN 'Y' WHEN 'true' THEN 'true' WHEN 't' THEN 'T' "
            "WHEN '1' THEN '1' WHEN 'no' THEN 'no' WHEN 'n' THEN 'N' WHEN 'false' THEN 'false' "
            "WHEN 'f' THEN 'F' WHEN '2' THEN '2' END")
_BOOL_T = f"""{W},
b AS (SELECT o_orderkey, bool_raw,
        CASE WHEN {_whole('bool_raw')} THEN CAST(CAST({DBL.format(c='bool_raw')} AS BIGINT) AS STRING)
             ELSE bool_raw END AS vn FROM d),
t AS (SELECT o_orderkey, bool_raw, vn, {BLANK.format(c='bool_raw')} AS blank,
        CASE WHEN vn = 'maybe' THEN NULL ELSE {_BOOL_CI} END AS tv,
        CASE WHEN vn = 'maybe' THEN NULL WHEN {_BOOL_CI} IS NULL
             THEN concat(vn, ' is not in field mapping or valid value set {_BOOL_OPTS}') END AS tr
      FROM b)"""


@register("f4_bool", f"""{_BOOL_T}
SELECT o_orderkey, CASE WHEN NOT blank THEN tv END AS value, CASE WHEN NOT blank THEN tr END AS reason FROM t""")
def f4_bool(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    raw = F.col("bool_raw")
    return d.select("o_orderkey", *_guarded(raw, cells.transform_enum(raw, BOOL_FIELD, BOOL_MAPPING)))


@register("f12_bool_cast", f"""{_BOOL_T}
SELECT o_orderkey,
  CASE WHEN NOT blank AND tr IS NULL THEN
    CASE WHEN tv IN ('yes','Y','true','T','1') THEN true WHEN tv IN ('no','N','false','F','2') THEN false END
  END AS value,
  CASE WHEN NOT blank THEN tr END AS reason FROM t""")
def f12_bool_cast(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    v, r = cells.conform_cell(F.col("bool_raw"), BOOL_FIELD, BOOL_MAPPING)
    return d.select("o_orderkey", v.alias("value"), r.alias("reason"))


# Integer enum ----------------------------------------------------------------
_PRI_CI = ("CASE lower(priority_raw) WHEN '1-urgent' THEN 1 WHEN '2-high' THEN 2 WHEN '3-medium' THEN 3 "
           "WHEN '4-not specified' THEN 4 WHEN '5-low' THEN 5 END")
_PRI_T = f"""{W},
t AS (SELECT o_orderkey, priority_raw, {BLANK.format(c='priority_raw')} AS blank,
  CASE WHEN {_whole('priority_raw')} THEN CAST({DBL.format(c='priority_raw')} AS BIGINT)
       WHEN priority_raw = '1-URGENT!' THEN 1 WHEN priority_raw = '5-LOW!' THEN NULL
       ELSE {_PRI_CI} END AS tv,
  CASE WHEN {_whole('priority_raw')} OR priority_raw IN ('1-URGENT!', '5-LOW!') THEN NULL
       WHEN {_PRI_CI} IS NULL THEN concat(priority_raw, ' is not in field mapping or valid value set') END AS tr
  FROM d)"""


@register("f5_intenum", f"""{_PRI_T}
SELECT o_orderkey, CASE WHEN NOT blank THEN tv END AS value, CASE WHEN NOT blank THEN tr END AS reason FROM t""")
def f5_intenum(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    raw = F.col("priority_raw")
    return d.select("o_orderkey", *_guarded(raw, cells.transform_enum(raw, PRIORITY_INT, PRIORITY_INT_MAPPING)))


@register("f17_reason", f"""{_PRI_T}
SELECT o_orderkey,
  CASE WHEN NOT blank AND tr IS NULL AND tv BETWEEN 1 AND 5 THEN tv END AS value,
  CASE WHEN blank THEN NULL WHEN tr IS NOT NULL THEN tr
       WHEN tv < 1 OR tv > 5 THEN 'priority must be within the range [1, 5]' END AS reason
FROM t""")
def f17_reason(spark, sf_dir):
    """F17 + F21: transform reasons hide cast reasons; range text otherwise."""
    d = dirty_orders(spark, sf_dir)
    v, r = cells.conform_cell(F.col("priority_raw"), PRIORITY_INT, PRIORITY_INT_MAPPING)
    return d.select("o_orderkey", v.alias("value"), r.alias("reason"))


# String enum ------------------------------------------------------------------
_PRI_S = ("CASE lower(priority_raw) WHEN '1-urgent' THEN '1-URGENT' WHEN '2-high' THEN '2-HIGH' "
          "WHEN '3-medium' THEN '3-MEDIUM' WHEN '4-not specified' THEN '4-NOT SPECIFIED' WHEN '5-low' THEN '5-LOW' END")


@register("f6_strenum", f"""{W}
SELECT o_orderkey,
  CASE WHEN {BLANK.format(c='priority_raw')} THEN NULL
       WHEN priority_raw = '2-HIGH!' THEN '2-HIGH' WHEN priority_raw = '3-MEDIUM!' THEN NULL
       ELSE {_PRI_S} END AS value,
  CASE WHEN {BLANK.format(c='priority_raw')} OR priority_raw IN ('2-HIGH!', '3-MEDIUM!') THEN NULL
       WHEN {_PRI_S} IS NULL THEN concat(priority_raw, ' is not in field mapping or valid value set') END AS reason
FROM d""")
def f6_strenum(spark, sf_dir):
    """F6 + F16: mapping first, then case-insensitive canonical spelling; enum check."""
    d = dirty_orders(spark, sf_dir)
    v, r = cells.conform_cell(F.col("priority_raw"), PRIORITY_STR, PRIORITY_STR_MAPPING)
    return d.select("o_orderkey", v.alias("value"), r.alias("reason"))


# Prefix code and pattern ----------------------------------------------------------
@register("f7_prefix", f"""{W}
SELECT o_orderkey, CASE WHEN NOT {BLANK.format(c='soc_raw')} THEN split_part(trim(soc_raw), '.', 1) END AS value
FROM d""")
def f7_prefix(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    raw = F.col("soc_raw")
    return d.select("o_orderkey", F.when(~cells.is_blank(raw), cells.transform_prefix(raw)[0]).alias("value"))


@register("f15_pattern", f"""{W},
t AS (SELECT o_orderkey, {BLANK.format(c='soc_raw')} AS blank, split_part(trim(soc_raw), '.', 1) AS tv FROM d)
SELECT o_orderkey,
  CASE WHEN NOT blank AND tv <> '' AND regexp_full_match(tv, '\\d{{2}}-\\d{{4}}') THEN tv END AS value,
  CASE WHEN NOT blank AND tv <> '' AND NOT regexp_full_match(tv, '\\d{{2}}-\\d{{4}}')
       THEN 'SOC should be in the format ##-####' END AS reason
FROM t""")
def f15_pattern(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    v, r = cells.conform_cell(F.col("soc_raw"), SOC_FIELD)
    return d.select("o_orderkey", v.alias("value"), r.alias("reason"))


# F8: states ---------------------------------------------------------------------------------
_STATE = ("CASE upper(trim(state_raw)) WHEN 'AL' THEN 'AL' WHEN 'CALIFORNIA' THEN 'CA' WHEN '06' THEN 'CA' "
          "WHEN 'CA' THEN 'CA' WHEN 'TEXAS' THEN 'TX' WHEN 'NEW  YORK' THEN 'NY' WHEN 'PUERTO RICO' THEN 'PR' "
          "WHEN '6' THEN 'CA' END")


@register("f8_lookup", f"""{W}
SELECT o_orderkey, {_STATE} AS value,
  CASE WHEN {_STATE} IS NULL THEN concat(state_raw, ' is not a valid state') END AS reason FROM d""")
def f8_lookup(spark, sf_dir):
    """F8 through the process job's staged projection, which finds each cell's code once."""
    from trueform.operators.process import conform_columns
    name = STATE_FIELD.name
    d = dirty_orders(spark, sf_dir).select("o_orderkey", F.col("state_raw").alias(name))
    out = conform_columns(d, d.columns, [STATE_FIELD], set(), {})
    return out.select("o_orderkey", F.col(f"__v_{name}").alias("value"), F.col(f"__r_{name}").alias("reason"))


# Integers and ranges ------------------------------------------------------------
_INT_T = f"""{W},
t AS (SELECT o_orderkey, num_raw, {BLANK.format(c='num_raw')} AS blank,
        CASE WHEN {_whole('num_raw')} THEN CAST({DBL.format(c='num_raw')} AS BIGINT) END AS tv FROM d)"""


@register("f9_int", f"""{_INT_T}
SELECT o_orderkey, CASE WHEN NOT blank THEN tv END AS value,
  CASE WHEN NOT blank AND tv IS NULL THEN concat(num_raw, ' is not an integer') END AS reason FROM t""")
def f9_int(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    raw = F.col("num_raw")
    return d.select("o_orderkey", *_guarded(raw, cells.transform_int(raw)))


@register("f14_range", f"""{_INT_T}
SELECT o_orderkey,
  CASE WHEN tv < 0 OR tv > 100 THEN 'qty must be within the range [0, 100]' END AS r_both,
  CASE WHEN tv < 0 THEN 'qty must be greater than or equal to 0' END AS r_min,
  CASE WHEN tv > 100 THEN 'qty must be less than or equal to 100' END AS r_max
FROM (SELECT o_orderkey, CASE WHEN NOT blank THEN tv END AS tv FROM t)""")
def f14_range(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    raw = F.col("num_raw")
    v = F.when(~cells.is_blank(raw), cells.transform_int(raw)[0])
    return d.select("o_orderkey",
                    cells.range_reason(v, QTY_BOTH).alias("r_both"),
                    cells.range_reason(v, QTY_MIN).alias("r_min"),
                    cells.range_reason(v, QTY_MAX).alias("r_max"))


# numbers --------------------------------------------------------------------------------
@register("f10_number", f"""{W},
t AS (SELECT o_orderkey, price_raw, {BLANK.format(c='price_raw')} AS blank,
        TRY_CAST(replace(trim(price_raw), ',', '') AS DECIMAL(18,6)) AS dv FROM d)
SELECT o_orderkey, CASE WHEN NOT blank AND dv >= 0 THEN dv END AS value,
  CASE WHEN blank THEN NULL WHEN dv IS NULL THEN concat(price_raw, ' is not a valid number')
       WHEN dv < 0 THEN 'price must be greater than or equal to 0' END AS reason
FROM t""")
def f10_number(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    v, r = cells.conform_cell(F.col("price_raw"), PRICE_FIELD)
    return d.select("o_orderkey", v.alias("value"), r.alias("reason"))


# dates ------------------------------------------------------------------------------------
@register("f11_date", f"""{W},
t AS (SELECT o_orderkey, date_raw, {BLANK.format(c='date_raw')} AS blank,
        coalesce(TRY_CAST(try_strptime(trim(date_raw), '%Y-%m-%d') AS DATE),
                 TRY_CAST(try_strptime(trim(date_raw), '%m/%d/%Y') AS DATE)) AS dv FROM d)
SELECT o_orderkey, CASE WHEN NOT blank THEN dv END AS value,
  CASE WHEN NOT blank AND dv IS NULL THEN concat(date_raw, ' is not a valid date') END AS reason FROM t""")
def f11_date(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    v, r = cells.conform_cell(F.col("date_raw"), DATE_FIELD)
    return d.select("o_orderkey", v.alias("value"), r.alias("reason"))


# dates written word by word; the oracle knows the day and needs no parser ---------------
DATE_FORMS = (  # (Spark pattern, DuckDB format) of the same text
    ("d-MMM-yyyy", "%-d-%b-%Y"), ("yyyyMMdd", "%Y%m%d"), ("MMMM d'th', yyyy", "%B %-dth, %Y"), ("EEE, d MMM yyyy", "%a, %-d %b %Y"),
    ("MMM-dd-yyyy", "%b-%d-%Y"), ("yyyy MMM d", "%Y %b %-d"), ("d MMMM yyyy HH:mm", "%-d %B %Y %H:%M"), ("M.d.yy", "%-m.%-d.%y"),
    ("MMMM yyyy", "%B %Y"), ("'Feb 30, 'yyyy", "Feb 30, %Y"))
NO_DATES = 2  # the last forms name no day


def _date_forms_sql() -> str:
    texts = " ".join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, (_, f) in enumerate(DATE_FORMS))
    return f"""WITH t AS (SELECT o_orderkey, o_orderkey % {len(DATE_FORMS)} AS form, o_orderdate,
  CASE o_orderkey % {len(DATE_FORMS)} {texts} END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN form < {len(DATE_FORMS) - NO_DATES} THEN CAST(o_orderdate AS DATE) END AS value,
  CASE WHEN form >= {len(DATE_FORMS) - NO_DATES} THEN concat(raw, ' is not a valid date') END AS reason FROM t"""


@register("f11_date_forms", _date_forms_sql())
def f11_date_forms(spark, sf_dir):
    """Order dates written in ten forms, read back as cells of a date field."""
    form = F.col("o_orderkey") % len(DATE_FORMS)
    raw = F.coalesce(*[F.when(form == i, F.date_format("o_orderdate", p)) for i, (p, _) in enumerate(DATE_FORMS)])
    d = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    v, r = cells.conform_cell(F.col("raw"), DATE_FIELD)
    return d.select("o_orderkey", "raw", v.alias("value"), r.alias("reason"))


# multi-value cells ----------------------------------------------------------------------
_TYPE_CI = ("CASE lower(x) WHEN 'economy' THEN 1 WHEN 'large' THEN 2 WHEN 'medium' THEN 3 "
            "WHEN 'promo' THEN 4 WHEN 'small' THEN 5 WHEN 'standard' THEN 6 END")
_XD = f"(CASE WHEN regexp_matches(x, '{NUM_RE}') THEN TRY_CAST(trim(x) AS DOUBLE) END)"
_XW = WHOLE.format(d=_XD)


@register("f18_multi", f"""WITH d AS (SELECT {PART_DIRT} FROM part),
s AS (SELECT p_partkey, list_transform(string_split(types_raw, ';'), lambda x: trim(x)) AS parts FROM d),
t AS (SELECT p_partkey, list_transform(parts, lambda x: struct_pack(
        v := CASE WHEN x = '' THEN NULL WHEN {_XW} THEN CAST({_XD} AS BIGINT) ELSE {_TYPE_CI} END,
        r := CASE WHEN x = '' OR {_XW} OR {_TYPE_CI} IS NOT NULL THEN NULL
                  ELSE concat(x, ' is not in field mapping or valid value set') END)) AS t FROM s),
u AS (SELECT p_partkey, list_filter(t, lambda e: e.r IS NOT NULL)[1].r AS tr,
        list_filter(list_transform(t, lambda e: e.v), lambda v: v IS NOT NULL) AS vals FROM t),
w AS (SELECT p_partkey, tr, vals,
        CASE WHEN len(list_filter(vals, lambda v: v < 1 OR v > 6)) > 0
             THEN 'types must be within the range [1, 6]' END AS cr FROM u)
SELECT p_partkey,
  CASE WHEN tr IS NULL AND cr IS NULL AND len(vals) > 0 THEN array_to_string(vals, ',') END AS value,
  coalesce(tr, cr) AS reason
FROM w""")
def f18_multi(spark, sf_dir):
    d = dirty_parts(spark, sf_dir)
    arr = split_values(F.col("types_raw"), ";")
    v, r = cells.conform_multi(arr, TYPES_FIELD)
    return d.select("p_partkey", join_values(v).alias("value"), r.alias("reason"))


# dispatch through the staged projection used by the process job ------------------------
DISPATCH_FIELDS = (PRIORITY_INT, BOOL_FIELD, SOC_FIELD, STATE_FIELD, PRICE_FIELD, DATE_FIELD, QTY_BOTH)
DISPATCH_SOURCES = {"priority": "priority_raw", "flag": "bool_raw", "SOC": "soc_raw", "State": "state_raw",
                    "price": "price_raw", "when": "date_raw", "qty": "num_raw"}


def _oracle_body(sql: str, field: str) -> str:
    return f"SELECT o_orderkey, '{field}' AS field, CAST(value AS VARCHAR) AS value, reason FROM ({sql}) t_{field}"


def _dispatch_sql() -> str:
    from trueform.workloads.registry import ORACLE
    qty = f"""{_INT_T}
SELECT o_orderkey, CASE WHEN NOT blank AND tv BETWEEN 0 AND 100 THEN tv END AS value,
  CASE WHEN blank THEN NULL WHEN tv IS NULL THEN concat(num_raw, ' is not an integer')
       WHEN tv < 0 OR tv > 100 THEN 'qty must be within the range [0, 100]' END AS reason FROM t"""
    parts = [_oracle_body(ORACLE["f17_reason"], "priority"), _oracle_body(ORACLE["f12_bool_cast"], "flag"),
             _oracle_body(ORACLE["f15_pattern"], "SOC"), _oracle_body(ORACLE["f8_lookup"], "State"),
             _oracle_body(ORACLE["f10_number"], "price"), _oracle_body(ORACLE["f11_date"], "when"),
             _oracle_body(qty, "qty")]
    return "\nUNION ALL\n".join(parts)


@register("f20_dispatch", _dispatch_sql())
def f20_dispatch(spark, sf_dir):
    """F19-F21 through the process job's staged projection: every type at once, long output."""
    from trueform.operators.process import conform_columns
    d = dirty_orders(spark, sf_dir).select(
        "o_orderkey", *[F.col(src).alias(dst) for dst, src in DISPATCH_SOURCES.items()])
    lookups = {"priority": PRIORITY_INT_MAPPING, "flag": BOOL_MAPPING}
    out = conform_columns(d, d.columns, list(DISPATCH_FIELDS), set(), lookups)
    recs = F.array(*[F.struct(F.lit(f.name).alias("field"), F.col(f"__v_{f.name}").cast("string").alias("value"),
                              F.col(f"__r_{f.name}").alias("reason")) for f in DISPATCH_FIELDS])
    return out.select("o_orderkey", F.explode(recs).alias("r")).select("o_orderkey", "r.*")


# F6, F18 with a mapping of one entry per customer: joined, not held as a literal ------------------
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# some customers are unmapped, some map to blank, in the mapping and its oracle alike
CUSTOMER_MAP_SQL = """SELECT concat('Customer#', CAST(c_custkey AS STRING)) AS input,
  CASE WHEN c_custkey % 14 = 0 THEN '' ELSE c_mktsegment END AS output FROM customer WHERE c_custkey % 11 <> 0"""


def customer_mapping(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_custkey % 11 <> 0")
    return c.selectExpr(f"'{field}' AS field", "concat('Customer#', CAST(c_custkey AS STRING)) AS input",
                        "CASE WHEN c_custkey % 14 = 0 THEN '' ELSE c_mktsegment END AS output", "'Yes' AS approved")


@register("f6_mapped_large", f"""WITH m AS ({CUSTOMER_MAP_SQL})
SELECT o_orderkey, nullif(output, '') AS segment
FROM orders LEFT JOIN m ON input = concat('Customer#', CAST(o_custkey AS STRING))""")
def f6_mapped_large(spark, sf_dir):
    """F6 through the process job: a mapping as long as the customer table."""
    from trueform.operators.process import process
    d = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "concat('Customer#', CAST(o_custkey AS STRING)) AS segment")
    spec = TableSpec(fields=(FieldSpec("segment", enum=SEGMENTS),))
    return process(d, spec, customer_mapping(spark, sf_dir, "segment"), materialize=None).conformed


@register("f18_mapped_large", f"""WITH m AS ({CUSTOMER_MAP_SQL})
SELECT o_orderkey, CASE WHEN a.input IS NOT NULL AND b.input IS NOT NULL
  THEN nullif(concat_ws(',', nullif(a.output, ''), nullif(b.output, '')), '') END AS segments
FROM orders LEFT JOIN m a ON a.input = concat('Customer#', CAST(o_custkey AS STRING))
LEFT JOIN m b ON b.input = concat('Customer#', CAST(o_custkey + 1 AS STRING))""")
def f18_mapped_large(spark, sf_dir):
    """F18 through the process job: lists of two customers, each element mapped by the join."""
    from trueform.operators.process import process
    d = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "array(concat('Customer#', CAST(o_custkey AS STRING)), concat('Customer#', CAST(o_custkey + 1 AS STRING))) AS segments")
    spec = TableSpec(fields=(FieldSpec("segments", enum=SEGMENTS, allows_multiple=True),))
    out = process(d, spec, customer_mapping(spark, sf_dir, "segments"), materialize=None).conformed
    return out.select("o_orderkey", join_values(F.col("segments")).alias("segments"))


REPEATS_SQL = f"""WITH m AS ({CUSTOMER_MAP_SQL})
SELECT o_orderkey, nullif(output, '') AS segment,
  CASE WHEN o_orderpriority <> '5-LOW' THEN concat('P', substr(o_orderpriority, 1, 1)) ELSE 'P0' END AS priority
FROM orders LEFT JOIN m ON input = concat('Customer#', CAST(o_custkey AS STRING))"""


@register("f6_mapped_repeats", REPEATS_SQL)
def f6_mapped_repeats(spark, sf_dir):
    """E1 + F6 through the process job: inputs that repeat, in a long mapping (joined) and a short one (literal); the later row wins."""
    from trueform.operators.process import process
    d = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "concat('Customer#', CAST(o_custkey AS STRING)) AS segment", "o_orderpriority AS priority")
    spec = TableSpec(fields=(FieldSpec("segment", enum=SEGMENTS), FieldSpec("priority", enum=("P0", "P1", "P2", "P3", "P4", "P5"))))
    right = customer_mapping(spark, sf_dir, "segment")
    first = right.withColumn("output", F.lit(SEGMENTS[0]))
    short = (table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("input")).distinct()
             .select(F.lit("priority").alias("field"), "input", F.explode(F.array(*[F.struct(F.lit(n).alias("position"), o.alias("output")) for n, o in (
                 (1, F.lit("P0")), (2, F.when(F.col("input") != "5-LOW", F.concat(F.lit("P"), F.substring("input", 1, 1))).otherwise(F.lit("P0"))))])).alias("w"))
             .select("field", "input", "w.output", F.lit("Yes").alias("approved"), "w.position"))
    maps = right.withColumn("position", F.lit(2)).unionByName(first.withColumn("position", F.lit(1))).unionByName(short)
    return process(d, spec, maps, materialize=None).conformed
