"""Single-cell conformance as native Column expressions.

Every builder takes a string Column holding the raw cell text and returns
``(value, reason)`` Columns; a null ``reason`` means the cell is valid. Nothing
here runs Python per row: the whole library compiles to Catalyst expressions,
so it stays inside whole-stage codegen (higher-order functions excepted, which
only multi-value cells use).
"""

from __future__ import annotations

import math
import re
from decimal import Decimal
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from trueform.functions.dates import lenient_date, lenient_date_sql, token_date
from trueform.functions.states import state_code
from trueform.plans.spec import FieldSpec

# Whitespace stripped by "blank" tests and by shape.
WHITESPACE = " \t\n\r\f\v"

# Text accepted as a float: decimal or scientific digits, inf/infinity, nan.
NUMERIC_PATTERN = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)

# Text a decimal cast can read (checked first: failed casts are expensive).
DECIMAL_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

NOT_MAPPED = " is not in field mapping or valid value set"

Pair = tuple[Column, Column]


def _null(dtype: str = "string") -> Column:
    return F.lit(None).cast(dtype)


# -- F1-F3: tests ----------------------------------------------------------------

def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """null or whitespace-only text (only text that sorts before ``!`` is stripped)."""
    return c.isNull() | ((c.cast("string") < F.lit("!")) & (strip(c) == F.lit("")))


def as_double(c: Column) -> Column:
    """Float value of text that Python's ``float()`` accepts, else null."""
    return F.when(c.rlike(NUMERIC_PATTERN), strip(c).try_cast("double"))


def is_num(c: Column) -> Column:
    """float-parsable text (nan and inf included)."""
    return c.rlike(NUMERIC_PATTERN)


def _whole_sql(name: str) -> str:
    n = "`" + name.replace("`", "``") + "`"
    return (f"coalesce(NOT isnan({n}) AND abs({n}) < CAST('Infinity' AS DOUBLE) "
            f"AND rint({n}) = {n}, false)")


def is_int(c: Column, d: Column | str | None = None) -> Column:
    """float-parsable and whole; nan and inf are not whole.

    ``d`` may carry an already computed :func:`as_double` of ``c``, as a Column
    or as the name of a staged column (then one parsed expression).
    """
    if isinstance(d, str):
        return F.expr(_whole_sql(d))
    d = as_double(c) if d is None else d
    return F.coalesce(
        ~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))) & (F.rint(d) == d),
        F.lit(False),
    )


def int_value(c: Column, d: Column | str | None = None) -> Column:
    """Whole-number text to bigint (``3``, ``3.0``, `` 3 ``); null otherwise."""
    if isinstance(d, str):
        n = "`" + d.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN {_whole_sql(d)} THEN try_cast({n} AS BIGINT) END")
    d = as_double(c) if d is None else d
    return F.when(is_int(c, d), d.try_cast("bigint"))


# -- value-mapping lookups -------------------------------------------------------------

class Lookup:
    """Exact-text lookup of raw values in one field's approved mapping."""

    def hit(self, key: Column) -> Column:  # pragma: no cover - interface
        raise NotImplementedError

    def out(self, key: Column) -> Column:  # pragma: no cover - interface
        raise NotImplementedError


class NoLookup(Lookup):
    def hit(self, key):
        return F.lit(False)

    def out(self, key):
        return _null()


class MapLookup(Lookup):
    """Mapping held as a literal ``map<input, output>`` (small mappings).

    The map expression is built on first use, so lookups can be declared
    before a session exists.
    """

    def __init__(self, pairs: dict[str, str | None]):
        self.pairs = {k: v for k, v in pairs.items() if k is not None}
        self._map = None

    @property
    def map(self) -> Column | None:
        if self._map is None and self.pairs:
            kv = []
            for k, v in self.pairs.items():
                kv += [F.lit(k), F.lit(v).cast("string")]
            self._map = F.create_map(*kv)
        return self._map

    def hit(self, key):
        if not self.pairs:
            return F.lit(False)
        return F.coalesce(F.map_contains_key(self.map, key), F.lit(False))

    def out(self, key):
        if not self.pairs:
            return _null()
        return F.try_element_at(self.map, key)


class ColumnLookup(Lookup):
    """Mapping already joined beside the row (large mappings, scalar fields)."""

    def __init__(self, hit_col: Column, out_col: Column):
        self._hit, self._out = hit_col, out_col

    def hit(self, key):
        return self._hit

    def out(self, key):
        return self._out


class CellLookup(Lookup):
    """Mapping entries of a multi-value cell's own elements, joined beside the row."""

    def __init__(self, entries: Column):
        self._entries = entries

    def hit(self, key):
        return F.coalesce(F.map_contains_key(self._entries, key), F.lit(False))

    def out(self, key):
        return F.try_element_at(self._entries, key)


def sql_literal(v) -> str:
    """A Spark SQL literal for a string / int / None."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


_MAP_CACHE: dict[tuple, Column] = {}


def _literal_map(pairs: list[tuple[str, object]]) -> Column:
    """A constant map built by one parsed SQL expression (memoised per session)."""
    from pyspark import SparkContext
    key = (id(SparkContext._active_spark_context), tuple(pairs))
    got = _MAP_CACHE.get(key)
    if got is None:
        body = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in pairs)
        got = F.expr(f"map({body})")
        _MAP_CACHE[key] = got
    return got


def _first_by_lower(options: list[tuple[str, object]]) -> list[tuple[str, object]]:
    seen: dict[str, object] = {}
    for k, v in options:
        seen.setdefault(k.lower(), v)
    return list(seen.items())


def _last_by_lower(labels: list[tuple[str, object]]) -> list[tuple[str, object]]:
    """Labels that differ only in case: the last one's code holds."""
    return list({k.lower(): v for k, v in labels}.items())


def mapping_key(field: FieldSpec, v: Column, d: Column | str | None = None) -> Column:
    """Text used to look a raw value up in the field's mapping.

    Booleans normalise whole numbers first (``1.0`` -> ``1``).
    """
    if field.type == "boolean":
        return F.coalesce(int_value(v, d).cast("string"), v)
    return v


# -- F4-F9: transforms ------------------------------------------------------------

def transform_enum(v: Column, field: FieldSpec, lookup: Lookup, d: Column | str | None = None) -> Pair:
    """F4 boolean / F5 integer enum / F6 string enum."""
    key = mapping_key(field, v, d)
    unmapped = isinstance(lookup, NoLookup) or (isinstance(lookup, MapLookup) and not lookup.pairs)
    if unmapped:  # no mapping for the field: the mapping branches are constant false
        if field.enum_mapping is not None:
            ci = _literal_map(_last_by_lower(list(field.enum_mapping)))
            whole = int_value(v, d)
            ci_code = F.try_element_at(ci, F.lower(v))
            return (F.coalesce(whole, ci_code),
                    F.when(whole.isNull() & ci_code.isNull(), F.concat(v, F.lit(NOT_MAPPED))))
        options = field.options
        ci = _literal_map(_first_by_lower([(o, o) for o in options]))
        ci_val = F.try_element_at(ci, F.lower(key))
        msg = F.concat(key, F.lit(NOT_MAPPED))
        if field.type == "boolean":
            msg = F.concat(msg, F.lit(f" ({options!r})"))
        return ci_val, F.when(ci_val.isNull(), msg)
    hit, out = lookup.hit(key), lookup.out(key)
    mapped_blank = hit & is_blank(out)
    if field.enum_mapping is not None:
        exact = _literal_map(list(dict(field.enum_mapping).items()))
        ci = _literal_map(_last_by_lower(list(field.enum_mapping)))
        whole = int_value(v, d)
        mapped_code = F.try_element_at(exact, out)
        ci_code = F.try_element_at(ci, F.lower(v))
        value = (F.when(whole.isNotNull(), whole)
                 .when(mapped_blank, _null("bigint"))
                 .when(hit, mapped_code)
                 .otherwise(ci_code))
        bad = (F.when(whole.isNotNull() | mapped_blank, F.lit(False))
               .when(hit, mapped_code.isNull())
               .otherwise(ci_code.isNull()))
        return value, F.when(bad, F.concat(v, F.lit(NOT_MAPPED)))
    options = field.options
    ci = _literal_map(_first_by_lower([(o, o) for o in options]))
    ci_val = F.try_element_at(ci, F.lower(key))
    value = F.when(mapped_blank, _null()).when(hit, out).otherwise(ci_val)
    bad = F.when(hit, F.lit(False)).otherwise(ci_val.isNull())
    msg = F.concat(key, F.lit(NOT_MAPPED))
    if field.type == "boolean":
        msg = F.concat(msg, F.lit(f" ({options!r})"))
    return value, F.when(bad, msg)


def transform_prefix(v: Column) -> Pair:
    """strip, keep the text before the first '.'."""
    return F.split_part(strip(v), F.lit("."), F.lit(1)), _null()


def transform_state(v: Column) -> Pair:
    """F8: state name, abbreviation, FIPS code or near spelling -> 2-letter code."""
    code = state_code(strip(v))
    return code, F.when(code.isNull(), F.concat(v, F.lit(" is not a valid state")))


def transform_int(v: Column, d: Column | str | None = None) -> Pair:
    """whole number -> bigint, else reason."""
    val = int_value(v, d)
    return val, F.when(val.isNull(), F.concat(v, F.lit(" is not an integer")))


def needs_number(field: FieldSpec) -> bool:
    """Fields whose transform reads the text as a float."""
    return field.enum_mapping is not None or field.type in ("integer", "boolean")


def transform_named(name: str, field: FieldSpec, lookup: Lookup | None, d_name: str | None) -> Pair | None:
    """:func:`transform` of a named column as two parsed SQL expressions.

    Covers the common unmapped enum / boolean / integer cases (one round trip
    each instead of dozens); anything else falls back to the Column builders.
    """
    unmapped = lookup is None or isinstance(lookup, NoLookup) or (isinstance(lookup, MapLookup) and not lookup.pairs)
    v = "`" + name.replace("`", "``") + "`"
    if not unmapped or field.transform is not None or (needs_number(field) and d_name is None):
        return transform(F.col(name), field, lookup or NoLookup(), d_name)
    iv = None
    if d_name is not None:
        d = "`" + d_name.replace("`", "``") + "`"
        iv = f"(CASE WHEN {_whole_sql(d_name)} THEN try_cast({d} AS BIGINT) END)"
    miss = sql_literal(NOT_MAPPED)

    def smap(pairs):
        return "map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(x)}" for k, x in pairs) + ")"

    if field.enum_mapping is not None:
        ci = f"try_element_at({smap(_last_by_lower(list(field.enum_mapping)))}, lower({v}))"
        value = f"coalesce({iv}, {ci})"
        reason = f"CASE WHEN {iv} IS NULL AND {ci} IS NULL THEN concat({v}, {miss}) END"
    elif field.type == "boolean":
        key = f"coalesce(CAST({iv} AS STRING), {v})"
        opts = field.options
        ci = f"try_element_at({smap(_first_by_lower([(o, o) for o in opts]))}, lower({key}))"
        value = ci
        reason = f"CASE WHEN {ci} IS NULL THEN concat({key}, {miss}, {sql_literal(f' ({opts!r})')}) END"
    elif field.enum is not None:
        ci = f"try_element_at({smap(_first_by_lower([(o, o) for o in field.enum]))}, lower({v}))"
        value = ci
        reason = f"CASE WHEN {ci} IS NULL THEN concat({v}, {miss}) END"
    elif field.type == "integer":
        value = iv
        reason = f"CASE WHEN {iv} IS NULL THEN concat({v}, ' is not an integer') END"
    else:
        return transform(F.col(name), field, lookup or NoLookup(), d_name)
    return F.expr(value), F.expr(reason)


def has_transform(field: FieldSpec) -> bool:
    """Whether :func:`transform` has a transform phase for the field."""
    return (field.is_enum or field.type in ("boolean", "integer")
            or field.transform in ("prefix", "state"))


def transform(v: Column, field: FieldSpec, lookup: Lookup, d: Column | str | None = None) -> Pair | None:
    """F20 transform-phase dispatch; None when the field has no transform."""
    if field.is_enum or field.type == "boolean":
        return transform_enum(v, field, lookup, d)
    if field.transform == "prefix":
        return transform_prefix(v)
    if field.transform == "state":
        return transform_state(v)
    if field.type == "integer":
        return transform_int(v, d)
    return None


# -- F10-F17: casts and constraints -----------------------------------------------

def _bound_literal(x, field: FieldSpec) -> Column:
    if field.type == "number":
        return F.lit(Decimal(str(x))).cast("decimal(18,6)")
    return F.lit(x)


def _range_text(field: FieldSpec) -> Column:
    lo, hi = field.minimum, field.maximum
    if lo is not None and hi is not None:
        return F.lit(f"{field.name} must be within the range [{lo}, {hi}]")
    if hi is not None:
        return F.lit(f"{field.name} must be less than or equal to {hi}")
    return F.lit(f"{field.name} must be greater than or equal to {lo}")


def range_reason(value: Column, field: FieldSpec) -> Column:
    """range constraint with the three message forms."""
    lo, hi = field.minimum, field.maximum
    if lo is None and hi is None:
        return _null()
    if lo is not None and hi is not None:
        bad = (value < _bound_literal(lo, field)) | (value > _bound_literal(hi, field))
    elif hi is not None:
        bad = value > _bound_literal(hi, field)
    else:
        bad = value < _bound_literal(lo, field)
    return F.when(bad, _range_text(field))


def cast_number(x: Column, field: FieldSpec) -> Column:
    """decimal(18,6), group separators removed; digits beyond six places make the value invalid."""
    text = strip(x)
    if field.group_char:
        text = F.replace(text, F.lit(field.group_char), F.lit(""))
    wide, exact = text.try_cast("decimal(38,18)"), text.try_cast("decimal(18,6)")
    return F.when(text.rlike(DECIMAL_PATTERN) & ~text.rlike(r"\.\d{18}\d*[1-9]") & (wide == exact), exact)


def cast_boolean(x: Column, field: FieldSpec) -> Column:
    """canonical token -> boolean."""
    return (F.when(strip(x).isin(*field.true_values), F.lit(True))
            .when(strip(x).isin(*field.false_values), F.lit(False)))


def _constraint_reason(x: Column, field: FieldSpec, generic: Column) -> Column:
    """Enum and pattern constraints on strings; F17 wording."""
    checks = []
    if field.enum is not None:
        checks.append(~x.isin(*field.enum))
    if field.pattern is not None:
        checks.append(~x.rlike(f"^(?:{field.pattern})$"))
    if not checks:
        return _null()
    bad = checks[0]
    for c in checks[1:]:
        bad = bad | c
    if field.pattern_hint:
        return F.when(bad, F.lit(f"{field.name} should be in the format {field.pattern_hint}"))
    return F.when(bad, generic)


def cast_named(name: str, field: FieldSpec) -> Pair:
    """:func:`cast` of a named (staged) column; dates parse as one SQL expression."""
    x = F.col(name)
    if field.type == "date":  # no layout reads text without a digit
        val = F.when(x.rlike("[0-9]"), F.coalesce(F.expr(lenient_date_sql(name)), token_date(x)))
        return val, F.when(val.isNull(), F.concat(x, F.lit(" is not a valid date")))
    return cast(x, field)


def cast(x: Column, field: FieldSpec) -> Pair:
    """Cast phase on a non-blank value; returns (typed value, reason)."""
    t = field.type
    if t == "integer":
        val = x.cast("bigint")
        return val, range_reason(val, field)
    if t == "number":
        val = cast_number(x, field)
        reason = F.when(val.isNull(), F.concat(x, F.lit(" is not a valid number"))) \
            .otherwise(range_reason(val, field))
        return val, reason
    if t == "date":
        val = lenient_date(x)
        return val, F.when(val.isNull(), F.concat(x, F.lit(" is not a valid date")))
    if t == "boolean":
        val = cast_boolean(x, field)
        return val, F.when(val.isNull(), F.concat(x, F.lit(" is not a valid boolean")))
    val = x.cast("string")
    return val, _constraint_reason(val, field, F.concat(val, F.lit(" is not a valid string")))


def blank_after_transform(x: Column, field: FieldSpec, transformed: bool) -> Column:
    if transformed and (field.type == "integer"):
        return x.isNull()
    return is_blank(x)


def conform_scalar(v: Column, field: FieldSpec, lookup: Lookup | None = None) -> Pair:
    """F20 + F21 on one non-blank text: transform, then cast; first reason wins."""
    lookup = lookup or NoLookup()
    tr = transform(v, field, lookup)
    if tr is None:
        x, t_reason = v, _null()
    else:
        x, t_reason = tr
    x_blank = blank_after_transform(x, field, tr is not None)
    c_val, c_reason = cast(x, field)
    reason = F.coalesce(t_reason, F.when(~x_blank, c_reason))
    value = F.when(reason.isNull() & ~x_blank, c_val)
    return value, reason


def conform_cell(raw: Column, field: FieldSpec, lookup: Lookup | None = None) -> Pair:
    """blank short-circuit around :func:`conform_scalar` (single-value fields)."""
    value, reason = conform_scalar(raw, field, lookup)
    blank = is_blank(raw)
    return F.when(~blank, value), F.when(~blank, reason)


def conform_multi(raw: Column, field: FieldSpec, lookup: Lookup | None = None,
                  raw_is_array: bool = True) -> Pair:
    """apply the field's functions to every element of a multi-value cell.

    Any invalid element voids the cell, reported with the first transform-phase
    reason (else the first cast-phase reason); blank elements are dropped; an
    empty result is null. A non-array cell is invalid.
    """
    lookup = lookup or NoLookup()
    if not raw_is_array:
        return _null(), F.when(~is_blank(raw), F.concat(raw, F.lit(" is not a list")))

    def t_elem(x):
        tr = transform(x, field, lookup)
        if tr is None:
            tv, tr_reason = x, _null()
        else:
            tv, tr_reason = tr
        blank = is_blank(x)
        return F.struct(F.when(~blank, tv.cast("string")).alias("v"),
                        F.when(~blank, tr_reason).alias("r"))

    t = F.transform(raw, t_elem)
    t_reason = F.try_element_at(F.filter(t, lambda e: e["r"].isNotNull()), F.lit(1))["r"]
    kept = F.filter(F.transform(t, lambda e: e["v"]), lambda x: ~is_blank(x))

    transformed = has_transform(field)

    def c_elem(x):
        xv = x.cast("bigint") if (transformed and field.type == "integer") else x
        cv, cr = cast(xv, field)
        return F.struct(cv.alias("v"), cr.alias("r"))

    c = F.transform(kept, c_elem)
    c_reason = F.try_element_at(F.filter(c, lambda e: e["r"].isNotNull()), F.lit(1))["r"]
    reason = F.coalesce(t_reason, c_reason)
    vals = F.transform(c, lambda e: e["v"])
    value = F.when(reason.isNull() & (F.size(vals) > 0), vals)
    return F.when(raw.isNotNull(), value), F.when(raw.isNotNull(), reason)


# -- staged multi-value pieces (used by the process job) ----------------------------------

def multi_parse(raw: Column, field: FieldSpec) -> Column:
    """Stage 1: every element with its float view, parsed once."""
    if needs_number(field):
        return F.transform(raw, lambda x: F.struct(x.alias("x"), as_double(x).alias("d")))
    return F.transform(raw, lambda x: F.struct(x.alias("x"), F.lit(None).cast("double").alias("d")))


def multi_transform(parsed: Column, field: FieldSpec, lookup: Lookup | None = None) -> Column:
    """Stage 2: transform phase per element -> array<struct<v, r>> (blank elements empty)."""
    lookup = lookup or NoLookup()

    def one(e):
        x = e["x"]
        tr = transform(x, field, lookup, e["d"] if needs_number(field) else None)
        tv, trr = (x, _null()) if tr is None else tr
        blank = is_blank(x)
        return F.struct(F.when(~blank, tv.cast("string")).alias("v"), F.when(~blank, trr).alias("r"))

    return F.transform(parsed, one)


def first_reason(arr: Column) -> Column:
    return F.try_element_at(F.filter(arr, lambda e: e["r"].isNotNull()), F.lit(1))["r"]


def multi_cast(transformed: Column, field: FieldSpec) -> Column:
    """Stage 3: cast phase on the kept (non-blank) transformed elements."""
    kept = F.filter(F.transform(transformed, lambda e: e["v"]), lambda x: ~is_blank(x))
    as_int = has_transform(field) and field.type == "integer"

    def one(x):
        cv, cr = cast(x.cast("bigint") if as_int else x, field)
        return F.struct(cv.alias("v"), cr.alias("r"))

    return F.transform(kept, one)


def multi_final(raw: Column, t_reason: Column, casted: Column) -> Pair:
    """Stage 4: first transform reason, else first cast reason; empty -> null."""
    reason = F.coalesce(t_reason, first_reason(casted))
    vals = F.transform(casted, lambda e: e["v"])
    value = F.when(reason.isNull() & (F.size(vals) > 0), vals)
    return F.when(raw.isNotNull(), value), F.when(raw.isNotNull(), reason)


# -- direct cells (used by the process job) -------------------------------------------------

# Fields without a mapping whose value follows from one staged result: the code, token, decimal
# or date of the text, null if there is none. Text that starts with a letter cannot be a whole
# number, and the usual spellings are looked up before a pattern is tried, so most cells meet no
# regular expression. The reason is made from the raw text, and only where it is read.

# Whole numbers that a double holds exactly, as plain digits.
_WHOLE_PATTERN = r"^\s*[+-]?\d{1,15}(\.0*)?\s*$"
_DECIMAL_SHORT = r"^[+-]?\d{1,12}(\.\d{0,6})?$"


def _name_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _blank_sql(x: str) -> str:
    return f"({x} IS NULL OR ({x} < '!' AND btrim({x}, {sql_literal(WHITESPACE)}) = ''))"


def _int_sql(x: str) -> str:
    """:func:`int_value` of the text ``x`` (``inf`` and ``nan`` are not whole); one digit needs no pattern."""
    d = f"try_cast(btrim({x}, {sql_literal(WHITESPACE)}) AS DOUBLE)"
    return (f"CASE WHEN {x} >= ':' OR {x} < '\\t' THEN NULL WHEN {x} >= '0' AND length({x}) = 1 THEN CAST(ascii({x}) - 48 AS BIGINT) "
            f"WHEN {x} RLIKE {sql_literal(_WHOLE_PATTERN)} THEN try_cast({d} AS BIGINT) "
            f"WHEN {x} RLIKE {sql_literal(NUMERIC_PATTERN)} AND abs({d}) < CAST('Infinity' AS DOUBLE) AND rint({d}) = {d} THEN try_cast({d} AS BIGINT) END")


def _reads_as_number(text: str) -> bool:
    return re.match(NUMERIC_PATTERN, text, re.ASCII) is not None


def _lookup_sql(x: str, options: list[tuple[str, object]], number: str) -> str:
    """Outcome of the option that text ``x`` spells in any case, else ``number``, made of text that may be a number."""
    low, high = [(k, v) for k, v in options if k < ":"], [(k, v) for k, v in options if k >= ":"]
    at = lambda pairs: f"try_element_at(map({', '.join(f'{sql_literal(k)}, {sql_literal(v)}' for k, v in pairs)}), lower({x}))"
    return f"CASE WHEN {x} >= ':' THEN {at(high) if high else 'NULL'} ELSE {f'coalesce({at(low)}, {number})' if low else number} END"


def _code_sql(x: str, field: FieldSpec) -> str:
    """Code of an integer or an integer enum's text; null if it has none."""
    return _lookup_sql(x, _last_by_lower(list(field.enum_mapping)), _int_sql(x)) if field.enum_mapping else _int_sql(x)


def _bool_sql(x: str, field: FieldSpec) -> str:
    """Boolean of a token; whole numbers are normalised first (``1.0`` reads ``1``)."""
    tokens = [(k, o.strip(WHITESPACE) in field.true_values) for k, o in _first_by_lower([(o, o) for o in field.options])]
    whole = [(f"{int(k)}L", str(v).lower()) for k, v in tokens if k.isdigit()]
    number = f"CASE {_int_sql(x)} {' '.join(f'WHEN {k} THEN {v}' for k, v in whole)} END" if whole else "CAST(NULL AS BOOLEAN)"
    return _lookup_sql(x, [(k, v) for k, v in tokens if not k.isdigit()], number)


def _range_sql(t: str, field: FieldSpec, low: str | None = None) -> str | None:
    """``t`` is within the field's range; ``low`` stands for ``t`` at the lower bound."""
    bound = lambda b: f"CAST('{Decimal(str(b))}' AS DECIMAL(18,6))" if field.type == "number" else f"{b}L" if type(b) is int else f"{b!r}D"
    tests = [f"{v} {op} {bound(b)}" for v, op, b in ((low or t, ">=", field.minimum), (t, "<=", field.maximum)) if b is not None]
    return " AND ".join(tests) or None


def _void_code(field: FieldSpec) -> int:
    """A code outside the field's range."""
    return math.floor(field.maximum) + 1 if field.maximum is not None else math.ceil(field.minimum) - 1


def direct(field: FieldSpec, lookup: Lookup | None, dtype: str) -> bool:
    """Whether :func:`direct_stage` and :func:`direct_final` conform the field read from a column of type ``dtype``."""
    if not (lookup is None or isinstance(lookup, NoLookup) or (isinstance(lookup, MapLookup) and not lookup.pairs)):
        return False
    if dtype != ("array<string>" if field.allows_multiple else "string") or field.transform is not None or field.pattern is not None:
        return False
    if field.type != "integer" and field.enum_mapping is not None or field.type != "string" and field.enum is not None:
        return False
    if any(b is not None and (type(b) not in (int, float) or not abs(b) < 2 ** 53) for b in (field.minimum, field.maximum)):
        return False
    texts = field.options
    canonical = lambda o: field.type == "boolean" and o.isdigit() and o == str(int(o))
    if any(not o.strip() or (_reads_as_number(o) and not canonical(o)) for o in texts):
        return False  # blank or number-like options: the general form knows their order
    if field.type == "boolean" and not (texts and {o.strip(WHITESPACE) for o in texts} <= {*field.true_values, *field.false_values}):
        return False
    if field.type == "number" and field.group_char and not "\t" <= field.group_char < ":":
        return False
    if field.allows_multiple:
        return field.type == "integer" and not (field.minimum is None and field.maximum is None)
    return True


def direct_stage(name: str, field: FieldSpec) -> Column | None:
    """Stage 2 of a direct cell; None where the text itself is the value."""
    x = _name_sql(name)
    if field.allows_multiple:  # an element without a code voids the cell as one out of range does
        return F.expr(f"transform({x}, x -> CASE WHEN NOT {_blank_sql('x')} THEN coalesce({_code_sql('x', field)}, {_void_code(field)}L) END)")
    if field.type == "integer":
        return F.expr(_code_sql(x, field))
    if field.type == "boolean":
        return F.expr(_bool_sql(x, field))
    if field.enum is not None:
        return F.expr(_lookup_sql(x, _first_by_lower([(o, o) for o in field.enum]), "CAST(NULL AS STRING)"))
    if field.type == "number":
        text = f"CASE WHEN {x} >= '!' AND substring({x}, -1, 1) >= '!' THEN {x} ELSE btrim({x}, {sql_literal(WHITESPACE)}) END"
        if field.group_char:
            text = f"replace({text}, {sql_literal(field.group_char)}, '')"
        short = f"CASE WHEN {text} RLIKE {sql_literal(_DECIMAL_SHORT)} THEN try_cast({text} AS DECIMAL(18,6)) END"
        return F.when((F.col(name) < ":") & (F.col(name) >= "\t"), F.coalesce(F.expr(short), cast_number(F.col(name), field)))
    if field.type == "date":
        return cast_named(name, field)[0]
    return None


def direct_final(name: str, staged: str, field: FieldSpec) -> Pair:
    """Stage 4 of a direct cell: value and reason from the text and its staged result."""
    x, t = _name_sql(name), _name_sql(staged)
    if field.allows_multiple:
        ok = _range_sql(f"array_max({t})", field, f"array_min({t})")
        bad = f"try_element_at(filter({x}, x -> NOT {_blank_sql('x')} AND {_code_sql('x', field)} IS NULL), 1)"
        wrong = NOT_MAPPED if field.enum_mapping is not None else " is not an integer"
        return (F.expr(f"CASE WHEN {ok} THEN filter({t}, c -> c IS NOT NULL) END"),
                F.when(F.expr(f"NOT ({ok})"), F.coalesce(F.expr(f"concat({bad}, {sql_literal(wrong)})"), _range_text(field))))
    if field.type == "string" and field.enum is None:
        return F.expr(f"CASE WHEN NOT {_blank_sql(x)} THEN {x} END"), _null()
    shown = x
    if field.enum_mapping is not None or field.enum is not None:
        wrong = NOT_MAPPED
    elif field.type == "boolean":
        shown, wrong = f"coalesce(CAST({_int_sql(x)} AS STRING), {x})", f"{NOT_MAPPED} ({field.options!r})"
    else:
        wrong = {"integer": " is not an integer", "number": " is not a valid number", "date": " is not a valid date"}[field.type]
    reason = F.expr(f"CASE WHEN {t} IS NULL AND NOT {_blank_sql(x)} THEN concat({shown}, {sql_literal(wrong)}) END")
    ok = _range_sql(t, field) if field.type in ("integer", "number") else None
    if ok is None:
        return F.col(staged), reason
    return F.expr(f"CASE WHEN {ok} THEN {t} END"), F.coalesce(reason, F.when(F.expr(f"NOT ({ok})"), _range_text(field)))


def original_text(raw: Column, is_array: bool) -> Column:
    """Raw cell as report text; lists render as ``['a', 'b']``."""
    if not is_array:
        return raw.cast("string")
    inner = F.array_join(F.transform(raw, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
    return F.when(raw.isNotNull(), F.concat(F.lit("["), inner, F.lit("]")))


def conform_column(raw: Column, field: FieldSpec, lookup: Lookup | None = None,
                   raw_is_array: bool | None = None) -> Pair:
    """dispatch a column by spec (multi-value or single)."""
    if field.allows_multiple:
        return conform_multi(raw, field, lookup, raw_is_array if raw_is_array is not None else True)
    return conform_cell(raw, field, lookup)


FieldFn = Callable[[Column], Pair]
