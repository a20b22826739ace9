"""Target spec.

A spec is a Table-Schema style descriptor: a list of typed fields with
constraints, plus four extension keys (``allows_multiple``, ``enum_mapping``,
``milestones``, ``custom_milestone_field_names``) and the top-level
``column_based_milestone_names``. It is schema-sized, so it lives on the driver
as dataclasses; ``spec_frame``/``options_frame``/``column_names_frame`` expose it
as small DataFrames for the operators that join to it.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field as dc_field
from typing import Any, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Boolean tokens used by the rebuilt target spec.
DEFAULT_TRUE_VALUES = ("yes", "Y", "true", "T", "1")
DEFAULT_FALSE_VALUES = ("no", "N", "false", "F", "2")

SPEC_DIR = os.path.join(os.path.dirname(__file__), "specs")
MISSION_IMPACT_SPEC = os.path.join(SPEC_DIR, "mission_impact.json")

_SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "number": T.DecimalType(18, 6),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "string"  # string | integer | number | boolean | date
    required: bool = False
    enum: tuple[str, ...] | None = None  # string enum: canonical spellings
    enum_mapping: tuple[tuple[str, int], ...] | None = None  # integer enum: label -> code
    minimum: Any = None
    maximum: Any = None
    pattern: str | None = None
    pattern_hint: str | None = None  # text used in the pattern failure reason
    allows_multiple: bool = False
    milestones: tuple[int, ...] | None = None  # None = admin field
    custom_names: tuple[tuple[int, str], ...] = ()
    true_values: tuple[str, ...] = DEFAULT_TRUE_VALUES
    false_values: tuple[str, ...] = DEFAULT_FALSE_VALUES
    group_char: str | None = None
    transform: str | None = None  # None | "prefix" (text before '.') | "state"

    @property
    def is_enum(self) -> bool:
        return self.enum is not None or self.enum_mapping is not None

    @property
    def is_mappable(self) -> bool:
        """Fields whose raw values get value mappings."""
        return self.is_enum or self.type == "boolean"

    @property
    def options(self) -> list[str]:
        """Allowed option texts (B10): booleans = true+false tokens, int enum = labels."""
        if self.type == "boolean":
            return list(self.true_values) + list(self.false_values)
        if self.enum_mapping is not None:
            return [label for label, _ in self.enum_mapping]
        if self.enum is not None:
            return list(self.enum)
        return []

    @property
    def spark_type(self) -> T.DataType:
        base = _SPARK_TYPES[self.type]
        return T.ArrayType(base) if self.allows_multiple else base

    @property
    def admin(self) -> bool:
        return self.milestones is None


@dataclass(frozen=True)
class TableSpec:
    fields: tuple[FieldSpec, ...]
    milestone_names: tuple[str, ...] | None = None
    primary_key: tuple[str, ...] = ("CaseNumber", "MilestoneFlag", "MemberOrganization")
    case_field: str = "CaseNumber"  # identifier reported with invalid values
    flag_field: str = "MilestoneFlag"  # second identifier
    extra: dict = dc_field(default_factory=dict, compare=False)

    # -- lookups -----------------------------------------------------------
    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required_names(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def has(self, name: str) -> bool:
        return any(f.name == name for f in self.fields)

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, not f.required) for f in self.fields])

    # -- B2 / B3: column-format names --------------------------------------
    def wide_columns(self) -> list[tuple[str, str, str]]:
        """(milestone, wide column name, field) for every field asked at a milestone, by milestone and spec order."""
        return [(milestone, dict(f.custom_names).get(i, milestone + f.name), f.name)
                for i, milestone in enumerate(self.milestone_names or ())
                for f in self.fields if f.milestones is not None and i in f.milestones]

    def column_format_fields(self) -> tuple[dict[str, dict[str, str]], list[str]]:
        """({milestone: {wide name: field}}, admin field names)."""
        wide = {m: {w: f for at, w, f in self.wide_columns() if at == m} for m in self.milestone_names or ()}
        return wide, [f.name for f in self.fields if f.milestones is None]

    def valid_names(self, row_format: bool) -> list[str]:
        if row_format:
            return self.names
        return [f.name for f in self.fields if f.milestones is None] + [w for _, w, _ in self.wide_columns()]

    # -- B4-B9: spec checks ------------------------------------------------
    def _outside(self, positions) -> list[int]:
        known = range(len(self.milestone_names)) if self.milestone_names is not None else None
        return [] if known is None else [p for p in positions if p not in known]

    def check(self) -> list[dict]:
        """Return one record per problem; empty means the spec is usable.

        Each rule is an independent query over the fields: (name, offenders, wording).
        """
        coded = [f for f in self.fields if f.enum_mapping is not None]
        bounded = [f for f in coded if None not in (f.minimum, f.maximum)]
        codes = {f.name: {c for _, c in f.enum_mapping} for f in bounded}
        span = {f.name: set(range(int(f.minimum), int(f.maximum) + 1)) for f in bounded}
        rules = (
            ("milestone_names", [(None, "")] if self.milestone_names is None else [], "the spec names no milestones"),
            ("milestone_index", [(f.name, p) for f in self.fields for p in self._outside(f.milestones or ())],
             "no milestone has position {}"),
            ("custom_name_index", [(f.name, f"{p} (column {w})") for f in self.fields for p, w in f.custom_names if self._outside([p])],
             "a wide column is named for milestone position {}, which does not exist"),
            ("label_map_type", [(f.name, f.type) for f in coded if f.type != "integer"], "coded labels need type integer, not {}"),
            ("label_map_bounds", [(f.name, "") for f in coded if f not in bounded], "coded labels need a minimum and a maximum"),
            ("label_map_cover", [(n, f"{sorted(span[n] - codes[n])}, codes beyond the bounds: {sorted(codes[n] - span[n])}")
                                 for n in codes if codes[n] != span[n]], "codes without a label: {}"),
        )
        return [{"field": field, "check": name, "detail": wording.format(what)}
                for name, offenders, wording in rules for field, what in offenders]

    def check_frame(self, spark: SparkSession) -> DataFrame:
        schema = "field string, check string, detail string"
        return spark.createDataFrame(self.check(), schema)

    # -- small frames ------------------------------------------------------
    def spec_frame(self, spark: SparkSession) -> DataFrame:
        """B1: one row per field."""
        rows = []
        for pos, f in enumerate(self.fields):
            rows.append((pos, f.name, f.type, f.required, f.allows_multiple,
                         None if f.minimum is None else str(f.minimum),
                         None if f.maximum is None else str(f.maximum),
                         f.pattern, f.options or None,
                         [c for _, c in f.enum_mapping] if f.enum_mapping else None,
                         list(f.milestones) if f.milestones is not None else None,
                         dict(f.custom_names) or None))
        schema = ("position int, name string, type string, required boolean, "
                  "allows_multiple boolean, minimum string, maximum string, pattern string, "
                  "options array<string>, codes array<bigint>, milestones array<int>, "
                  "custom_names map<int,string>")
        return spark.createDataFrame(rows, schema)

    def options_frame(self, spark: SparkSession, fields: Iterable[str] | None = None) -> DataFrame:
        """(field, option, code, position) for every mappable field."""
        wanted = set(fields) if fields is not None else None
        rows = []
        for f in self.fields:
            if not f.is_mappable or (wanted is not None and f.name not in wanted):
                continue
            codes = dict(f.enum_mapping) if f.enum_mapping else {}
            for pos, opt in enumerate(f.options):
                rows.append((f.name, opt, codes.get(opt), pos))
        return spark.createDataFrame(rows, "field string, option string, code bigint, position int")

    def column_names_frame(self, spark: SparkSession) -> DataFrame:
        """B2: (milestone, milestone_index, wide_name, field); admin fields have null milestone."""
        rows = []
        by_milestone, admin = self.column_format_fields()
        names = list(self.milestone_names or [])
        for m, fields in by_milestone.items():
            for wide, name in fields.items():
                rows.append((m, names.index(m), wide, name))
        for name in admin:
            rows.append((None, None, name, name))
        return spark.createDataFrame(rows, "milestone string, milestone_index int, wide_name string, field string")

    def subset(self, names: Iterable[str]) -> "TableSpec":
        keep = set(names)
        return TableSpec(tuple(f for f in self.fields if f.name in keep), self.milestone_names,
                         self.primary_key, self.case_field, self.flag_field, self.extra)


# -- B1: load ----------------------------------------------------------------

def field_from_descriptor(d: dict) -> FieldSpec:
    cons = d.get("constraints", {}) or {}
    em = d.get("enum_mapping")
    name = d["name"]
    transform = d.get("transform")
    if transform is None:
        # dispatch by well-known field name, as the target spec does
        transform = {"SOC": "prefix", "State": "state"}.get(name)
    pattern_hint = d.get("pattern_hint")
    if pattern_hint is None and name == "SOC":
        pattern_hint = "##-####"
    return FieldSpec(
        name=name,
        type=d.get("type", "string"),
        required=bool(cons.get("required", False)),
        enum=tuple(cons["enum"]) if "enum" in cons else None,
        enum_mapping=tuple((k, int(v)) for k, v in em.items()) if em is not None else None,
        minimum=cons.get("minimum"),
        maximum=cons.get("maximum"),
        pattern=cons.get("pattern"),
        pattern_hint=pattern_hint,
        allows_multiple=bool(d.get("allows_multiple", False)),
        milestones=tuple(d["milestones"]) if "milestones" in d else None,
        custom_names=tuple(sorted((int(k), v) for k, v in d.get("custom_milestone_field_names", {}).items())),
        true_values=tuple(d.get("trueValues", DEFAULT_TRUE_VALUES)),
        false_values=tuple(d.get("falseValues", DEFAULT_FALSE_VALUES)),
        group_char=d.get("groupChar"),
        transform=transform,
    )


def spec_from_descriptor(desc: dict) -> TableSpec:
    fields = tuple(field_from_descriptor(d) for d in desc["fields"])
    ms = desc.get("column_based_milestone_names")
    kw = {}
    if "primaryKey" in desc:
        kw["primary_key"] = tuple(desc["primaryKey"])
    for k in ("case_field", "flag_field"):
        if k in desc:
            kw[k] = desc[k]
    return TableSpec(fields, tuple(ms) if ms is not None else None, **kw)


def load_spec(path_or_desc: str | dict = MISSION_IMPACT_SPEC) -> TableSpec:
    if isinstance(path_or_desc, dict):
        return spec_from_descriptor(path_or_desc)
    with open(path_or_desc) as fh:
        return spec_from_descriptor(json.load(fh))
