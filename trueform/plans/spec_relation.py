"""Spec checks over a table of specs: all sites at once.

One row is a field of a site's spec::

    site, milestone_names array<string> (null: the spec names none), field, type,
    minimum, maximum, milestones array<int> (null: asked once),
    custom_names array<struct<position int, name string>>,
    labels array<struct<label string, code bigint>> (null: no coded labels)

Fields that share many labels name them instead: ``label_set`` in place of ``labels``,
and a table of labels (label_set, label, code), each label once and not once a field.

The rules and wordings are those of :meth:`TableSpec.check`, which answers for one
spec while a plan is built; here the specs are data, checked where they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trueform.plans.spec import TableSpec

SPEC_SCHEMA = ("site string, milestone_names array<string>, field string, type string, minimum bigint, maximum bigint, "
               "milestones array<int>, custom_names array<struct<position:int,name:string>>, labels array<struct<label:string,code:bigint>>")


def to_relation(spark: SparkSession, specs: dict[str, TableSpec]) -> DataFrame:
    """The rows of the given specs, one per field."""
    whole = lambda x: None if x is None else int(x)
    rows = [(site, None if s.milestone_names is None else list(s.milestone_names), f.name, f.type, whole(f.minimum), whole(f.maximum),
             None if f.milestones is None else list(f.milestones), list(f.custom_names),
             None if f.enum_mapping is None else list(f.enum_mapping))
            for site, s in specs.items() for f in s.fields]
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def _list_text(codes: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(codes), lambda c: c.cast("string")), ", "), F.lit("]"))


def set_codes(labels: DataFrame) -> DataFrame:
    """(label_set, codes): the distinct codes of each set, a null one included; the labels themselves stay where they are."""
    return (labels.select("label_set", "code").distinct().groupBy("label_set")
            .agg(F.collect_list(F.struct("code")).alias("codes")).select("label_set", F.transform("codes", lambda x: x["code"]).alias("codes")))


def check_specs(specs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(site, field, check, detail), one row per problem; no row for a usable spec.

    A scan and a projection: each field lists its own problems. Only the sites
    without milestone names, which are reported once, need their names folded.
    With ``labels``, fields name a ``label_set`` of it and meet its distinct codes.
    """
    if labels is None:
        specs = specs.withColumn("codes", F.array_distinct(F.transform("labels", lambda x: x["code"])))
    else:
        specs = specs.join(set_codes(labels), "label_set", "left")
    known = F.size("milestone_names")
    names_given = F.col("milestone_names").isNotNull()
    outside = lambda p: names_given & ((p < 0) | (p >= known))
    none = F.array().cast("array<struct<check:string,detail:string>>")
    problem = lambda check, *text: F.struct(F.lit(check).alias("check"), F.concat(*text).alias("detail"))
    coded = F.col("codes").isNotNull()
    bounded = F.col("minimum").isNotNull() & F.col("maximum").isNotNull()
    codes = F.col("codes")
    span = F.when(F.col("maximum") >= F.col("minimum"), F.sequence("minimum", "maximum")).otherwise(F.array().cast("array<bigint>"))
    without, beyond = F.array_except(span, codes), F.array_except(codes, span)
    milestones = F.coalesce("milestones", F.array().cast("array<int>"))
    customs = F.coalesce("custom_names", F.array().cast("array<struct<position:int,name:string>>"))
    found = F.concat(
        F.transform(F.filter(milestones, outside), lambda p: problem("milestone_index", F.lit("no milestone has position "), p.cast("string"))),
        F.transform(F.filter(customs, lambda x: outside(x["position"])), lambda x: problem(
            "custom_name_index", F.lit("a wide column is named for milestone position "), x["position"].cast("string"),
            F.lit(" (column "), x["name"], F.lit("), which does not exist"))),
        F.when(coded & (F.col("type") != "integer"), F.array(problem("label_map_type", F.lit("coded labels need type integer, not "), F.col("type")))).otherwise(none),
        F.when(coded & ~bounded, F.array(problem("label_map_bounds", F.lit("coded labels need a minimum and a maximum")))).otherwise(none),
        F.when(coded & bounded & ((F.size(without) > 0) | (F.size(beyond) > 0)), F.array(problem(
            "label_map_cover", F.lit("codes without a label: "), _list_text(without), F.lit(", codes beyond the bounds: "), _list_text(beyond)))).otherwise(none))
    own = specs.select("site", "field", F.explode(found).alias("p")).select("site", "field", "p.check", "p.detail")
    nameless = specs.where(~names_given).select("site").distinct().select(
        "site", F.lit(None).cast("string").alias("field"), F.lit("milestone_names").alias("check"), F.lit("the spec names no milestones").alias("detail"))
    return nameless.unionByName(own)


def wide_names(specs: DataFrame) -> DataFrame:
    """(site, milestone, wide_name, field) of all wide columns; fields asked once have no milestone.

    Positions outside the milestone names have no column (:func:`check_specs` reports them).
    """
    at = specs.select("site", "field", "milestone_names", "custom_names", F.explode_outer("milestones").alias("p")).where(
        F.col("p").isNull() | ((F.col("p") >= 0) & (F.col("p") < F.size("milestone_names"))))
    milestone = F.get("milestone_names", F.col("p"))
    custom = F.get(F.filter("custom_names", lambda x: x["position"] == F.col("p")), F.lit(0))["name"]
    asked_once = specs.where(F.col("milestones").isNull()).select("site", F.lit(None).cast("string").alias("milestone"), F.col("field").alias("wide_name"), "field")
    return asked_once.unionByName(at.where(F.col("p").isNotNull()).select(
        "site", milestone.alias("milestone"), F.coalesce(custom, F.concat(milestone, F.col("field"))).alias("wide_name"), "field"))
