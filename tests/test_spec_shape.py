"""Spec (B), shape (D) and expectation (C) behaviour."""

import dataclasses

from pyspark.sql import functions as F

from trueform.operators import expectations as X
from trueform.operators import shape as S
from trueform.plans.spec import FieldSpec, TableSpec, load_spec

SPEC = load_spec()


def test_rebuilt_spec_counts():
    fields = SPEC.fields
    assert len(fields) == 93
    assert SPEC.required_names == ["MilestoneFlag", "CaseNumber", "MemberOrganization"]
    assert sum(f.allows_multiple for f in fields) == 5
    assert sum(f.enum_mapping is not None for f in fields) == 53
    assert SPEC.check() == []


def test_spec_checks_report_problems():
    bad = TableSpec((FieldSpec("a", "integer", enum_mapping=(("x", 1), ("y", 3)), minimum=1, maximum=3),
                     FieldSpec("b", "string", enum_mapping=(("x", 1),)),
                     FieldSpec("c", milestones=(5,), custom_names=((7, "Zc"),))),
                    milestone_names=("Intake", "Exit"))
    kinds = sorted(p["check"] for p in bad.check())
    assert kinds == ["custom_name_index", "label_map_bounds", "label_map_cover", "label_map_type", "milestone_index"]


def test_column_format_names():
    by_m, admin = SPEC.column_format_fields()
    assert "CaseNumber" in admin
    assert by_m["Intake"]["IntakeCurrentMostRecentJobLastDayOfWork"] == "JobDate"
    assert by_m["Exit"]["ExitDate"] == "Date"
    assert by_m["TwoYear"]["TwoYearsRetirementSavings"] == "Retirement"


WIDE = TableSpec((FieldSpec("field1"), FieldSpec("field2", milestones=(0,)), FieldSpec("field3", milestones=(0, 1)),
                  FieldSpec("field4", milestones=(2,), custom_names=((2, "actual_field4"),))),
                 milestone_names=("Intake", "Exit", "NinetyDays"))


def test_wide_to_long(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", "e"), ("f", None, "h", None, None)],
                               "field1 string, Intakefield2 string, Intakefield3 string, Exitfield3 string, actual_field4 string")
    out = S.wide_to_long(df, WIDE)
    assert out.count() == 6
    got = sorted(tuple(r) for r in out.select("field1", "MilestoneFlag", "field2", "field3", "field4").collect())
    assert ("f", "NinetyDays", None, None, None) in got  # X1: kept with null fields
    assert S.wide_to_long(df, WIDE, empty_rows="drop").count() == 4


def test_split_and_join_values(spark):
    df = spark.createDataFrame([("a; b ;c",), ("",), ("x|y",)], "v string")
    got = [r[0] for r in df.select(S.split_values(F.col("v"), ";")).collect()]
    assert got == [["a", "b", "c"], [""], ["x|y"]]
    assert [r[0] for r in df.select(S.split_values(F.col("v"), "|")).collect()][2] == ["x", "y"]
    assert df.select(S.join_values(F.array(F.lit(3), F.lit(4)))).first()[0] == "3,4"


def test_rename_drop_and_clash(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    out = S.rename_and_drop(df, {"a": "A", "b": None, "c": " "})
    assert out.columns == ["A"]
    try:
        S.rename_and_drop(df, {"a": "X", "b": "X"})
        raise AssertionError("clash not detected")
    except ValueError:
        pass


def test_name_expectations():
    assert X.columns_in_set(["a", "b", "_c2"], ["a"])[0]["failed_value"] == "b"
    assert X.named_columns(["a", "_c5", "Unnamed: 3"])[0]["failed_value"] == "5"
    m = X.columns_match(["Internal Column Name"], list(X.COLUMN_MAPPING_COLUMNS))
    assert [r["failed_value"] for r in m] == [None]


def test_column_mapping_check_stops_on_header(spark):
    bad_header = spark.createDataFrame([("x", "y")], "`Internal Name` string, `Mission Impact Field Name` string")
    f = X.check_column_mapping(bad_header, SPEC)
    assert {r["expectation"] for r in f.collect()} == {X.COLUMNS_MATCH}
    cm = spark.createDataFrame([("id", "CaseNumber"), ("id", "Nope")],
                               "`Internal Column Name` string, `Mission Impact Field Name` string")
    kinds = sorted((r["expectation"], r["failed_value"]) for r in X.check_column_mapping(cm, SPEC).collect())
    assert kinds == [(X.VALUES_IN_SET, "Nope"), (X.VALUES_UNIQUE, "id")]


def test_spec_checks_as_a_relation(spark):
    """Specs as rows give the problems and the wide names that each spec gives for itself."""
    from trueform.plans import spec_relation as R
    from trueform.plans.spec import FieldSpec, TableSpec, load_spec
    coded = dict(type="integer", enum_mapping=(("a", 1), ("b", 2), ("c", 2), ("d", 9)))
    specs = {
        "full": load_spec(),
        "odd": TableSpec(fields=(
            FieldSpec("m", milestones=(0, 2, -1, 7), custom_names=((2, "Other"), (5, "Nowhere"))), FieldSpec("once"), FieldSpec("none", milestones=()),
            FieldSpec("l1", minimum=1, maximum=4, **coded), FieldSpec("l2", minimum=1, **coded), FieldSpec("l3", **{**coded, "type": "string"}, minimum=1, maximum=2),
            FieldSpec("l4", minimum=5, maximum=2, **coded), FieldSpec("l5", type="integer", enum_mapping=(), minimum=1, maximum=1)), milestone_names=("In", "Mid", "Out")),
        "nameless": TableSpec(fields=(FieldSpec("m", milestones=(0, 9)), FieldSpec("once")), milestone_names=None),
    }
    rows = R.to_relation(spark, specs)
    got = sorted(R.check_specs(rows).collect(), key=str)
    want = [(site, p["field"], p["check"], p["detail"]) for site, s in specs.items() for p in s.check()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) > 8
    names = {(r.site, r.milestone, r.wide_name, r.field) for r in R.wide_names(rows).collect()}
    assert names == {(site, m, w, f) for site, s in specs.items() if s.milestone_names is not None for m, w, f in s.wide_columns()} | {
        (site, None, f.name, f.name) for site, s in specs.items() for f in s.fields if f.milestones is None}


def test_shared_labels_are_named_not_copied(spark, tmp_path):
    from trueform.plans import spec_relation as R
    from trueform.workloads import spec_q

    sets = {0: [("a", 0), ("b", 1), ("c", 1)], 1: [("a", 4), ("n", None)], 2: []}
    kinds = [("integer", 0, 1), ("integer", 0, 4), ("string", None, 3), ("integer", 5, 4)]
    rows = [(f"s{i % 3}", ["In"] if i % 3 else None, f"f{i}", kind, lo, hi, [i % 2], [], i % 4, sets.get(i % 4) or None)
            for i, (kind, lo, hi) in enumerate(kinds * 4)]
    schema = R.SPEC_SCHEMA.replace("labels array", "label_set long, labels array")
    inline = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(k, x, c) for k, held in sets.items() for x, c in held * 50], "label_set long, label string, code long")
    got = sorted(map(repr, R.check_specs(inline.drop("labels"), labels).collect()))
    assert got == sorted(map(repr, R.check_specs(inline.drop("label_set")).collect())) and len(got) >= 10
    assert R.set_codes(labels).where("label_set = 0").first()["codes"].__len__() == 2  # 150 labels, two codes

    spark.range(200).selectExpr("id AS p_partkey", "'b' AS p_brand", "int(id) AS p_size").write.parquet(str(tmp_path / "part.parquet"))
    spark.range(900).selectExpr("id AS c_custkey", "string(id) AS c_name", "id AS c_nationkey").write.parquet(str(tmp_path / "customer.parquet"))
    assert "labels" not in spec_q.spec_rows(spark, str(tmp_path)).columns and spec_q.b4_spec_checks(spark, str(tmp_path)).count() > 0


def test_live_milestones_need_no_job_to_plan(spark):
    from trueform.operators import shape as S
    from trueform.plans.spec import FieldSpec, TableSpec
    spec = TableSpec(fields=(FieldSpec("id"), FieldSpec("a", milestones=(0, 1, 2)), FieldSpec("b", milestones=(1,))), milestone_names=("In", "Mid", "Out"))
    df = spark.createDataFrame([("1", "x", None, None, None), ("2", None, None, "z", None)], "id string, Ina string, Mida string, Midb string, Outa string")
    spark.sparkContext.setJobGroup("plan-only", "wide to long")
    frames = {mode: S.wide_to_long(df, spec, mode) for mode in ("keep", "drop")}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setJobGroup("rest", "")
    rows = {mode: {(r.id, r.MilestoneFlag, r.a, r.b) for r in f.collect()} for mode, f in frames.items()}
    assert rows["keep"] == {("1", "In", "x", None), ("1", "Mid", None, None), ("2", "In", None, None), ("2", "Mid", None, "z")}
    assert rows["drop"] == {("1", "In", "x", None), ("2", "Mid", None, "z")}
    empty = S.wide_to_long(df.where("id = 'none'"), spec)
    assert empty.count() == 0 and "a" in empty.columns
