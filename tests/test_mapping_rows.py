"""Value mappings (E), row filters (G) and reports (H)."""

import datetime as dt

from pyspark.sql import functions as F

from trueform.operators import mapping as M
from trueform.operators import reports as R
from trueform.operators import rows
from trueform.plans.spec import FieldSpec, TableSpec

SPEC = TableSpec((
    FieldSpec("field1", "integer", enum_mapping=(("Hispanic/Latino ethnic origin", 1), ("Not Hispanic/Latino", 2)),
              minimum=1, maximum=2),
    FieldSpec("field3", "boolean"),
))


def gen(spark, col, values):
    df = spark.createDataFrame([(v,) for v in values], f"{col} string")
    return {(r["input"], r["output"]) for r in M.generate(df, SPEC).collect()}


def test_fuzzy_anchors(spark):
    assert gen(spark, "field1", ["Hispanic/Latino origin"]) == {("Hispanic/Latino origin", "Hispanic/Latino ethnic origin")}
    assert gen(spark, "field3", ["1-yes"]) == {("1-yes", "yes")}
    assert gen(spark, "field3", ["", "2.0", "YES", "nan"]) == set()
    assert gen(spark, "field1", ["zzzz"]) == {("zzzz", None)}


def test_resolve_truth_table(spark):
    new = M.from_dict(spark, {"f": {"a": ("N1", "No"), "b": ("N2", "No")}})
    src = M.from_dict(spark, {"f": {"a": ("S1", "Yes"), "c": (None, "Yes"), "d": ("S4", "No")}})
    keep = {r["input"]: (r["output"], r["approved"]) for r in M.resolve(new, src).collect()}
    assert keep == {"a": ("S1", "Yes"), "b": ("N2", "No"), "c": (None, "Yes")}
    over = {r["input"]: r["output"] for r in M.resolve(new, src, overwrite=True).collect()}
    assert over == {"a": "N1", "b": "N2", "c": None}
    allsrc = {r["input"] for r in M.resolve(new, src, remove_unapproved_source=False).collect()}
    assert allsrc == {"a", "b", "c", "d"}


def test_decided_inputs_are_not_scored(spark):
    df = spark.createDataFrame([("1-yes",), ("yess",), ("nope",), ("YES",)], "field3 string")
    decided = M.from_dict(spark, {"field3": {"1-yes": (None, "Yes")}, "field1": {"nope": ("x", "Yes")}})
    assert {r["input"] for r in M.generate(df, SPEC, decided=decided).collect()} == {"yess", "nope"}


def test_dictionary_scores_only_new_spellings(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    first = spark.createDataFrame([("1-yes",), ("nope",)], "field3 string")
    second = spark.createDataFrame([("1-yes",), ("yess",), ("1-yes",)], "field3 string")
    rows_of = lambda df: sorted((r["field"], r["input"], r["output"] or "", r["approved"]) for r in df.collect())
    held = lambda: sorted(r["raw"] for r in spark.read.parquet(path).collect())
    assert rows_of(M.generate(first, SPEC, dictionary=path)) == rows_of(M.generate(first, SPEC))
    assert held() == ["1-yes", "nope"]
    assert rows_of(M.generate(second, SPEC, dictionary=path)) == rows_of(M.generate(second, SPEC))
    assert held() == ["1-yes", "nope", "yess"]
    # another option list: the field is scored anew, older entries don't answer
    other = TableSpec((FieldSpec("field3", "string", enum=("nope!", "maybe")),))
    assert rows_of(M.generate(first, other, dictionary=path)) == rows_of(M.generate(first, other))
    assert held() == ["1-yes", "1-yes", "nope", "nope", "yess"]
    none = spark.createDataFrame([], "field3 string")
    assert M.generate(none, SPEC, dictionary=path).count() == 0 and len(held()) == 5


def test_extract_keys_multi_space(spark):
    text = ("No 'Intake' records found<br/><br/>Case: CASEID-abcde  Member: xx<br/>"
            "Case:    CASEID-fghij   Member: yy<br/>")
    df = spark.createDataFrame([(text,)], "text string")
    assert sorted(r[0] for r in rows.extract_keys(df).collect()) == ["CASEID-abcde", "CASEID-fghij"]


def test_reject_by_keys_and_adjust(spark):
    data = spark.createDataFrame([("C1", "Exit"), ("C1", "Intake"), ("C2", "Exit")], "CaseNumber string, MilestoneFlag string")
    keys = spark.createDataFrame([("C1",)], "CaseNumber string")
    kept, dropped = rows.reject_by_keys(data, keys)
    assert kept.count() == 1 and dropped.count() == 2
    summ = spark.createDataFrame([(3, 0, 1)], "rows_to_upload bigint, rows_dropped bigint, values_dropped bigint")
    assert tuple(R.adjust_summary(summ, dropped).first()) == (1, 2, 1)
    lines = R.dropped_explanations(dropped).collect()
    assert all("corresponding 'Intake' record" in r["explanation"] for r in lines)


def test_time_window_bounds(spark):
    df = spark.createDataFrame([(1, dt.datetime(2018, 1, 1, 0, 0)), (2, dt.datetime(2018, 10, 1, 23, 59, 59)),
                                (3, dt.datetime(2018, 10, 2, 0, 0))], "id int, LastModifiedDate timestamp_ntz")
    out = rows.time_range_filter(df, dt.date(2018, 1, 1), dt.date(2018, 10, 1))
    assert sorted(r["id"] for r in out.collect()) == [1, 2] and out.columns == ["id"]


def test_incremental_window(spark):
    members = spark.createDataFrame([("a",), ("b",)], "member_id string")
    marks = spark.createDataFrame([("a", dt.date(2019, 5, 1))], "member_id string, last_success_date date")
    got = {r["member_id"]: r["window_start"] for r in
           rows.incremental_windows(members, marks, dt.date(2019, 1, 1), dt.date(2019, 6, 1)).collect()}
    assert got == {"a": dt.date(2019, 5, 2), "b": dt.date(2019, 1, 1)}
