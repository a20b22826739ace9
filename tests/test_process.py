"""Row processing (I4): required split, keep-none dedupe, order of effects."""

from pyspark.sql import functions as F

from trueform.operators.process import process
from trueform.plans.spec import load_spec

SPEC = load_spec()


def frame(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_keep_none_dedupe(spark):
    cols = ["Date", "CaseNumber", "MilestoneFlag", "MemberOrganization"]
    rows = [("2019-01-01", "1", "Intake", "M"), ("2019-01-02", "1", "Intake", "M"), ("2019-01-03", "1", "Intake", "M"),
            ("2019-01-01", "2", "Intake", "M"), ("2019-01-01", "3", "Exit", "M")]
    res = process(frame(spark, rows, cols), SPEC)
    kept = sorted(r["CaseNumber"] for r in res.conformed.collect())
    assert kept == ["2", "3"]
    d = res.dropped.collect()
    assert len(d) == 3 and {r["drop_kind"] for r in d} == {"duplicate"}
    assert res.summary().first().asDict() == {"rows_to_upload": 2, "rows_dropped": 3, "values_dropped": 0}


def test_required_missing_and_order_of_effects(spark):
    cols = ["MilestoneFlag", "CaseNumber", "MemberOrganization", "HourlyWage", "StackableCredentials"]
    rows = [("Intake", "1", "M", "x", "1"),      # optional invalid, kept -> reported
            ("Bogus", "2", "M", "y", "1"),       # required invalid -> dropped, optional not reported
            ("Exit", "", "M", "1", "99"),        # required missing
            ("Exit", "4", "M", "2", "3")]
    res = process(frame(spark, rows, cols), SPEC)
    assert sorted(r["CaseNumber"] for r in res.conformed.collect()) == ["1", "4"]
    dropped = {r["CaseNumber"]: r["missing_fields"] for r in res.dropped.collect()}
    assert dropped == {"2": ["MilestoneFlag"], "": ["CaseNumber"]}
    inv = sorted((r["field_name"], r["original_value"], r["case_number"], r["milestone_flag"])
                 for r in res.invalid.collect())
    # The flag's own error carries the raw flag; others carry the conformed flag
    assert inv == [("HourlyWage", "x", "1", "Intake"), ("MilestoneFlag", "Bogus", "2", "Bogus")]


def test_absent_required_column_drops_every_row(spark):
    res = process(frame(spark, [("Intake", "1")], ["MilestoneFlag", "CaseNumber"]), SPEC)
    assert res.conformed.count() == 0
    assert res.dropped.first()["missing_fields"] == ["MemberOrganization"]


def test_partition_independent_and_complete(spark):
    from trueform.workloads.conform_q import EVENTS_SPEC, dirty_events
    src = dirty_events(spark, "/root/testdata/sf0.001")
    a = process(src.repartition(1), EVENTS_SPEC)
    b = process(src.repartition(17), EVENTS_SPEC)
    ka = sorted(tuple(r) for r in a.conformed.collect())
    kb = sorted(tuple(r) for r in b.conformed.collect())
    assert ka == kb
    assert a.conformed.count() + a.dropped.count() == src.count()


def test_idempotent_on_own_output(spark):
    from trueform.workloads.conform_q import EVENTS_SPEC, dirty_events
    first = process(dirty_events(spark, "/root/testdata/sf0.001"), EVENTS_SPEC).conformed
    again_in = first.select(*[F.col(c).cast("string").alias(c) for c in first.columns])
    again = process(again_in, EVENTS_SPEC)
    assert again.invalid.count() == 0 and again.dropped.count() == 0
    assert again.conformed.count() == first.count()


def _big_spec():
    from trueform.plans.spec import load_spec
    return load_spec()


def test_mapping_of_more_rows_than_a_literal_map(spark):
    """Row 257 of a mapping: the joined lookup gives what the literal map gives."""
    from trueform.operators.process import process
    spec = _big_spec()
    rows = [(f"K-{i}", "Intake", "M", "1/1/1980", f"g{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "CaseNumber string, MilestoneFlag string, MemberOrganization string, DateOfBirth string, Gender string")
    maps = spark.createDataFrame([("Gender", f"g{i}", "Male" if i % 2 else "Female", "Yes") for i in range(300)] + [("Gender", None, "Male", "Yes")],
                                 "field string, input string, output string, approved string")
    res = process(df, spec, maps, materialize=None)
    got = {r["CaseNumber"]: r["Gender"] for r in res.conformed.select("CaseNumber", "Gender").collect()}
    few = process(df, spec, maps.where("input in ('g0', 'g1', 'g2')"), materialize=None)
    small = {r["CaseNumber"]: r["Gender"] for r in few.conformed.select("CaseNumber", "Gender").collect()}
    assert len(got) == 300 and len(set(got.values())) == 2
    assert all(got[k] == small[k] for k in ("K-0", "K-1", "K-2"))


def test_unpersist_frees_the_materialised_frame(spark):
    from trueform.operators.process import process
    df = spark.createDataFrame([("K-1", "Intake", "M", "1/1/1980")], "CaseNumber string, MilestoneFlag string, MemberOrganization string, DateOfBirth string")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    res = process(df, _big_spec(), None, materialize="persist")
    res.conformed.count()
    res.unpersist()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_list_cells_join_a_long_mapping_as_the_literal_map_gives_it(spark):
    """Nulls, blanks, repeats and unmapped elements of list cells; 300 entries join, 5 are a literal."""
    from trueform.plans.spec import FieldSpec, TableSpec
    spec = TableSpec(fields=(FieldSpec("c", enum=("A", "B"), allows_multiple=True),))
    cells_in = [["g0", "g1"], ["g1", "g1"], ["g2", "nope"], ["b", None], [""], [], None, ["g3"], ["g0", "g1"]]
    df = spark.createDataFrame(list(enumerate(cells_in)), "id int, c array<string>")
    entries = [("c", f"g{i}", "" if i == 3 else "AB"[i % 2], "Yes") for i in range(300)] + [("c", None, "A", "Yes")]
    maps = spark.createDataFrame(entries, "field string, input string, output string, approved string")
    long, short = (process(df, spec, m, materialize=None) for m in (maps, maps.where("length(input) < 3 and input < 'g5'")))
    got = {r["id"]: r["c"] for r in long.conformed.collect()}
    assert got == {r["id"]: r["c"] for r in short.conformed.collect()}
    assert got[0] == got[8] == ["A", "B"] and got[1] == ["B", "B"] and got[2] is None and got[3] == ["B"]
    assert got[4] is None and got[5] is None and got[6] is None and got[7] is None
    assert [r["original_value"] for r in long.invalid.collect()] == ["['g2', 'nope']"]


def test_optional_cells_reported_for_survivors_and_counted(spark):
    from trueform.plans.spec import FieldSpec, TableSpec
    spec = TableSpec(fields=(FieldSpec("k", "integer", required=True), FieldSpec("n", "number")), primary_key=("k",))
    df = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "z"), ("", "w"), (None, "v"), ("q", "u")], "k string, n string")
    res = process(df, spec, materialize=None)
    bad = {(r["field_name"], r["original_value"]) for r in res.invalid.collect()}
    assert ("n", "x") in bad and ("k", "q") in bad and not {o for f, o in bad if f == "n"} - {"x"}
    s = res.summary().collect()[0]
    assert (s["rows_to_upload"], s["rows_dropped"], s["values_dropped"]) == (1, 5, 2)
    assert process(df, spec, materialize=None, dedupe=False).conformed.count() == 3


def test_stored_outputs_are_the_lazy_ones(spark):
    """One pass gives the rows of the three frames and the summary; kinds without rows are empty frames."""
    from collections import Counter

    from trueform.operators.process import process
    from trueform.plans.spec import FieldSpec, TableSpec
    spec = TableSpec(fields=(FieldSpec("k", required=True), FieldSpec("n", "integer"), FieldSpec("l", enum=("A", "B"), allows_multiple=True)),
                     milestone_names=(), primary_key=("k",), case_field="k", flag_field="k")
    rows = [("a", "1", ["A"], "x"), ("a", "2", ["B"], "x"), ("", "3", ["C"], None), ("b", "1.5", ["A", "C"], "y"), ("c", None, None, "z"), (None, "q", [], "w")]
    for data in (rows, rows[3:5], rows[2:3], []):
        df = spark.createDataFrame(data, "k string, n string, l array<string>, note string")
        lazy, kept = process(df, spec), process(df, spec).store()
        for kind in ("conformed", "dropped", "invalid"):
            a, b = getattr(lazy, kind), getattr(kept, kind)
            assert a.columns == b.columns and Counter(map(str, a.collect())) == Counter(map(str, b.collect())), kind
        assert lazy.summary().first() == kept.summary().first()


def test_stored_conform_run(spark):
    from trueform.plans import pipeline as P
    from trueform.plans.spec import load_spec
    df = spark.createDataFrame([("Intake", "K-1", "3/14/1971", "Male"), ("Intake", "", "3/14/1971", "Male")], "MilestoneFlag string, no string, born string, sex string")
    run = lambda **kw: P.conform({"a": df}, load_spec(), {"no": "CaseNumber", "born": "DateOfBirth", "sex": "Gender"}, None, "M", **kw)
    lazy, stored = run(), run(stored=True)
    assert sorted(map(str, lazy.dataset.collect())) == sorted(map(str, stored.dataset.collect()))
    assert lazy.summary.first() == stored.summary.first() and stored.dropped.count() == 1
    lazy.release()
    assert not any(f.storageLevel.useMemory for f in lazy.held)
