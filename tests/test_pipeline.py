"""End to end (I1-I3) on the rebuilt target spec, plus sources (A)."""

from pyspark.sql import functions as F

from trueform.plans import pipeline as P
from trueform.plans.spec import load_spec
from trueform.sources import files, records, sheets

SPEC = load_spec()


def site_rows(spark):
    """Six rows of a made-up site: one repeated key, one pair without a birth date, two good ones."""
    cols = ["MilestoneFlag", "client_no", "born_on", "sex"]
    rows = [("Intake", "K-17", "3/14/1971", "Male"),
            ("Intake", "K-22", "7/2/1964", "Female"),
            ("Intake", "K-22", "7/2/1965", "Female"),
            ("Intake", "K-31", "1990-11-30", "Other"),
            ("Intake", "K-44", "", "Male"),
            ("Intake", "K-44", "", "Male")]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


COLMAP = {"client_no": "CaseNumber", "born_on": "DateOfBirth", "sex": "Gender"}


def test_end_to_end(spark):
    res = P.conform({"fake": site_rows(spark)}, SPEC, COLMAP, None, member_id="M-1")
    assert res.status == P.SUCCESS
    kept = sorted(r["CaseNumber"] for r in res.dataset.collect())
    assert kept == ["K-17", "K-31"]
    assert res.dropped.count() == 4 and res.invalid.count() == 0
    assert P.route(res) == "upload"


def test_gates(spark):
    df = site_rows(spark)
    assert P.conform({"a": df.limit(0)}, SPEC, COLMAP, None, "M").status == P.NO_DATA
    assert P.conform({"a": df.withColumn("Odd", F.lit("1"))}, SPEC, COLMAP, None, "M").status == P.SHAPE_INVALID
    typo = df.withColumn("sex", F.lit("Femal"))
    res = P.conform({"a": typo}, SPEC, COLMAP, None, "M")
    assert res.status == P.APPROVAL_NEEDED
    assert {(r["input"], r["output"]) for r in res.field_mappings.collect()} == {("Femal", "Female")}
    approved = res.field_mappings.withColumn("approved", F.lit("Yes"))
    assert P.conform({"a": typo}, SPEC, COLMAP, approved, "M").status == P.SUCCESS


def test_csv_roundtrip_and_prefix(spark, tmp_path):
    import pandas as pd
    d = tmp_path / "in"
    d.mkdir()
    pd.DataFrame({"a": ["1", "NA"], "b": ["x", ""]}).to_csv(d / "siteA_1.csv", index=False)
    pd.DataFrame({"a": ["2"], "b": ["y"]}).to_csv(d / "siteB_1.csv", index=False)
    got = files.read_delimited(spark, str(d), prefix="siteA_").collect()
    assert sorted((r["a"], r["b"]) for r in got if r["a"]) == [("1", "x")]
    assert any(r["a"] is None for r in got)


def test_header_promotion_and_flatten(spark):
    cells = spark.createDataFrame([(0, [" Input", "Output ", "Approved"]), (1, ["a", "b"]), (2, ["c", "d", "Yes"])],
                                  "row_no int, cells array<string>")
    out = sheets.promote_header(cells)
    assert out.columns == ["Input", "Output", "Approved"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", "b", None), ("c", "d", "Yes")]
    nested = spark.createDataFrame([("v", ("s", ("t",)), ("u",))],
                                   "field string, field2 struct<subfield:string, attributes:struct<type:string>>, "
                                   "attributes struct<type:string>")
    assert records.flatten(nested).columns == ["field", "field2.subfield"]


def test_line_breaks_in_cells_and_mapping_inputs(spark, tmp_path):
    from trueform.operators import mapping as M
    from trueform.sources import mappings_io as MIO
    cols = ", ".join(f"{c} string" for c in ("MilestoneFlag", "client_no", "born_on", "sex"))
    files.write_delimited(spark.createDataFrame([("Intake", "K-17\nb", "3/14/1971", "Male"), ("Intake", "K-22", "7/2/1964", "Fe\nmale")], cols), str(tmp_path / "site"))
    spark.createDataFrame(list({**COLMAP, "MilestoneFlag": "MilestoneFlag"}.items()), "`Internal Column Name` string, `Mission Impact Field Name` string") \
        .write.option("header", True).csv(str(tmp_path / "colmap"))
    maps = spark.createDataFrame([("Gender", "Fe\nmale", "Female", "Yes")], M.MAPPING_SCHEMA)
    MIO.write_value_mappings(maps, str(tmp_path / "maps"))
    assert [tuple(r)[:4] for r in MIO.load_value_mappings(spark, str(tmp_path / "maps"), SPEC).collect()] == [("Gender", "Fe\nmale", "Female", "Yes")]
    assert MIO.header_problems(spark, str(tmp_path / "maps"), SPEC).isEmpty()
    res = P.conform_files(spark, [str(tmp_path / "site")], SPEC, str(tmp_path / "colmap"), str(tmp_path / "maps"), "M-1")
    assert res.status == P.SUCCESS, res.failures and res.failures.collect()
    assert sorted((r["CaseNumber"], r["Gender"]) for r in res.dataset.collect()) == [("K-17\nb", 2), ("K-22", 1)]


def write_lines(path, *lines):
    path.write_text("\n".join(lines) + "\n")


def test_only_files_with_line_breaks_stay_whole(spark, tmp_path):
    """Files are split unless a cell holds a line break, without a flag; the rows are those of whole reads."""
    plain, mixed = tmp_path / "plain", tmp_path / "mixed"
    for d in (plain, mixed):
        d.mkdir()
        write_lines(d / "a.csv", "k,s", *[f'{i},"said ""{i}"", then"' for i in range(4000)])
    write_lines(mixed / "b.csv", "k,s", *[f'{i},"two\nlines"' for i in range(5000, 5400)])
    assert files.files_with_line_breaks(spark, [str(plain)]) == {}
    assert [f.rsplit("/", 1)[1] for f in files.files_with_line_breaks(spark, [str(plain), str(mixed)])[str(mixed)]] == ["b.csv"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for d, rows in ((plain, 4000), (mixed, 4400)):
            got = files.read_datasets(spark, [str(d)])[str(d)]
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, files.read_delimited(spark, str(d), multi_line=True).collect()))
            assert got.count() == rows
            assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        assert files.read_delimited(spark, str(mixed / "b.csv")).select(F.spark_partition_id().alias("p")).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_repeated_header_names(spark, tmp_path):
    write_lines(tmp_path / "a.csv", "k,s,k", "1,x,2")
    write_lines(tmp_path / "b.csv", "k0,s,k2", "1,x,2")
    assert files.read_delimited(spark, str(tmp_path / "a.csv")).columns == ["k", "s", "k.1"]
    assert files.read_delimited(spark, str(tmp_path / "b.csv")).columns == ["k0", "s", "k2"]


def test_wrong_mapping_header_ends_a_file_run(spark, tmp_path):
    from trueform.sources import mappings_io as MIO
    site_rows(spark).write.option("header", True).csv(str(tmp_path / "site"))
    spark.createDataFrame(list({**COLMAP, "MilestoneFlag": "MilestoneFlag"}.items()), "`Internal Column Name` string, `Mission Impact Field Name` string") \
        .write.option("header", True).csv(str(tmp_path / "colmap"))
    maps = tmp_path / "maps"
    maps.mkdir()
    write_lines(maps / "Gender.csv", "Inputs,Output,Approved", "Femal,Female,Yes")
    write_lines(maps / "Ethnicity.csv", "Input,Output", "x,y")
    write_lines(maps / "NoSuchField.csv", "what,ever", "x,y")
    write_lines(maps / "State.csv", "Input,Output,Approved")
    got = sorted((r.dataset, r.failed_value or "") for r in MIO.header_problems(spark, str(maps), SPEC).collect())
    fields = {f.name for f in SPEC.fields if f.is_mappable}
    assert got == sorted([("Gender", "Inputs")] + ([("Ethnicity", "")] if "Ethnicity" in fields else []))
    res = P.conform_files(spark, [str(tmp_path / "site")], SPEC, str(tmp_path / "colmap"), str(maps), "M-1")
    assert res.status == P.VALMAP_INVALID and {r.expectation for r in res.failures.collect()} == {"expect_table_columns_to_match_ordered_list"}


def test_later_mapping_wins_on_both_sides_of_the_limit(spark):
    """The number of other rows beside a repeated input never changes which output it gets."""
    from trueform.operators.process import process
    from trueform.plans.spec import FieldSpec, TableSpec
    spec = TableSpec(fields=(FieldSpec("k", enum=("A", "B")), FieldSpec("l", enum=("A", "B"), allows_multiple=True)), milestone_names=())
    df = spark.createDataFrame([("zz", ["zz", "o1"])], "k string, l array<string>")
    for others in (0, 255, 300):
        rows = [(f, "zz", "A", "Yes") for f in "kl"] + [(f, f"o{i}", "A", "Yes") for i in range(others + 2) for f in "kl"] + [(f, "zz", "B", "Yes") for f in "kl"]
        for maps in (spark.createDataFrame(rows, "field string, input string, output string, approved string"),
                     spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "field string, input string, output string, approved string, position int").orderBy("output", F.desc("position"))):
            row = process(df, spec, maps).conformed.first()
            assert (row.k, row.l) == ("B", ["B", "A"]), others
