"""Fields without a mapping are conformed in two projections, with the staged form's results."""

from pyspark.sql import functions as F

from trueform.functions import cells
from trueform.operators.process import conform_columns
from trueform.operators.shape import join_values, split_values
from trueform.plans.spec import FieldSpec, load_spec

SPEC = load_spec()

ODD = [None, "", " ", "\t\n", "\x01", "\x013", "3\x01", "3\u0085", " 3", "٣", "0", "1", "2", "3", "5", "9", "10", "007", " 3 ", "+1", "-1", "-0",
       "1.0", "1.", ".5", "3.7", "1e0", "1E2", "1e400", "-1e400", "inf", "Infinity", "-INF", "nan", "NaN", "9007199254740993", "999999999999999",
       "9223372036854775807", "9223372036854775808", "1" * 40, "--1", "1 2", "1,234.50", "-1", "1.123456", "1.1234567", "1.1230000", "0." + "0" * 18 + "1",
       "123456789012", "1234567890123.5", "1e-7", "1e3", ",", "$5", "yes", "YES", " yes", "y", "maybe", "true", "no", "2.0", "K", "unknown",
       "2019-03-05", "2019-13-45", "0000-01-01", " 2019-1-5 ", "3/5/2019", "25/3/2019", "Mar 5, 2019", "someday", "3/5/19", "20190305", "2019-03-05T10:15:00",
       "(none)", "4+", "Intake", "intake", "TwoYear", "x'y", "a\\b"]

EXTRA = [FieldSpec("one_low", type="integer", minimum=2), FieldSpec("one_high", type="integer", maximum=2.5), FieldSpec("open", type="integer"),
         FieldSpec("low_label", type="integer", enum_mapping=(("(none)", 0), ("4+", 4), ("Yes", 1), ("YES", 7)), minimum=0, maximum=4),
         FieldSpec("number_label", type="integer", enum_mapping=(("3", 9), ("yes", 1))), FieldSpec("blank_label", type="integer", enum_mapping=(("", 5), ("yes", 1))),
         FieldSpec("token", type="boolean", true_values=("1", "yes"), false_values=("0", "no")), FieldSpec("padded", type="boolean", true_values=("007", "yes"), false_values=("no",)),
         FieldSpec("plain_number", type="number", minimum=-1.5), FieldSpec("grouped", type="number", group_char=",", maximum=2000), FieldSpec("odd_group", type="number", group_char="e"),
         FieldSpec("word", enum=("Intake", "(none)", "x'y", "a\\b")), FieldSpec("blank_word", enum=("", "Intake")), FieldSpec("text"), FieldSpec("shaped", pattern=r"\d+"),
         FieldSpec("many", type="integer", allows_multiple=True, maximum=5), FieldSpec("many_labels", type="integer", allows_multiple=True, enum_mapping=(("yes", 1), ("4+", 9)), minimum=0, maximum=4),
         FieldSpec("many_open", type="integer", allows_multiple=True), FieldSpec("many_words", enum=("Intake",), allows_multiple=True)]


def conformed(df, fields):
    out = conform_columns(df, [f.name for f in fields], fields, {f.name for f in fields if f.allows_multiple}, {})
    out = out.drop(*[f.name for f in fields])
    return out.select(*[F.col(c).cast("string").alias(c) if kind == "date" else F.col(c) for c, kind in out.dtypes])  # year 0 has no Python date


def test_direct_cells_agree_with_the_staged_form(spark, monkeypatch):
    kinds = list({(f.type, len(f.options), f.allows_multiple, f.transform): f for f in SPEC.fields}.values())
    for i, fields in enumerate([EXTRA, kinds]):
        texts = [*ODD, *dict.fromkeys(t for f in fields for o in f.options for t in (o, o.upper(), o.lower(), o + " "))]
        lists = [[t] for t in texts] + [[None, "1"], ["1", ""], ["", " "], [], ["2", "bogus", "99"], ["99", "bogus"], ["1", "2", "1"], ["9", "10"], None]
        rows = [(t, v) for t, v in zip([*texts, *[None] * 9], lists)]
        src = spark.createDataFrame(rows, "t string, l array<string>").coalesce(2)
        df = src.select(*[F.col("l" if f.allows_multiple else "t").alias(f.name) for f in fields])
        assert sum(cells.direct(f, None, dict(df.dtypes)[f.name]) for f in fields) >= (11 if i == 0 else len(fields) - 2)
        new = conformed(df, fields).collect()
        with monkeypatch.context() as m:
            m.setattr(cells, "direct", lambda *a: False)
            old = conformed(df, fields).collect()
        for a, b in zip(new, old):
            assert a == b, [(k, x, y) for k, x, y in zip(a.__fields__, a, b) if x != y]


def test_direct_fields_skip_two_projections(spark):
    fields = [f for f in SPEC.fields if f.transform is None]
    df = spark.createDataFrame([(None,) * len(fields)], ", ".join(f"{f.name} {'array<string>' if f.allows_multiple else 'string'}" for f in fields))
    plan = conformed(df, fields)._jdf.queryExecution().optimizedPlan().toString()
    assert "__d_" not in plan and "__c_" not in plan and "__mca_" not in plan


def test_split_strips_only_where_needed(spark):
    texts = ["a;b", " a ; b\t", "a b;c", ";", " ; ", "\ta", "a\n", "", " ", "a;;b", "a ;b", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(split_values(F.col("v"), ";")).collect()]
    assert got == [None if t is None else [p.strip(" \t\n\r\f\v") for p in t.split(";")] for t in texts]
    assert [r[0] for r in df.select(split_values(F.col("v"), "b")).collect()] == [None if t is None else [p.strip(" \t\n\r\f\v") for p in t.split("b")] for t in texts]
    nums = spark.sql("SELECT array(1L, NULL, 3L) AS v")
    assert nums.select(join_values(F.col("v"))).first()[0] == "1,3"


def test_mission_dirt_is_the_oracles(spark):
    from trueform.workloads import mission_q

    src = spark.createDataFrame([(k, n, 10.5, None) for k in (-3, 0, 1, 2, 96, 12345, None) for n in (1, 2, 7, None)],
                                "l_orderkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp")
    enums = [(k, f) for k, f in enumerate(mission_q.SPEC.fields) if f.enum_mapping is not None]
    made = mission_q.dirty_columns()
    plain = src.select(*[F.when(F.lit(f.allows_multiple), F.concat_ws("|", split_values(F.expr(mission_q._dirt(k, f)), ";"))).otherwise(F.expr(mission_q._dirt(k, f))).alias(f.name) for k, f in enums])
    fast = src.select(*[(F.concat_ws("|", made[f.name]) if f.allows_multiple else made[f.name]).alias(f.name) for _, f in enums])
    assert plain.collect() == fast.collect()
