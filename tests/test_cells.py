"""Single-cell behaviour (F1-F21), examples in the style of the reference tests."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trueform.functions import cells
from trueform.plans.spec import FieldSpec, load_spec

SPEC = load_spec()


def run(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    out = df.select(*[c.alias(f"c{i}") for i, c in enumerate(fn(F.col("v")))]).collect()
    return [tuple(r) for r in out]


def conform(spark, field, values, lookup=None):
    return run(spark, values, lambda c: cells.conform_cell(c, field, lookup))


def test_blank_and_number_tests(spark):
    vals = ["", "  ", None, "3", "3.0", " 7 ", "3.5", "nan", "inf", "1e3", "abc", "3d", "0x10"]
    got = run(spark, vals, lambda c: (cells.is_blank(c), cells.is_int(c), cells.is_num(c)))
    assert [g[0] for g in got] == [True, True, True] + [False] * 10
    assert [g[1] for g in got] == [False, False, False, True, True, True, False, False, False, True, False, False, False]
    assert [g[2] for g in got] == [False, False, None, True, True, True, True, True, True, True, False, False, False]


def test_integer_field(spark):
    f = SPEC.field("StackableCredentials")  # integer 0..9
    got = conform(spark, f, ["3", "3.0", "12", "abc", "", None])
    assert got[0] == (3, None) and got[1] == (3, None)
    assert got[2] == (None, "StackableCredentials must be within the range [0, 9]")
    assert got[3] == (None, "abc is not an integer")
    assert got[4] == (None, None) and got[5] == (None, None)


def test_number_with_group_separator(spark):
    f = SPEC.field("HouseholdIncome")  # number 0..200000
    got = conform(spark, f, ["20,000.00", "300000", "x1"])
    assert got[0] == (Decimal("20000.000000"), None)
    assert got[1] == (None, "HouseholdIncome must be within the range [0, 200000]")
    assert got[2] == (None, "x1 is not a valid number")
    lw = conform(spark, SPEC.field("LivingWage"), ["5"])
    assert lw[0] == (None, "LivingWage must be within the range [7.25, 99.99]")


def test_lenient_dates_month_first(spark):
    f = SPEC.field("DateOfBirth")
    got = conform(spark, f, ["1-5-1982", "1/5/1956", "1-10-1986", "13-1-1986", "1986-01-13", "Jan 5, 2020", "soon"])
    assert [g[0] for g in got[:6]] == [dt.date(1982, 1, 5), dt.date(1956, 1, 5), dt.date(1986, 1, 10),
                                        dt.date(1986, 1, 13), dt.date(1986, 1, 13), dt.date(2020, 1, 5)]
    assert got[6] == (None, "soon is not a valid date")


def test_dates_word_by_word(spark):
    f = SPEC.field("DateOfBirth")
    day = dt.date(2019, 3, 5)
    forms = ["5-Mar-2019", "20190305", "March 3rd, 2019", "Tue, 5 Mar 2019", "Sept 5, 2019", "Mar-05-2019",
             "2019 Mar 5", "5 MARCH 19", "3.5.19", "190305", "Tuesday the 5 Mar 2019", "the 5th of March 2019",
             "5th of March, 2019", "5 Mar 2019 10:15 PM", "Mar 2019 5", "5 2019 Mar", "05mar2019"]
    got = [g[0] for g in conform(spark, f, forms)]
    assert got == [day, day, dt.date(2019, 3, 3), day, dt.date(2019, 9, 5), day, day, day, day, day, None, None,
                   day, day, day, day, day]


def test_words_that_are_no_date(spark):
    f = SPEC.field("DateOfBirth")
    bad = ["March 2019", "5 Mar", "Feb 30, 2019", "20191305", "5 Mar May 2019", "1 2 3 4", "99999999999999", "12", "5-Foo-2019",
           "x", "mar", "0 Mar 2019", "-5 Mar 2019", "32/32/2019", "1" * 4000, "5 Mar 2019 \u00e9"]
    assert conform(spark, f, bad) == [(None, f"{v} is not a valid date") for v in bad]


def test_named_and_plain_dates_agree(spark):
    f = SPEC.field("DateOfBirth")
    values = ["5-Mar-2019", "1/5/1956", "Mar-05-2019", "soon", "2019-03-05T10:15:00", "30 Feb 2019"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(cells.cast(F.col("v"), f)[0].alias("a"), cells.cast_named("v", f)[0].alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(r.a is None for r in rows) == 2


def test_boolean_tokens(spark):
    f = SPEC.field("ConvictedInLastYear")
    got = conform(spark, f, ["yes", "Y", "FALSE", "1.0", "2", "3", "t"])
    assert [g[0] for g in got[:5]] == [True, True, False, True, False]
    assert got[5] == (None, "3 is not in field mapping or valid value set "
                            "(['yes', 'Y', 'true', 'T', '1', 'no', 'N', 'false', 'F', '2'])")
    assert got[6] == (True, None)


def test_int_enum_labels_numbers_and_mapping(spark):
    f = SPEC.field("SelfEfficacyScore1")
    opts = [label for label, _ in f.enum_mapping]
    look = cells.MapLookup({"almost": opts[1], "nothing": ""})
    got = conform(spark, f, [opts[0].upper(), "2", "9", "almost", "nothing", "??"], look)
    assert got[0] == (dict(f.enum_mapping)[opts[0]], None)
    assert got[1] == (2, None)
    assert got[2] == (None, "SelfEfficacyScore1 must be within the range [1, 5]")
    assert got[3] == (dict(f.enum_mapping)[opts[1]], None)
    assert got[4] == (None, None)
    assert got[5] == (None, "?? is not in field mapping or valid value set")


def test_string_enum_mapping_exact_case_then_case_insensitive(spark):
    f = SPEC.field("MilestoneFlag")
    look = cells.MapLookup({"almost_Intake": "Intake", "two years": "TwoYears", "not_a_match": ""})
    got = conform(spark, f, ["almost_Intake", "two years", "not_a_match", "exit", "7"], look)
    assert [g[0] for g in got] == ["Intake", "TwoYears", None, "Exit", None]
    assert got[4][1] == "7 is not in field mapping or valid value set"


def test_soc_and_state(spark):
    soc = conform(spark, SPEC.field("SOC"), ["11-1234.00", " 12-3456 ", "1234", ".5"])
    assert soc[0] == ("11-1234", None) and soc[1] == ("12-3456", None)
    assert soc[2] == (None, "SOC should be in the format ##-####")
    assert soc[3] == (None, None)
    st = conform(spark, SPEC.field("State"), ["Illinois", "il", "17", "Californa", "Narnia", "new  york"])
    assert [s[0] for s in st] == ["IL", "IL", "IL", "CA", None, "NY"]
    assert st[4][1] == "Narnia is not a valid state"


def test_multi_value_first_reason_and_blanks(spark):
    f = SPEC.field("CategoriesIdentifyWith")  # int enum 1..9, multi
    labels = [label for label, _ in f.enum_mapping]
    df = spark.createDataFrame([([labels[0], "", "3"],), (["bogus", "12"],), (["12", "bogus"],), ([""],), (None,)],
                               "v array<string>")
    v, r = cells.conform_multi(F.col("v"), f)
    got = [tuple(x) for x in df.select(v, r).collect()]
    assert got[0] == ([1, 3], None)
    assert got[1] == (None, "bogus is not in field mapping or valid value set")
    # transform-phase reasons come before cast-phase reasons, whatever the order
    assert got[2] == (None, "bogus is not in field mapping or valid value set")
    assert got[3] == (None, None) and got[4] == (None, None)


def _plain_score(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(above[j + 1], row[j])
    return round(100.0 * ((2.0 * row[-1]) / (len(a) + len(b)))) if a and b else 0


def test_similarity_against_plain_lcs(spark):
    import random
    from trueform.functions import similarity as S
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcde _9") for _ in range(n))
    pairs = [("Hispanic/Latino origin", "Hispanic/Latino ethnic origin"), ("1-yes", "yes"), ("", "x"), ("x", ""), ("", ""),
             ("abc", "cab"), ("Nope", "no"), ("LGBT", "LGBTQ"), ("Caf\u00e9 \\ 'b'", "caf b")]
    pairs += [(text(rng.randint(1, 200)), text(n)) for n in (1, 61, 62, 63, 124, 125, 190)]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        S.token_sort_key("a").alias("a"), S.token_sort_key("b").alias("b"))
    for r in df.select("a", "b", S.ratio_score(F.col("a"), F.col("b")).alias("n")).collect():
        assert r["n"] == _plain_score(r["a"], r["b"]), r


def test_options_against_plain_lcs(spark):
    import random
    from trueform.functions import similarity as S
    from trueform.operators import mapping as M
    from trueform.plans.spec import FieldSpec, TableSpec
    rng = random.Random(4)
    options = ("yes", "it's \\ so", "\u00fc!", "word " * 40, "some other words, of no length", "zz")
    spec = TableSpec((FieldSpec("f", "string", enum=options),))
    raws = ["".join(rng.choice("abdeorsuwyz ,'") for _ in range(n)) for n in (1, 4, 9, 30, 70, 300, 5000)] + ["yse", "--", "zz yes"]
    cands = spark.createDataFrame([("f", r) for r in raws] + [("g", "yes")], "field string, raw string")
    for floor in (None, 50):
        got = {(r["field"], r["raw"]): (r["option"], r["score"]) for r in M.best_options(cands, spec, floor).collect()}
        assert got.pop(("g", "yes")) == (None, None)
        assert len(got) == len(raws)
        for (_, raw), (option, score) in got.items():
            key = S.option_key(raw)
            scores = [_plain_score(key, S.option_key(o)) for o in options]
            if floor is None or max(scores) > floor:
                assert (option, score) == (options[scores.index(max(scores))], max(scores)), raw
            else:
                assert score <= floor


def test_number_digits_beyond_six_places_are_invalid(spark):
    from pyspark.sql import functions as F
    from trueform.functions import cells
    from trueform.plans.spec import FieldSpec
    f = FieldSpec(name="x", type="number")
    rows = spark.createDataFrame([("1.234567",), ("1.23456789",), ("400.0000004",), ("1.2300000000",), ("0.1000000000000000000001",)], "v string")
    got = [None if r[0] is None else str(r[0]) for r in rows.select(cells.cast_number(F.col("v"), f)).collect()]
    assert got == ["1.234567", None, None, "1.230000", None]


def test_states_are_not_invented(spark):
    from pyspark.sql import functions as F
    from trueform.functions.states import state_code
    rows = ["Miami", "Money", "Oahu", "Huh", "Genoa", "Taxes", "Arizonna", "Califronia", "texas", "Kansas", "Arkansa"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "v string").select(state_code(F.col("v"))).collect()]
    assert got == [None, None, None, None, None, None, "AZ", "CA", "TX", "KS", "AR"]
