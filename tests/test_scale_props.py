"""Hot keys and reliable materialisation."""

from pyspark.sql import functions as F

from trueform.operators import rows
from trueform.operators.process import process
from trueform.workloads.conform_q import EVENTS_SPEC, dirty_events


def test_hot_key_keep_none_is_exact(spark):
    # one key carries a third of all rows; every copy must drop, nothing else
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("payload"))
    kept, dropped = rows.keep_none_dedupe(df.repartition(16), ["k"])
    assert dropped.count() == n // 3
    assert kept.count() == n - n // 3
    assert kept.where(F.col("k") == -1).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # the hot key is folded map-side before the shuffle


def test_many_duplicate_keys_stay_exact_without_a_hint(spark):
    # Spark plans the join itself
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    kept, dropped = rows.keep_none_dedupe(df, ["k"])
    assert kept.count() == 0 and dropped.count() == 2000
    plan = dropped._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_checkpoint_materialisation_uses_shared_folder(spark):
    src = dirty_events(spark, "/root/testdata/sf0.001")
    a = process(src, EVENTS_SPEC, materialize="checkpoint")
    b = process(src, EVENTS_SPEC, materialize=None)
    assert sorted(map(tuple, a.conformed.collect())) == sorted(map(tuple, b.conformed.collect()))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_derived_columns_are_not_held_or_shuffled(spark):
    from trueform.plans.spec import FieldSpec, TableSpec

    spec = TableSpec(fields=(FieldSpec("id", required=True), FieldSpec("flag", type="boolean", required=True), FieldSpec("n", type="integer"), FieldSpec("tags", type="integer", allows_multiple=True)),
                     primary_key=("id", "flag"), case_field="id", flag_field="flag")
    src = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (3, 3), (None, 4), (5, None), (6, 6)], "a long, b long")
    made = {"id": F.concat(F.lit("c"), F.col("a").cast("string")), "flag": F.when(F.col("b") != 3, F.lit("yes")),
            "n": F.when(F.col("b") == 6, "x6").otherwise(F.col("b").cast("string")), "tags": F.array(F.col("b").cast("string"), F.lit("7")), "note": F.concat(F.lit("n"), F.col("a"))}
    wide = process(src.select(*[c.alias(n) for n, c in made.items()]), spec, materialize=None)
    late = process(src, spec, materialize=None, derive=made)
    for kind in ("conformed", "dropped", "invalid"):
        a, b = getattr(wide, kind), getattr(late, kind)
        assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) and a.count()
    assert wide.summary().collect() == late.summary().collect() and late.store().summary().collect() == wide.summary().collect()
    assert set(late.held.columns) == {"a", "b", "__missing", "__v_id", "__r_id", "__v_flag", "__r_flag"}


def test_mission_shuffles_what_a_lineitem_row_has(spark, tmp_path):
    from trueform.workloads import load_all
    from trueform.workloads.mission_q import run_mission

    load_all()
    spark.createDataFrame([(k, n, 10.0, None) for k in (1, 2) for n in (1, 2, 4)], "l_orderkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    held = run_mission(spark, str(tmp_path)).held
    assert "DisabilityCategories" not in held.columns and len(held.columns) <= 11 and not held.is_cached
