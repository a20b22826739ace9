"""Value mappings (E1-E9) held as one long DataFrame.

A mapping row is ``(field, input, output, approved)``, unique on
``(field, input)``. Suggestions are generated from *distinct* raw values: one
scan of the data explodes every mappable field into ``(field, raw)`` pairs and
a partial aggregation removes repeats before the shuffle, so the similarity
work scales with the number of distinct spellings, not with rows.
"""

from __future__ import annotations

import hashlib
import json
from typing import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueform.functions import cells, similarity
from trueform.plans.spec import TableSpec
from trueform.session import materialize

# Approval states of a mapping row.
APPROVED = "Yes"
NOT_APPROVED = "No"
VALID_APPROVED_VALUES = (APPROVED, NOT_APPROVED)

#: suggestions need a score above this
MATCH_THRESHOLD = 50

MAPPING_SCHEMA = "field string, input string, output string, approved string"


# -- E1: forms ---------------------------------------------------------------------------------

def from_dict(spark: SparkSession, mappings: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    rows = [(f, i, o, a) for f, m in mappings.items() for i, (o, a) in m.items()]
    return spark.createDataFrame(rows, MAPPING_SCHEMA)


def to_dict(df: DataFrame) -> dict[str, dict[str, tuple]]:
    """Small mapping frames only (configuration-sized)."""
    out: dict[str, dict[str, tuple]] = {}
    for r in df.select("field", "input", "output", "approved").collect():
        out.setdefault(r["field"], {})[r["input"]] = (r["output"], r["approved"])
    return out


def last_wins(df: DataFrame, position: str = "position") -> DataFrame:
    """Duplicate inputs of a field -> the later row wins."""
    best = F.max_by(F.struct("output", "approved"), F.col(position))
    return (df.groupBy("field", "input").agg(best.alias("w"))
            .select("field", "input", "w.output", "w.approved"))


# -- E2, E3: candidates ----------------------------------------------------------------------------

def mappable_fields(spec: TableSpec, columns: Iterable[str]) -> list[str]:
    """Boolean, string-enum and integer-enum fields present in the data."""
    cols = set(columns)
    return [f.name for f in spec.fields if f.is_mappable and f.name in cols]


def candidates(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct raw values per mappable field that need a suggestion.

    Excludes blanks, numeric text and case-insensitive exact options.
    """
    names = mappable_fields(spec, df.columns)
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], "field string, raw string")
    arrays = []
    for n in names:
        dtype = df.schema[n].dataType
        if isinstance(dtype, T.ArrayType):
            arrays.append(F.transform(F.col(n), lambda x, n=n: F.struct(F.lit(n).alias("field"), x.cast("string").alias("raw"))))
        else:
            arrays.append(F.array(F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("raw"))))
    pairs = df.select(F.explode(F.flatten(F.array(*arrays))).alias("p")).select("p.field", "p.raw")
    distinct = pairs.where(~cells.is_blank(F.col("raw")) & ~cells.is_num(F.col("raw"))).distinct()
    opts = spec.options_frame(spark, names).select(
        F.col("field").alias("__f"), F.lower("option").alias("__lo")).distinct()
    cond = (distinct["field"] == opts["__f"]) & (F.lower(distinct["raw"]) == opts["__lo"])
    return distinct.join(F.broadcast(opts), cond, "left_anti")


# -- E4, E5: best option -----------------------------------------------------------------------------

def _options_map(spec: TableSpec, names: list[str]) -> Column:
    fields = [f"'{n}', array({', '.join(similarity.option_sql(i, o) for i, o in enumerate(spec.field(n).options))})"
              for n in names]
    return F.expr(f"map({', '.join(fields)})")


def best_options(cands: DataFrame, spec: TableSpec, floor: int | None = None) -> DataFrame:
    """(field, raw, option, score) with the best-scoring option; first option on a tie.

    Options are a spec-sized literal per field, so scoring is a projection over
    the candidates: no join and no shuffle. Scores at or below ``floor`` may
    read 0 (pairs that cannot pass it are not aligned).
    """
    names = sorted({f.name for f in spec.fields if f.is_mappable and f.options})
    if not names:
        return cands.select("field", "raw", F.lit(None).cast("string").alias("option"),
                            F.lit(0).alias("score"))
    opts = F.try_element_at(_options_map(spec, names), F.col("field"))
    with_key = cands.withColumn("__key", similarity.token_sort_key(F.col("raw"))).withColumn("__opts", opts)
    scored = F.transform(F.col("__opts"), lambda o: F.struct(
        similarity.option_score(F.col("__key"), o, floor).alias("score"),
        (-o["pos"]).alias("neg_pos"),
        o["option"].alias("option")))
    top = F.array_max(scored)
    return with_key.select("field", "raw", top["option"].alias("option"), top["score"].alias("score"))


DICTIONARY_COLUMNS = ("field", "raw", "options_key", "option", "score")
DICTIONARY_SCHEMA = "field string, raw string, options_key string, option string, score int"


def _dictionary(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DICTIONARY_SCHEMA)


def remembered_options(cands: DataFrame, spec: TableSpec, path: str, floor: int | None = None) -> DataFrame:
    """:func:`best_options` by a dictionary table that is kept between runs.

    Only spellings that the table at ``path`` does not hold yet are scored, and are
    appended to it. An entry names the option list and floor it was scored by, so a
    changed spec scores its fields anew. Two runs at once may append the same entry;
    equal entries count once. The candidates are checkpointed, as two steps read them.
    """
    spark = cands.sparkSession
    keys = ["field", "raw", "options_key"]
    marks = {f.name: hashlib.sha256(json.dumps([list(f.options), floor]).encode()).hexdigest()
             for f in spec.fields if f.is_mappable}
    mark = F.coalesce(*[F.when(F.col("field") == n, F.lit(h)) for n, h in marks.items()], F.lit(""))
    marked = materialize(cands.select("field", "raw", mark.alias("options_key")), "checkpoint")
    new = marked.join(_dictionary(spark, path), keys, "left_anti")
    (best_options(new, spec, floor).withColumn("options_key", mark)
     .select(*DICTIONARY_COLUMNS).write.mode("append").parquet(path))
    return marked.join(_dictionary(spark, path).dropDuplicates(keys), keys).select("field", "raw", "option", "score")


def suggest(best: DataFrame, threshold: int = MATCH_THRESHOLD) -> DataFrame:
    """E5: score above threshold -> the option, else no output; never approved."""
    return best.select(
        "field",
        F.col("raw").alias("input"),
        F.when(F.col("score") > threshold, F.col("option")).alias("output"),
        F.lit(NOT_APPROVED).alias("approved"),
    )


def conflicts(mappings: DataFrame) -> DataFrame:
    """Inputs mapped to more than one output."""
    return (mappings.groupBy("field", "input")
            .agg(F.count_distinct(F.coalesce(F.col("output"), F.lit("\u0000"))).alias("n"))
            .where(F.col("n") > 1))


def undecided(cands: DataFrame, decided: DataFrame) -> DataFrame:
    """Candidates without a row in ``decided`` (field, input)."""
    d = decided.select(F.col("field").alias("__df"), F.col("input").alias("__di"))
    return cands.join(d, (cands["field"] == d["__df"]) & (cands["raw"] == d["__di"]), "left_anti")


def generate(df: DataFrame | None, spec: TableSpec, threshold: int = MATCH_THRESHOLD,
             decided: DataFrame | None = None, dictionary: str | None = None) -> DataFrame | None:
    """E2 -> E5; fields without a suggestion are simply absent.

    Candidates are distinct and each has one best option, so no input can have
    two outputs (E6) and no job is run to look. Inputs in ``decided`` are left out
    before anything is scored; ``dictionary`` is a table that keeps scores between
    runs (:func:`remembered_options`)."""
    if df is None:
        return None
    cands = candidates(df, spec)
    if decided is not None:
        cands = undecided(cands, decided)
    best = remembered_options(cands, spec, dictionary, threshold) if dictionary else best_options(cands, spec, threshold)
    return suggest(best, threshold)


# -- E8, E9: approval and resolution --------------------------------------------------------------

def approved_only(mappings: DataFrame) -> DataFrame:
    """E8."""
    return mappings.where(F.col("approved") == APPROVED)


def resolve(new: DataFrame, source: DataFrame, overwrite: bool = False,
            remove_unapproved_source: bool = True) -> DataFrame:
    """Union on (field, input); on a clash the source wins unless ``overwrite``.

    The whole (output, approved) struct is chosen by which side has the key,
    because a null output is a legal value.
    """
    if remove_unapproved_source:
        source = approved_only(source)
    n = new.select(F.col("field").alias("nf"), F.col("input").alias("ni"),
                   F.struct("output", "approved").alias("nv"))
    s = source.select(F.col("field").alias("sf"), F.col("input").alias("si"),
                      F.struct("output", "approved").alias("sv"))
    j = n.join(s, (n["nf"] == s["sf"]) & (n["ni"] == s["si"]), "full_outer")
    has_new, has_src = F.col("nf").isNotNull(), F.col("sf").isNotNull()
    if overwrite:
        pick = F.when(has_new, F.col("nv")).otherwise(F.col("sv"))
    else:
        pick = F.when(has_src, F.col("sv")).otherwise(F.col("nv"))
    return j.select(F.coalesce("nf", "sf").alias("field"), F.coalesce("ni", "si").alias("input"),
                    pick["output"].alias("output"), pick["approved"].alias("approved"))
