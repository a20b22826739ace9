"""Documents to packed training sequences, one operator a stage."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from trueform.llm import decontaminate, langid, minhash, packing, substring
from trueform.llm.common import on_path, saved, small_batches
from trueform.llm.queries import vocabulary_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determinable language: no letter, or ambiguous (random letters, mixed languages).

    The ambiguity flag is held against labelled documents the model never saw
    (``langid.flag_check``): unless these show, at 95 % confidence, that it takes
    more than ``langid.CLEAN_LOSS`` of clean documents, flagged documents go. The
    counts and the decision are saved beside the stages as table ``language-check``.
    """
    model = langid.train(docs.filter(~langid.held_out()))
    check = saved(langid.flag_check(docs, model), "language-check")
    found = langid.identify(docs, model).filter(F.col("lang_pred") != langid.UNDETERMINED)
    if check.first()["believed"]:
        found = found.filter(~F.col("lang_ambiguous"))
    return found.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near-duplicates (5 words, similarity 0.8)."""
    dropped = minhash.near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines and passages that stand in an earlier document or earlier in the same one; documents left without a word go."""
    cut = substring.passage_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)
    return cut.filter(F.col("text").rlike(r"\S"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated with benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontaminate.contamination(docs, benchmark).filter("contaminated").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens; the first piece of a sequence carries its padded token ids."""
    return packing.placed_pieces(packing.pack_documents(docs, vocabulary_file("word_bpe_49k.json")), with_sequence=True)


def lean(stage: Callable) -> Callable:
    """``stage`` with batches to Python workers bounded by bytes."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [("language", lean(language)), ("near_duplicates", lean(near_duplicates)), ("repeated_lines", lean(repeated_lines)),
          ("decontaminated", lean(decontaminated)), ("packed", lean(packed))]

# learned language models, byte-pair tokens and best-fit packing are not SQL; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_path(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
