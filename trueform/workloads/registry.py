"""Name -> (Spark query, oracle SQL) registry."""

from __future__ import annotations

import importlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "trueform.workloads.conform_q",
    "trueform.workloads.cells_q",
    "trueform.workloads.rows_q",
    "trueform.workloads.shape_q",
    "trueform.workloads.mapping_q",
    "trueform.workloads.expect_q",
    "trueform.workloads.sources_q",
    "trueform.workloads.reports_q",
    "trueform.workloads.runs_q",
    "trueform.workloads.mission_q",
    "trueform.workloads.spec_q",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
