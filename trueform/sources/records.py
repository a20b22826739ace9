"""Extraction queries and nested records."""

from __future__ import annotations

import datetime as dt
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _walk(dtype: T.DataType, path: list[str], out: list[tuple[list[str], str]]) -> None:
    for f in dtype.fields:
        if f.name == "attributes":
            continue
        p = path + [f.name]
        if isinstance(f.dataType, T.StructType):
            _walk(f.dataType, p, out)
        else:
            out.append((p, ".".join(p)))


def flatten(df: DataFrame, drop_all_null: bool = False) -> DataFrame:
    """A5: nested structs -> flat ``a.b`` columns; ``attributes`` members dropped.

    A null member is a null cell; with ``drop_all_null`` a column that is null
    in every row is removed (one aggregation).
    """
    leaves: list[tuple[list[str], str]] = []
    _walk(df.schema, [], leaves)
    cols: list[Column] = []
    for path, name in leaves:
        c = F.col("`" + path[0] + "`")
        for p in path[1:]:
            c = c.getField(p)
        cols.append(c.alias(name))
    out = df.select(*cols)
    if drop_all_null and leaves:
        counts = out.agg(*[F.count(F.col(f"`{n}`")).alias(f"c{i}") for i, (_, n) in enumerate(leaves)]).collect()[0]
        keep = [n for i, (_, n) in enumerate(leaves) if counts[f"c{i}"] > 0]
        out = out.select(*[F.col(f"`{n}`") for n in keep])
    return out


def parse_json(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """JSON text column -> struct column (then :func:`flatten`)."""
    return df.withColumn(column, F.from_json(F.col(column), schema))


def window_args(start: dt.datetime, end: dt.datetime) -> dict:
    return {"start_datetime": start, "end_datetime": end}


def param_extract(spark: SparkSession, query: str, start: dt.datetime, end: dt.datetime,
                  **frames: DataFrame) -> DataFrame:
    """A query template with ``:start_datetime`` / ``:end_datetime`` bound to the run window.

    Bound parameters, not text substitution; ``frames`` are referenced as ``{name}``.
    """
    return spark.sql(query, args=window_args(start, end), **frames)


def multi_extract(spark: SparkSession, queries: Mapping[str, str], start: dt.datetime, end: dt.datetime,
                  **frames: DataFrame) -> dict[str, DataFrame]:
    """Run every query; keep only non-empty results, by name."""
    out = {}
    for name, q in queries.items():
        df = param_extract(spark, q, start, end, **frames)
        if not df.isEmpty():
            out[name] = df
    return out
