"""Registered workloads over the driver tables.

Each workload is a Spark query (``(spark, sf_dir) -> DataFrame``) plus, where
the semantics are expressible in plain SQL, an independent DuckDB statement
with the same column names. The SQL is written from the stated semantics, not
generated from the Spark code, so the pair cross-checks the library.
"""

from trueform.workloads.registry import QUERIES, ORACLE, load_all

__all__ = ["QUERIES", "ORACLE", "load_all"]
