"""Delimited files (A1, A2, A9) and the empty-input guard (A3)."""

from __future__ import annotations

from typing import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Cell texts read as missing (the common spreadsheet/CSV tokens).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def _reader(spark: SparkSession, prefix: str | None = None, multi_line: bool = False):
    """``multi_line`` only where cells hold line breaks: such a file is one task."""
    r = (spark.read.option("header", True).option("inferSchema", False).option("multiLine", multi_line)
         .option("escape", '"').option("mode", "PERMISSIVE"))
    if prefix:
        r = r.option("pathGlobFilter", f"{prefix}*")
    return r


def na_to_null(df: DataFrame) -> DataFrame:
    """Missing-value tokens become null; everything stays text."""
    return df.select(*[F.when(F.col(f"`{c}`").isin(*NA_TOKENS), F.lit(None).cast("string"))
                       .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def _header_names(df: DataFrame, spark: SparkSession, path: str, prefix: str | None, multi_line: bool) -> DataFrame:
    """Names as the header line has them: of equal names the later ones become ``k.1``, ``k.2``.

    Spark puts its column number behind each of several equal names (``k0``, ``k2``).
    The header line itself is read only where names look like that.
    """
    stems = [c[:-len(str(i))].lower() if c.endswith(str(i)) else None for i, c in enumerate(df.columns)]
    if len(stems) == len(set(stems) - {None}) + stems.count(None):
        return df
    line = _reader(spark, prefix, multi_line).option("header", False).csv(path).first()
    if line is None or len(line) != len(df.columns):
        return df
    names: list[str] = []
    for i, (cell, spark_name) in enumerate(zip(line, df.columns)):
        name, n = cell if cell else spark_name, 1
        while name.lower() in (x.lower() for x in names):
            name, n = f"{cell}.{n}", n + 1
        names.append(name)
    return df.toDF(*names)


def read_delimited(spark: SparkSession, path: str, prefix: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """A1 for one path (file, folder or glob) of one header; A2 when ``prefix`` is given.

    ``multi_line``: whether cells hold line breaks; if not said, the files are looked
    through first (:func:`files_with_line_breaks`).
    """
    broken = files_with_line_breaks(spark, [path], prefix).get(path, set()) if multi_line is None else set()
    return _read(spark, path, prefix, multi_line, broken)


def _read(spark: SparkSession, path: str, prefix: str | None, multi_line: bool | None, broken: set[str]) -> DataFrame:
    """One dataset: only files with line breaks in their cells are read whole, one task each."""
    whole = bool(multi_line) or bool(broken)
    df = None
    if multi_line is None and broken:
        rest = [f for f in _files_of(spark, path, prefix) if f not in broken]
        if rest:
            parts = [_reader(spark, multi_line=False).csv(rest), _reader(spark, multi_line=True).csv(sorted(broken))]
            if parts[0].columns == parts[1].columns:  # else names go by place, as in a read of all files at once
                df = parts[0].union(parts[1])
    if df is None:
        df = _reader(spark, prefix, whole).csv(path)
    return na_to_null(_header_names(df, spark, path, prefix, whole))


def _files_of(spark: SparkSession, path: str, prefix: str | None) -> list[str]:
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix or ''}*").load(path)
    return sorted(unquote(r["f"]) for r in found.select(F.col("_metadata.file_path").alias("f")).collect())


def odd_quotes(line: Column) -> Column:
    """Whether a line holds an odd number of double quotes."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def files_with_line_breaks(spark: SparkSession, paths: Iterable[str], prefix: str | None = None) -> dict[str, set[str]]:
    """For each path, its files that may hold line breaks inside cells: those with a line of odd quotes.

    A record starts outside quotes, so the first line break inside a cell ends a
    line with an odd number of quotes; a file without such a line may be split at
    any line. One job over all paths: lines are tested where they lie, and only
    names of files come back. A stray quote makes a file count as broken, which is
    slower but not wrong.
    """
    lines = None
    for path in paths:
        r = spark.read.option("pathGlobFilter", f"{prefix}*") if prefix else spark.read
        one = r.text(path).select(F.lit(path).alias("path"), F.col("_metadata.file_path").alias("file"), "value")
        lines = one if lines is None else lines.unionAll(one)
    out: dict[str, set[str]] = {}
    if lines is not None:
        for r in lines.where(odd_quotes(F.col("value"))).select("path", "file").distinct().collect():
            out.setdefault(r["path"], set()).add(unquote(r["file"]))
    return out


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> list[str]:
    """Full paths of the files under ``path`` whose names match; names only, no content is read."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", recursive).load(path).select("path"))
    return sorted(r["path"] for r in found.collect())


def read_datasets(spark: SparkSession, paths: str | Iterable[str], prefix: str | None = None,
                  multi_line: bool | None = None) -> dict[str, DataFrame]:
    """A1: each path is its own dataset, named by its full path (sites differ in headers and
    repeat base names); with ``prefix`` (A2) so is each selected file of a folder. Without
    ``multi_line`` one job looks for line breaks inside the cells of all of them."""
    if isinstance(paths, str):
        paths = [paths]
    names = [f for p in paths for f in ([p.rstrip("/")] if prefix is None else list_files(spark, p, f"{prefix}*"))]
    broken = files_with_line_breaks(spark, names) if multi_line is None else {}
    return {f: _read(spark, f, None, multi_line, broken.get(f, set())) for f in names}


def is_empty_input(datasets: dict[str, DataFrame]) -> bool:
    """A3: no dataset, or every dataset empty (one cheap probe per dataset)."""
    return not datasets or all(df.isEmpty() for df in datasets.values())


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, no index column; lists must be joined first."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
