"""Tables of raw cell rows (A4, A11) - e.g. exported spreadsheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def promote_header(cells: DataFrame, row_col: str = "row_no", cells_col: str = "cells") -> DataFrame | None:
    """A4: the first row names the columns (names stripped); ragged rows padded with null.

    Only the header row reaches the driver. An empty table gives None.
    """
    first = cells.orderBy(row_col).select(row_col, cells_col).limit(1).collect()
    if not first:
        return None
    hdr_row, names = first[0][0], [str(n).strip() for n in first[0][1]]
    body = cells.where(F.col(row_col) > hdr_row)
    return body.select(*[F.try_element_at(F.col(cells_col), F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def promote_headers_by_sheet(sheets: DataFrame, sheet_col: str = "sheet", row_col: str = "row_no",
                             cells_col: str = "cells") -> DataFrame:
    """A4 per sheet at once: ``(sheet, <header name>, <value>)`` long rows.

    The header of each sheet is found with a window over sheet (one row per
    sheet survives), then joined back; no per-sheet job.
    """
    first = (sheets.groupBy(sheet_col).agg(F.min_by(cells_col, row_col).alias("__hdr"),
                                             F.min(row_col).alias("__r0")))
    j = sheets.join(first, sheet_col).where(F.col(row_col) > F.col("__r0"))
    pos = F.posexplode(F.col("__hdr"))
    return (j.select(sheet_col, row_col, cells_col, pos.alias("__i", "__name"))
            .select(sheet_col, row_col, F.btrim(F.col("__name")).alias("column"),
                    F.try_element_at(F.col(cells_col), F.col("__i") + 1).alias("value")))
