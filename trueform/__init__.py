"""trueform: conform messy tables to a declared target spec on Spark DataFrames.

Layout
------
plans/      target spec model (B), gated conform run (I)
functions/  Column builders for single cells (F), similarity, dates, states
operators/  reshaping (D), expectations (C), value mappings (E),
            row filters and dedupe (G), reports (H)
sources/    scans and sinks (A)
streaming/  incremental conform of a file stream
"""

from trueform.plans.spec import FieldSpec, TableSpec, load_spec

__all__ = ["FieldSpec", "TableSpec", "load_spec"]
