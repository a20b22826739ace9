"""Incremental conform of a file stream (optional extension of I4).

The row-local part of processing (cells, required split) is stateless, so each
micro-batch is conformed with :func:`trueform.operators.process.process` inside
``foreachBatch``. Keep-none dedupe (G3) is not append-monotone: a later batch may
repeat a key already written. The stream therefore writes every copy, and
:func:`settle` drops repeated keys over the whole sink, as the batch job does. The
sink is idempotent per batch id (overwrite of ``batch_id=<n>``), so a restarted
query that replays a batch does not duplicate rows.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trueform.operators import rows
from trueform.operators.process import process
from trueform.plans.spec import TableSpec


def conform_stream(spark: SparkSession, source: DataFrame, spec: TableSpec, out_dir: str, checkpoint: str,
                   mappings: DataFrame | Mapping | None = None, available_now: bool = True) -> StreamingQuery:
    """Start a streaming conform: ``source`` is a ``readStream`` frame of text columns."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        res = process(batch, spec, mappings, materialize="persist", dedupe=False)
        tag = F.lit(batch_id).alias("batch_id")
        for name, frame in (("conformed", res.conformed), ("dropped", res.dropped), ("invalid", res.invalid)):
            (frame.select("*", tag).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{out_dir}/{name}"))
        res.unpersist()

    writer = source.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def settle(spark: SparkSession, spec: TableSpec, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): the sink's conformed rows, less every copy of a repeated key of any batch."""
    conformed = spark.read.parquet(f"{out_dir}/conformed").drop("batch_id")
    keys = [k for k in spec.primary_key if k in conformed.columns]
    if not keys:
        return conformed, conformed.limit(0).withColumn("drop_kind", F.lit("duplicate"))
    return rows.keep_none_dedupe(conformed, keys)
