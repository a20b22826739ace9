"""Session helpers: sensible defaults, checkpoint folder, materialisation."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "trueform", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # building the wide cell expressions makes thousands of function calls;
        # per-call Python call-site capture doubles their py4j round trips
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # local mode runs every task in the driver JVM; wide plans need heap
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session
    (tests, laptops) without one gets a fresh private folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        path = tempfile.mkdtemp(prefix="trueform-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, how: str | None) -> DataFrame:
    """Materialise a frame that several outputs read.

    ``persist``: executor memory + disk, recomputed from lineage if an executor
    is lost. ``checkpoint``: reliable copy in the shared checkpoint folder,
    lineage cut. ``None``: stay lazy (each output recomputes).
    """
    if how is None or how == "none":
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialisation {how!r}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy row work at least one partition per core.

    A scan with fewer splits than the session's parallelism (a small file with
    one row group) is round-robin repartitioned; a large scan already has
    enough splits and is returned untouched, so no shuffle is added at scale.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    # asking for partitions runs the shuffles of a plan, so only plain scans are asked
    scan = not re.search(r"\b(Join|Aggregate|Window|Sort|Generate|Repartition|RepartitionByExpression|Union|InMemoryRelation)\b",
                         df._jdf.queryExecution().optimizedPlan().toString())
    if not scan or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
