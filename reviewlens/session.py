"""Session construction and the shared folder used for written intermediates."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that must be fixed before the session exists or that every job here
# relies on. Sizing (executors, cores, memory, shuffle partitions) is left to
# the cluster; adaptive execution coalesces and splits shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "reviewlens",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints and written intermediates.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local session that
    leaves it unset gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="reviewlens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return os.path.join(
        shared_folder(spark), "reviewlens", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}"
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage in storage every executor reaches, so a lost executor
    never recomputes what lies before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
