"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a session on one machine (``local`` master) names none, a temporary folder is
    set once as its checkpoint folder and used from then on. On a cluster that is an error:
    executors could not read what the driver's machine holds.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    kept = spark.sparkContext.getCheckpointDir()
    if kept is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='kinloom-')}")
        kept = spark.sparkContext.getCheckpointDir()
    return kept


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver's process ends."""
    path = f"{shared_dir(spark).rstrip('/')}/kinloom-{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Lineage ends at replicated files rather than at one executor's blocks, so a
    lost executor costs a re-read and never a recomputation. The table is deleted when
    the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
