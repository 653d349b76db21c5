"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, name: str = "tallyloom") -> SparkSession:
    """A single-machine session; a cluster brings its own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Without call-site capture a plan of many columns is built about twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Root of scratch tables: ``spark.checkpoint.dir`` when the session names one, else the warehouse.

    Both are folders of the session's file system that the driver and all executors reach; a local folder of
    one machine is never chosen.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one table or stream checkpoint; it goes when the session ends."""
    path = f"{shared_dir(spark)}/tallyloom/{label}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write a table that is read more than once as Parquet to the shared folder and read it from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
