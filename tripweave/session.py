"""Session set-up and staged intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
# Where a local session stages if its configuration names no folder: all its threads share the machine.
ONE_MACHINE = "/tmp/tripweave-shared"


def local_session(app_name: str = "tripweave", cores: str = "8") -> SparkSession:
    """A single-JVM session for tests and the bench. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get(SHARED, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {SHARED} to a folder shared by all executors")
    return ONE_MACHINE


def scratch_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Cuts the lineage, survives lost executors, and gives the planner the true
    size of small tables, so that it broadcasts them only when they really are small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete all tables this application has staged. Results that still read them are lost: jobs call this
    when they have written theirs."""
    delete(spark, scratch_dir(spark))
