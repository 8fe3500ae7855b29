"""Parquet datasets: reading, day-partitioned writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.operators.features import LINKED_SCHEMA, conform


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder or glob."""
    return spark.read.parquet(path)


def write_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_linked(linked: DataFrame, path: str) -> None:
    """Linked segments in their fixed schema, one folder per day.

    Replaces the days present in ``linked`` and leaves the others. The rebalance gathers each day
    into few files and cuts a large day into several.
    """
    (
        conform(linked, LINKED_SCHEMA)
        .hint("rebalance", "service_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("service_date")
        .parquet(path)
    )
