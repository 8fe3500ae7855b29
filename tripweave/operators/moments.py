"""Fits that can be put together: moments per day, merged instead of reading the rows again.

A state holds count, mean, sum of squared distances from the mean, minimum and maximum of a column on a day. States of
any days merge into that of all their rows; leaving a day out is merging one state fewer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.operators.scaling import Bounds, ZScore

STATE = ["feature", "n", "mean", "m2", "low", "high"]


def day_moments(df: DataFrame, columns: list[str], day: str = "service_date") -> DataFrame:
    """One row per day and column with a value: its state. One aggregation; nulls do not count."""
    measured = {c: F.col(c).cast("double") for c in columns}
    states = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("low"),
            F.max(x).alias("high"),
        )
        for c, x in measured.items()
    ]
    days = df.groupBy(day).agg(F.array(*states).alias("states"))
    return days.select(day, F.inline("states")).filter(F.col("n") > 0)


def merged(states: DataFrame) -> DataFrame:
    """One state per column, of the rows of all given states."""
    own = Window.partitionBy("feature")
    centre = F.sum(F.col("n") * F.col("mean")).over(own) / F.sum("n").over(own)
    return (
        states.withColumn("centre", centre)
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n"),
            F.first("centre").alias("mean"),
            F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("m2"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .select(*STATE)
    )


def write_moments(states: DataFrame, path: str, day: str = "service_date") -> None:
    """Store states in one folder per day; days that are there already are replaced."""
    writer = states.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)


def zscore_of(states: DataFrame) -> ZScore:
    """The z-score scaler of the rows of all given states; one row per column comes to the driver."""
    rows = merged(states).collect()
    deviation = {r["feature"]: (max(r["m2"], 0.0) / r["n"]) ** 0.5 or 1.0 for r in rows}
    return ZScore({r["feature"]: r["mean"] for r in rows}, deviation)


def bounds_of(states: DataFrame, column: str) -> Bounds:
    """The range of a column over the rows of all given states."""
    row = merged(states.filter(F.col("feature") == column)).first()
    return Bounds(row["low"], row["high"])
