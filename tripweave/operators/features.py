"""Calendar and time-of-day features, and the fixed schema of linked segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.columns import day_fraction

# The stored form of a linked segment.
LINKED_SCHEMA = T.StructType(
    [
        T.StructField("vehicle_id", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("first_stop", T.LongType()),
        T.StructField("exit_stop", T.LongType()),
        T.StructField("target_stop", T.LongType()),
        T.StructField("total_distance", T.DoubleType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("exit_time", T.DoubleType()),
        T.StructField("arrive_time", T.DoubleType()),
        T.StructField("service_date", T.DateType()),
    ]
)

CALENDAR = ["month", "day_of_month", "day_of_week"]


def calendar_features(df: DataFrame) -> DataFrame:
    """Month, day of month, and day of week counted from Monday = 0."""
    return df.select(
        "*",
        F.month("service_date").alias("month"),
        F.dayofmonth("service_date").alias("day_of_month"),
        F.weekday("service_date").alias("day_of_week"),
    )


def time_fractions(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        day_fraction(F.col("exit_us")).alias("exit_time"),
        day_fraction(F.col("arrive_us")).alias("arrive_time"),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def linked_features(linked: DataFrame) -> DataFrame:
    complete = linked.dropna(subset=["first_stop"])
    return conform(time_fractions(calendar_features(complete)), LINKED_SCHEMA)
