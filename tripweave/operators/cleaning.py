"""Ping cleaning: typing, phase filter, null drop, and the chained keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.columns import parse_stop, parse_time, parse_whole, second_of_day

# Fixed values.
IN_PROGRESS = "IN_PROGRESS"
PING_COLUMNS = [
    "time_received",
    "vehicle_id",
    "distance_along_trip",
    "inferred_phase",
    "next_scheduled_stop_distance",
    "next_scheduled_stop_id",
]

VEHICLE_DAY = ["vehicle_id", "service_date"]

# Survivors of each step enter the next one.
DEDUP_KEYS = [
    ["distance_along_trip"],
    ["second_of_day"],
    ["next_scheduled_stop_distance", "next_scheduled_stop_id"],
]
ARRIVAL_ORDER = [
    "second_of_day",
    "next_scheduled_stop_id",
    "next_scheduled_stop_distance",
    "distance_along_trip",
]


def type_pings(raw: DataFrame) -> DataFrame:
    """All-text pings to typed pings. Values that do not parse become null."""
    return raw.select(
        parse_whole(F.col("vehicle_id")).alias("vehicle_id"),
        parse_time(F.col("time_received")).alias("time_received"),
        F.col("distance_along_trip").try_cast("double").alias("distance_along_trip"),
        F.col("inferred_phase"),
        F.col("next_scheduled_stop_distance").try_cast("double").alias("next_scheduled_stop_distance"),
        F.col("next_scheduled_stop_id"),
    )


def reject_reason():
    """Why an all-text ping cannot be used although no value is missing; null if it can.

    Stop ids are not looked into here: they matter only where a segment starts or ends.
    """
    return (
        F.when(parse_whole(F.col("vehicle_id")).isNull(), "vehicle_id")
        .when(parse_time(F.col("time_received")).isNull(), "time_received")
        .when(F.col("distance_along_trip").try_cast("double").isNull(), "distance_along_trip")
        .when(F.col("next_scheduled_stop_distance").try_cast("double").isNull(), "next_scheduled_stop_distance")
    )


def ping_rejects(raw: DataFrame) -> DataFrame:
    """Complete in-progress pings holding a value that does not parse, with the first such column."""
    complete = raw.filter(F.col("inferred_phase") == IN_PROGRESS).dropna(subset=PING_COLUMNS)
    return complete.withColumn("reason", reject_reason()).filter(F.col("reason").isNotNull())


def clean_pings(pings: DataFrame) -> DataFrame:
    """Complete in-progress pings, with their day and second of day in place of the timestamp."""
    return (
        pings.filter(F.col("inferred_phase") == IN_PROGRESS)
        .dropna(subset=PING_COLUMNS)
        .select(
            "vehicle_id",
            F.to_date("time_received").alias("service_date"),
            second_of_day(F.col("time_received")).alias("second_of_day"),
            "distance_along_trip",
            "next_scheduled_stop_distance",
            "next_scheduled_stop_id",
        )
    )


def keep_first(df: DataFrame, keys: list[str]) -> DataFrame:
    """The earliest row of every vehicle-day and key. Spark also applies the limit before a shuffle."""
    w = Window.partitionBy(*VEHICLE_DAY, *keys).orderBy(*ARRIVAL_ORDER)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def dedup_pings(clean: DataFrame) -> DataFrame:
    """Keep-first by distance, then by time, then by (next stop distance, next stop id).

    The first two steps are spread over (vehicle-day, distance) and (vehicle-day, second); each task
    drops its own repeats before either exchange. They leave a vehicle-day at most one ping per second,
    so the exchange by vehicle-day, which serves every window from here to the segments, has bounded
    groups however many pings a vehicle-day had.
    """
    by_distance, by_second, by_stop = DEDUP_KEYS
    spread = keep_first(keep_first(clean, by_distance), by_second)
    return keep_first(spread.repartition(*VEHICLE_DAY), by_stop)
