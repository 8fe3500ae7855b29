"""Commute windows, short and long feature views, their union, and speeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.features import CALENDAR

# Day fractions of the commute window, metres per second, model columns.
COMMUTE_FROM = 0.291
COMMUTE_TO = 0.458
SLOWEST = 1
SHORT_FEATURES = ["day_of_week", "exit_time", "distance", "exit_stop", "target_stop"]
LONG_FEATURES = ["day_of_week", "first_time", "total_distance", "first_stop", "target_stop"]
TUNING_FEATURES = ["day_of_week", "total_speed", "first_stop", "target_stop", "total_distance", "first_time"]

# Features with few different values, of which trees can try every cut.
STOP_FEATURES = ["day_of_week", "distance", "first_stop", "exit_stop", "target_stop"]

# Chronological order of segments. Vehicle and distances make it total but for identical rows.
CHRONOLOGICAL = [
    "service_date",
    "exit_time",
    "label",
    "exit_stop",
    "target_stop",
    "vehicle_id",
    "first_stop",
    "first_time",
    "distance",
    "total_distance",
]


def chronological(df: DataFrame) -> DataFrame:
    """Globally sorted; range-partitioned on the whole key, so one busy day or second can be split."""
    return df.orderBy(*[c for c in CHRONOLOGICAL if c in df.columns])


def commute_by_arrival(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").between(COMMUTE_FROM, COMMUTE_TO))


def commute_by_both(df: DataFrame) -> DataFrame:
    return df.filter((F.col("exit_time") >= COMMUTE_FROM) & (F.col("label") <= COMMUTE_TO))


# The columns of the short view, and what the long view shows under their names.
VIEW_COLUMNS = ["exit_time", "exit_stop", "distance", "target_stop", "label"]
LONG_SOURCE = {"exit_time": "first_time", "exit_stop": "first_stop", "distance": "total_distance"}
UNION_ORDER = ["exit_time", "label", "exit_stop", "target_stop", "distance"]


def _view(df: DataFrame, source: dict[str, str], *leading: str) -> DataFrame:
    return df.select(*leading, *[F.col(source.get(c, c)).alias(c) for c in VIEW_COLUMNS])


def short_view(df: DataFrame) -> DataFrame:
    """Stop to next stop."""
    return _view(df, {}, *CALENDAR)


def long_view(df: DataFrame) -> DataFrame:
    """First stop of the trip to the stop reached, under the column names of the short view."""
    return _view(df, LONG_SOURCE, *CALENDAR)


def short_long_union(df: DataFrame) -> DataFrame:
    """Both views together without the repeated rows of a day, in time order, the day itself dropped."""
    return both_views(df).orderBy("service_date", *UNION_ORDER).drop("service_date")


def both_views(df: DataFrame) -> DataFrame:
    """Both views with their day, each row of a day once."""
    days = ["service_date", "day_of_week"]
    return _view(df, {}, *days).unionByName(_view(df, LONG_SOURCE, *days)).dropDuplicates()


def add_speeds(df: DataFrame) -> DataFrame:
    """Mean speeds since the last stop and since the trip start, in m/s with two decimals."""
    return df.withColumns(
        {
            "speed": F.round(F.try_divide("distance", F.col("label") - F.col("exit_time")), 2),
            "total_speed": F.round(F.try_divide("total_distance", F.col("label") - F.col("first_time")), 2),
        }
    )


def drop_slow(df: DataFrame) -> DataFrame:
    return df.filter(F.col("speed") > SLOWEST)


def feature_view(df: DataFrame, features: list[str]) -> DataFrame:
    return df.select(*features, "label")
