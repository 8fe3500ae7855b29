"""Modal-distance cleaning: per day and pair of stops, keep the most frequent rounded distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.columns import nearest_ten

TRIP_DAY = ["service_date", "exit_stop", "target_stop"]


def round_distances(segments: DataFrame) -> DataFrame:
    return segments.withColumn("distance", nearest_ten(F.col("distance")))


def trip_modes(rounded: DataFrame) -> DataFrame:
    """The most frequent distance of every trip and day, the smallest one on a tie.

    Counting comes first and before the shuffle, so a trip reaches the ranking as at most one row per
    ten metres, however busy it is. (``F.mode`` gives the same, at over twice the time.)
    """
    counted = rounded.groupBy(*TRIP_DAY, "distance").agg(F.count("*").alias("_n"))
    by_count = Window.partitionBy(*TRIP_DAY).orderBy(F.desc("_n"), "distance")
    ranked = counted.withColumn("_rank", F.row_number().over(by_count))
    return ranked.filter("_rank = 1").select(*TRIP_DAY, "distance")


def keep_modal(rounded: DataFrame, modes: DataFrame) -> DataFrame:
    """Segments whose rounded distance is their trip's mode.

    Rounded distances less than ten metres apart are equal, so being within ten metres of the mode
    is equality, and a semi join does it. It leaves a busy trip where it is when ``modes`` is small
    enough to broadcast, and lets the planner split it otherwise.
    """
    return rounded.join(modes, [*TRIP_DAY, "distance"], "left_semi")
