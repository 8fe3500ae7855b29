"""Stop-to-stop segments from de-duplicated pings, with windows over one vehicle-day.

A pair of consecutive pings either resets the vehicle's chain of stop crossings, is ignored, or
yields one crossing. Segments join neighbouring crossings of a chain whose distance is plausible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripweave.functions.columns import crossing_micros, parse_stop
from tripweave.operators.cleaning import VEHICLE_DAY

# Metres per second, metres.
MIN_SPEED = 0.1
MAX_SPEED = 20
MIN_SEGMENT = 100
MAX_SEGMENT = 2000

RESETTING = ["backward", "inconsistent", "overshoot", "implausible"]


def by_time() -> WindowSpec:
    return Window.partitionBy(*VEHICLE_DAY).orderBy("second_of_day")


def up_to_here() -> WindowSpec:
    return by_time().rowsBetween(Window.unboundedPreceding, 0)


def before_here() -> WindowSpec:
    return by_time().rowsBetween(Window.unboundedPreceding, -1)


def ping_pairs(pings: DataFrame) -> DataFrame:
    """Every ping side by side with the vehicle's next one of the day."""
    return pings.select(
        "*",
        F.lead("second_of_day").over(by_time()).alias("next_second"),
        F.lead("distance_along_trip").over(by_time()).alias("next_distance"),
        F.lead("next_scheduled_stop_distance").over(by_time()).alias("next_stop_distance"),
        F.lead("next_scheduled_stop_id").over(by_time()).alias("next_stop_id"),
    ).filter(F.col("next_second").isNotNull())


def classify_pairs(pairs: DataFrame) -> DataFrame:
    """Add the metres travelled (``gap``), the ``speed`` and the ``pair_kind``.

    After an inconsistent pair the next pair is swallowed; going backward in between does not
    use that up, hence the last non-null marker.
    """
    ahead = F.col("next_scheduled_stop_distance")
    backward = F.col("gap") < 0
    same_stop = F.col("next_scheduled_stop_id") == F.col("next_stop_id")
    inconsistent = same_stop & (F.rint("gap") != F.rint(ahead - F.col("next_stop_distance")))
    marker = F.when(~backward, F.when(inconsistent, 1).otherwise(0))
    swallowed = F.coalesce(F.last(marker, ignorenulls=True).over(before_here()), F.lit(0)) == 1
    kind = (
        F.when(backward, "backward")
        .when(inconsistent, "inconsistent")
        .when(swallowed, "swallowed")
        .when(same_stop, "same_stop")
        .when(ahead > F.col("gap"), "overshoot")
        .when(~F.col("speed").between(MIN_SPEED, MAX_SPEED), "implausible")
        .otherwise("crossing")
    )
    gap = F.col("next_distance") - F.col("distance_along_trip")
    return (
        pairs.withColumn("gap", gap)
        .withColumn("speed", F.col("gap") / (F.col("next_second") - F.col("second_of_day")))
        .withColumn("pair_kind", kind)
    )


def stop_crossings(classified: DataFrame) -> DataFrame:
    """When and where each stop was passed, numbered by the chain (``chain_no``) it belongs to."""
    resets = F.when(F.col("pair_kind").isin(RESETTING), 1).otherwise(0)
    ahead = F.col("next_scheduled_stop_distance")
    return (
        classified.withColumn("chain_no", F.sum(resets).over(up_to_here()))
        .filter(F.col("pair_kind") == "crossing")
        .select(
            *VEHICLE_DAY,
            "second_of_day",
            "chain_no",
            F.col("next_scheduled_stop_id").alias("stop_id"),
            crossing_micros(F.col("second_of_day"), ahead / F.col("speed")).alias("crossed_us"),
            "distance_along_trip",
            ahead.alias("metres_before"),
            (F.col("gap") - ahead).alias("metres_past"),
            F.col("next_distance").alias("metres_along"),
        )
    )


def chain_segments(crossings: DataFrame) -> DataFrame:
    """Segments between neighbouring crossings, stop ids still as text.

    An implausible distance breaks the chain without starting a new one, so the crossing after it
    only starts one. In a row of implausible crossings every second one is such a start: a plausible
    crossing closes a segment iff an even number of implausible ones lies before it.
    """
    same_chain = F.lag("chain_no").over(by_time()) == F.col("chain_no")
    distance = (
        F.lag("metres_past").over(by_time())
        + F.col("distance_along_trip")
        - F.lag("metres_along").over(by_time())
        + F.col("metres_before")
    )
    return (
        crossings.withColumn("nth", F.row_number().over(by_time()))
        .withColumn("joined", F.coalesce(same_chain, F.lit(False)))
        .withColumn("distance", distance)
        .withColumn("exit_stop_id", F.lag("stop_id").over(by_time()))
        .withColumn("exit_us", F.lag("crossed_us").over(by_time()))
        .withColumn("plausible", ~F.col("joined") | F.col("distance").between(MIN_SEGMENT, MAX_SEGMENT))
        .withColumn("last_plausible", F.max(F.when(F.col("plausible"), F.col("nth"))).over(before_here()))
        .filter(F.col("joined") & F.col("plausible") & ((F.col("nth") - 1 - F.col("last_plausible")) % 2 == 0))
        .select(
            *VEHICLE_DAY,
            "exit_stop_id",
            F.col("stop_id").alias("target_stop_id"),
            "distance",
            "exit_us",
            F.col("crossed_us").alias("arrive_us"),
        )
    )


def number_stops(chained: DataFrame) -> DataFrame:
    return chained.select(
        *VEHICLE_DAY,
        parse_stop(F.col("exit_stop_id")).alias("exit_stop"),
        parse_stop(F.col("target_stop_id")).alias("target_stop"),
        "distance",
        "exit_us",
        "arrive_us",
    )


def build_segments(crossings: DataFrame) -> DataFrame:
    return number_stops(chain_segments(crossings)).dropna(subset=["exit_stop", "target_stop"])


def segment_rejects(crossings: DataFrame) -> DataFrame:
    """Segments that cannot be used because a stop id has no number, with the column it is in."""
    return chain_rejects(chain_segments(crossings))


def chain_rejects(chained: DataFrame) -> DataFrame:
    reason = F.when(parse_stop(F.col("exit_stop_id")).isNull(), "exit_stop_id").when(
        parse_stop(F.col("target_stop_id")).isNull(), "target_stop_id"
    )
    return chained.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def segments_of(pings: DataFrame) -> DataFrame:
    """De-duplicated pings to segments, in the vehicle-day partitioning the pings already have."""
    return build_segments(stop_crossings(classify_pairs(ping_pairs(pings))))
