"""Pings derived from an order-line table: a fixture for the registered queries and the tests.

Every supplier becomes a vehicle and its lines, in shipping order, become pings: 200 a day in four
trips. Whole-number arithmetic on the line's keys places phase changes, gaps, standstills, speeding,
contradictory distances and circular routes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.functions.columns import SECONDS_PER_DAY
from tripweave.operators.ordinal import sliced_ordinal

START = "2014-08-01 06:00:00"
# Lines that tie in these have the same mixing number, so which of them comes first changes no ping.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey"]
# A vehicle with more lines than this is numbered slice by slice; one task sorts any other.
MOST_LINES = 2_000_000


def lines_of(lineitem: DataFrame) -> DataFrame:
    """Lines without supplier or shipping time give no ping."""
    lines = lineitem.select(
        F.col("l_suppkey").cast("bigint").alias("vehicle_id"), "l_shipdate", *LINE_ORDER
    )
    return lines.filter(F.col("vehicle_id").isNotNull() & F.col("l_shipdate").isNotNull())


def _mixed(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "vehicle_id",
        (F.col("nth") - 1).alias("n"),
        (F.col("l_orderkey") * 7 + F.col("l_partkey") * 13 + F.col("l_linenumber") * 31).alias("h"),
    )


def numbered_lines(lines: DataFrame) -> DataFrame:
    """The ``n``-th line (from 0) of each vehicle, and the line's mixing number ``h``; a vehicle lies in one partition."""
    in_time = Window.partitionBy("vehicle_id").orderBy("l_shipdate", *LINE_ORDER)
    return _mixed(lines.withColumn("nth", F.row_number().over(in_time)))


def sliced_lines(lines: DataFrame) -> DataFrame:
    """The same for vehicles with more lines than one task should sort."""
    # Slices of a quarter: short enough for a vehicle with many lines, long enough for far fewer counts than lines.
    lines = lines.withColumn("quarter", F.year("l_shipdate") * 4 + F.quarter("l_shipdate"))
    return _mixed(sliced_ordinal(lines, ["vehicle_id"], "quarter", ["l_shipdate", *LINE_ORDER], "nth"))


def travelled(numbered: DataFrame) -> DataFrame:
    """Numbered lines with their day and trip, the metres since its start and the stop ahead. Lines that are numbered
    by vehicle stay where they are; the others are spread over trips."""
    h, n, vehicle = F.col("h"), F.col("n"), F.col("vehicle_id")
    spacing = F.element_at(F.array(*[F.lit(s) for s in (80, 150, 300, 450, 600)]), (vehicle % 5 + 1).cast("int"))
    step = F.when(h % 37 == 0, 0).when(h % 29 == 0, 900).otherwise(40 + h % 200)
    trip = Window.partitionBy("vehicle_id", "day_no", "trip_no").orderBy("n")
    return (
        numbered.withColumn("day_no", F.floor(n / 200))
        .withColumn("trip_no", F.floor((n % 200) / 50))
        .withColumn("spacing", spacing)
        .withColumn("d", F.sum(step).over(trip.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("stop_no", F.floor(F.col("d") / F.col("spacing")) + 1)
    )


def pings_from_lines(lineitem: DataFrame) -> DataFrame:
    lines = lines_of(lineitem)
    counted = lines.groupBy("vehicle_id").agg(F.count("*").alias("lines"))
    # At most one for every MOST_LINES lines.
    long = [r["vehicle_id"] for r in counted.filter(F.col("lines") > MOST_LINES).select("vehicle_id").collect()]
    rows = travelled(numbered_lines(lines if not long else lines.filter(~F.col("vehicle_id").isin(long))))
    if long:
        rows = rows.unionByName(travelled(sliced_lines(lines.filter(F.col("vehicle_id").isin(long)))))
    h, n, vehicle, stop_no, d = (F.col(c) for c in ("h", "n", "vehicle_id", "stop_no", "d"))
    circular = (vehicle % 5 == 4) & (vehicle % 10 == 4)
    ahead = stop_no * F.col("spacing") - d + F.when(h % 17 == 0, 25).otherwise(0)
    stop = 100000 + (vehicle % 5) * 1000 + F.when(circular, stop_no % 4).otherwise(stop_no)
    return rows.select(
        "vehicle_id",
        (
            F.lit(START).cast("timestamp_ntz")
            + F.expr("INTERVAL '1' SECOND") * (F.col("day_no") * SECONDS_PER_DAY + (n % 200) * 50 + h % 7)
        ).alias("time_received"),
        d.cast("double").alias("distance_along_trip"),
        F.when(h % 23 == 0, "LAYOVER_DURING").otherwise("IN_PROGRESS").alias("inferred_phase"),
        F.when(h % 41 != 0, ahead.cast("double")).alias("next_scheduled_stop_distance"),
        F.concat(F.lit("MTA_"), stop.cast("string")).alias("next_scheduled_stop_id"),
    )


def sample_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pings_from_lines(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
