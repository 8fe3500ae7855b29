"""Linked segments to model input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.encoding import STOP_COLUMNS, encode_ids, stop_dictionary, vehicle_dictionary
from tripweave.operators.scaling import DEFAULT_DISTANCE_BOUNDS, Bounds, fit_bounds, minmax_scale, unscale
from tripweave.operators.splits import Ordered, in_order
from tripweave.operators.trip_start import trip_starts
from tripweave.operators.views import add_speeds, commute_by_arrival, drop_slow
from tripweave.session import stage


def encoded(linked: DataFrame) -> DataFrame:
    """Ids as 1..N. Pass a stored table: the dictionaries are collected from it first."""
    stops = stage(stop_dictionary(linked), "stop-dictionary")
    vehicles = stage(vehicle_dictionary(linked), "vehicle-dictionary")
    return encode_ids(linked, stops, vehicles)


def rejects(linked: DataFrame) -> DataFrame:
    """Linked segments that can't be placed or encoded, with the first column that is missing."""
    reason = F.lit(None).cast("string")
    for c in reversed(["vehicle_id", "service_date", *STOP_COLUMNS]):
        reason = F.when(F.col(c).isNull(), c).otherwise(reason)
    return linked.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def scaled(linked: DataFrame) -> tuple[DataFrame, Bounds]:
    """Encoded and scaled segments, and the bounds that undo the scaling."""
    bounds = fit_bounds(linked)
    return minmax_scale(encoded(linked), bounds), bounds


def started(linked: DataFrame) -> tuple[DataFrame, Bounds]:
    """Scaled segments with their trip start. One exchange serves the rows and the summaries of their days."""
    rows, bounds = scaled(linked)
    return trip_starts(rows), bounds


def model_rows(commute: DataFrame, bounds: Bounds = DEFAULT_DISTANCE_BOUNDS) -> DataFrame:
    """Segments in metres and seconds, with speeds, without slow ones."""
    return drop_slow(add_speeds(unscale(commute, bounds)))


def model_input(started_rows: DataFrame, bounds: Bounds = DEFAULT_DISTANCE_BOUNDS) -> DataFrame:
    return model_rows(commute_by_arrival(started_rows), bounds)


def stored_input(linked: DataFrame) -> DataFrame:
    """The model input, stored in no order. Pass a stored table, as above."""
    rows, bounds = started(linked)
    return stage(model_input(rows, bounds), "model-input")


def model_table(linked: DataFrame) -> Ordered:
    """The model input, stored in time order; splits and fits read it several times.

    It is stored before it is ordered, as the ranges of the order are found by a pass of their own over the rows.
    """
    return in_order(stored_input(linked))
