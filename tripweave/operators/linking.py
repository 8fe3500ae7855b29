"""Route linking: which first stop every segment of a vehicle-day belongs to, and how far along it is.

A route starts at a stop the vehicle leaves but never reaches that day. A stop belongs to the route
that reaches it in the fewest hops; ties go to the smaller first stop, then the shorter way. Routes
have any number of hops: a stop is claimed once, so the walk ends.

``link_routes`` walks whole vehicle-days; the relational steps (roots, frontier, claims) are the same
rules one hop at a time and serve as its cross-check.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.operators.cleaning import VEHICLE_DAY

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STOP_OF_DAY = [*VEHICLE_DAY, "stop"]


def _stops(segments: DataFrame, column: str) -> DataFrame:
    return segments.select(*VEHICLE_DAY, F.col(column).alias("stop"))


def route_roots(segments: DataFrame) -> DataFrame:
    """Stops a vehicle leaves but never reaches on a day."""
    return _stops(segments, "exit_stop").distinct().join(_stops(segments, "target_stop"), STOP_OF_DAY, "left_anti")


def root_claims(segments: DataFrame) -> DataFrame:
    """Each root as the first stop of its own route, at distance zero."""
    return route_roots(segments).select(
        *STOP_OF_DAY, F.col("stop").alias("first_stop"), F.lit(0.0).alias("base_distance")
    )


def frontier_segments(segments: DataFrame, claims: DataFrame) -> DataFrame:
    """Segments that leave a claimed stop, with their route and cumulative distance."""
    claimed = claims.withColumnRenamed("stop", "exit_stop")
    return segments.join(claimed, [*VEHICLE_DAY, "exit_stop"]).select(
        *[segments[c] for c in segments.columns],
        "first_stop",
        (F.col("distance") + F.col("base_distance")).alias("total_distance"),
    )


def next_claims(frontier: DataFrame, claims: DataFrame) -> DataFrame:
    """Stops the frontier reaches first, each claimed by the smallest first stop, then the shortest way."""
    reached = frontier.groupBy(*VEHICLE_DAY, F.col("target_stop").alias("stop")).agg(
        F.min(F.struct("first_stop", "total_distance")).alias("claim")
    )
    return reached.join(claims, STOP_OF_DAY, "left_anti").select(
        *STOP_OF_DAY,
        F.col("claim.first_stop").alias("first_stop"),
        F.col("claim.total_distance").alias("base_distance"),
    )


def link_routes(segments: DataFrame) -> DataFrame:
    """Add ``first_stop`` and ``total_distance``; segments no route reaches are dropped.

    The hops of one vehicle-day depend on each other, so each vehicle-day is finished inside one
    task. A vehicle-day has at most one ping per second and so at most 86,400 segments. Many of them
    are walked together, one hop at a time, on the Arrow batches of a partition.
    """
    schema = T.StructType(
        [
            *segments.schema.fields,
            T.StructField("first_stop", T.LongType()),
            T.StructField("total_distance", T.DoubleType()),
        ]
    )
    return (
        segments.repartition(*VEHICLE_DAY)
        .sortWithinPartitions(*VEHICLE_DAY)
        .mapInArrow(_link_batches, schema)
    )


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the sorted stream of a partition at vehicle-day borders and link what is complete."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        starts = np.flatnonzero(_day_starts(table))
        held = table.slice(starts[-1])
        yield from _link_table(table.slice(0, starts[-1]))
    if held is not None:
        yield from _link_table(held)


def _day_starts(table: pa.Table) -> np.ndarray:
    vehicle = table["vehicle_id"].to_numpy()
    day = table["service_date"].cast(pa.int32()).to_numpy()
    starts = np.ones(len(vehicle), dtype=bool)
    starts[1:] = (vehicle[1:] != vehicle[:-1]) | (day[1:] != day[:-1])
    return starts


def _link_table(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if table.num_rows == 0:
        return
    group = np.cumsum(_day_starts(table)) - 1
    first_stop, total, reached = _walk(
        group,
        table["exit_stop"].to_numpy(),
        table["target_stop"].to_numpy(),
        table["distance"].to_numpy(),
    )
    linked = table.append_column("first_stop", pa.array(first_stop)).append_column("total_distance", pa.array(total))
    yield from linked.filter(pa.array(reached)).to_batches()


def _walk(group, exit_stop, target_stop, distance):
    """Breadth-first over all vehicle-days at once; a node is a (vehicle-day, stop)."""
    n = len(group)
    stops, code = np.unique(np.concatenate([exit_stop, target_stop]), return_inverse=True)
    nodes, node = np.unique(np.concatenate([group, group]) * len(stops) + code, return_inverse=True)
    source, target = node[:n], node[n:]

    route = np.zeros(len(nodes), dtype=np.int64)
    base = np.zeros(len(nodes))
    claimed = np.zeros(len(nodes), dtype=bool)
    claimed[source] = True
    claimed[target] = False
    route[claimed] = stops[nodes[claimed] % len(stops)]

    first_stop = np.zeros(n, dtype=np.int64)
    total = np.zeros(n)
    reached = np.zeros(n, dtype=bool)
    frontier = claimed.copy()
    while len(leaving := np.flatnonzero(frontier[source])):
        first_stop[leaving] = route[source[leaving]]
        total[leaving] = distance[leaving] + base[source[leaving]]
        reached[leaving] = True

        fresh = leaving[~claimed[target[leaving]]]
        best = fresh[np.lexsort((total[fresh], first_stop[fresh], target[fresh]))]
        stop, at = np.unique(target[best], return_index=True)
        route[stop] = first_stop[best[at]]
        base[stop] = total[best[at]]
        claimed[stop] = True
        frontier[:] = False
        frontier[stop] = True
    return first_stop, total, reached
