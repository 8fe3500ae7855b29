"""Pings to linked segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.cleaning import clean_pings, dedup_pings, ping_rejects, type_pings
from tripweave.operators.features import linked_features
from tripweave.operators.linking import link_routes
from tripweave.operators.modal import keep_modal, round_distances, trip_modes
from tripweave.operators.segments import (
    chain_rejects,
    chain_segments,
    classify_pairs,
    number_stops,
    ping_pairs,
    segment_rejects,
    segments_of,
    stop_crossings,
)
from tripweave.session import stage


def deduped(pings: DataFrame) -> DataFrame:
    """Clean pings, each vehicle-day in one partition."""
    return dedup_pings(clean_pings(pings))


def crossings(pings: DataFrame) -> DataFrame:
    return stop_crossings(classify_pairs(ping_pairs(deduped(pings))))


def segments(pings: DataFrame) -> DataFrame:
    return segments_of(deduped(pings))


def modal_segments(pings: DataFrame) -> DataFrame:
    """Segments at their trip's modal distance.

    The segments are read twice, for the modes and for the filter, so they are staged. The modes are
    staged as well: the planner then knows whether they are small enough to broadcast.
    """
    return modal_of(stage(segments(pings), "segments"))


def modal_of(stored: DataFrame) -> DataFrame:
    """Stored segments at their trip's modal distance."""
    rounded = round_distances(stored)
    return keep_modal(rounded, stage(trip_modes(rounded), "trip-modes"))


def linked(pings: DataFrame) -> DataFrame:
    """The whole daily build: one plan over all days, ready for ``write_linked``."""
    return linked_features(link_routes(modal_segments(pings)))


def build(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Linked segments of all-text pings and what can't be used, from one computation of the segments.

    The chains are stored with their stop ids as text: those with numbers go on, the others are rejects.
    """
    chained = stage(chain_segments(crossings(type_pings(raw))), "chains")
    numbered = number_stops(chained).dropna(subset=["exit_stop", "target_stop"])
    kept = linked_features(link_routes(modal_of(numbered)))
    return kept, as_records([("ping", ping_rejects(raw)), ("segment", chain_rejects(chained))])


def as_records(found: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rejects of several steps as step, reason and record in JSON."""
    rows = [
        df.select(
            F.lit(step).alias("step"),
            "reason",
            F.to_json(F.struct(*[c for c in df.columns if c != "reason"])).alias("record"),
        )
        for step, df in found
    ]
    return reduce(DataFrame.unionByName, rows)


def rejects(raw: DataFrame) -> DataFrame:
    """What the daily build can't use of all-text pings: the step, the reason, and the record as JSON."""
    return as_records([("ping", ping_rejects(raw)), ("segment", segment_rejects(crossings(type_pings(raw))))])
