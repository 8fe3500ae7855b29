"""Trip start times: when the vehicle's current run of one first stop began.

The rule looks back over all of a vehicle's days. It is computed in two levels, so that no task needs
all rows of a vehicle: windows within a vehicle-day, and a window over one summary row per day.

What the rule needs of the past is one row per vehicle: the first stop of its last segment and the change
in force. With that state new days are computed from their own rows alone, and leave the next state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripweave.operators.cleaning import VEHICLE_DAY
from tripweave.operators.features import CALENDAR, calendar_features
from tripweave.session import stage

# Within a vehicle-day; only identical rows can tie.
DAY_ORDER = ["exit_time", "label", "exit_stop", "target_stop", "first_stop", "distance", "total_distance"]
OPENING = ["first_stop", "exit_time", "exit_stop"]


def in_day() -> WindowSpec:
    return Window.partitionBy(*VEHICLE_DAY).orderBy(*DAY_ORDER)


def over_days() -> WindowSpec:
    return Window.partitionBy("vehicle_id").orderBy("service_date")


def _day_edges(df: DataFrame) -> DataFrame:
    """Per vehicle-day: the opening row, the closing first stop, and the last change inside the day."""
    order = F.struct(*DAY_ORDER)
    return df.groupBy(*VEHICLE_DAY).agg(
        F.min_by(F.struct(*OPENING), order).alias("opening"),
        F.max_by("first_stop", order).alias("closing_stop"),
        F.max_by("change", F.when(F.col("change").isNotNull(), order)).alias("last_change"),
    )


def _placed_changes(edges: DataFrame) -> DataFrame:
    """Per vehicle-day also the first stop of the row before it, and the latest change from its opening on."""
    previous = F.lag("closing_stop").over(over_days())
    opening_change = F.when(
        F.col("opening.first_stop") != previous,
        F.struct(F.col("opening.exit_time").alias("exit_time"), F.col("opening.exit_stop").alias("exit_stop")),
    )
    return (
        edges.withColumn("previous_stop", previous)
        .withColumn("opening_change", opening_change)
        .withColumn("day_change", F.coalesce("last_change", "opening_change"))
    )


def _carried_in(edges: DataFrame) -> DataFrame:
    """Per vehicle-day: the first stop of the row before it, and the change in force when it opens."""
    earlier = over_days().rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce("opening_change", F.last("day_change", ignorenulls=True).over(earlier))
    return _placed_changes(edges).select(*VEHICLE_DAY, "previous_stop", carried.alias("carried"))


def _as_edges(state: DataFrame, like: DataFrame) -> DataFrame:
    """A state as the edges of a day that ended with it."""
    return state.select(
        "vehicle_id",
        "service_date",
        F.lit(None).cast(like.schema["opening"].dataType).alias("opening"),
        "closing_stop",
        F.col("change").cast(like.schema["last_change"].dataType).alias("last_change"),
    )


def mark_changes(df: DataFrame) -> DataFrame:
    """Add ``change``, the (exit_time, exit_stop) of rows whose first stop differs from the row before,
    within the day."""
    here = F.struct("exit_time", "exit_stop")
    return df.withColumn("change", F.when(F.col("first_stop") != F.lag("first_stop").over(in_day()), here))


def _placed_rows(df: DataFrame) -> DataFrame:
    """Rows with a vehicle and a day, by vehicle-day, with the changes inside the day."""
    placed = F.col("vehicle_id").isNotNull() & F.col("service_date").isNotNull()
    return mark_changes(df.drop(*CALENDAR).filter(placed).repartition(*VEHICLE_DAY))


def _with_latest(marked: DataFrame) -> DataFrame:
    """Add ``latest_here``, the latest change of the day so far."""
    so_far = in_day().rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("latest_here", F.last("change", ignorenulls=True).over(so_far))


def _with_carry(marked: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, which are the marked ones with windows of the day added, with what their day inherits. Both sides of
    the join read one exchange by vehicle-day: for that the calendar columns, which the day gives back, stay out of it.
    Rows without vehicle or day have no place in the order and are left to the rejects.

    Windows of the day come before the join, as a sort-merge join keeps no order within the day: so one sort serves all.
    """
    return calendar_features(rows.join(_carried_in(_day_edges(marked)), VEHICLE_DAY))


def trip_changes(df: DataFrame) -> DataFrame:
    """Add ``changed``: whether the vehicle's first stop differs from that of its previous row."""
    marked = _placed_rows(df)
    here = {"nth_here": F.row_number().over(in_day()), "stop_before": F.lag("first_stop").over(in_day())}
    previous = F.when(F.col("nth_here") == 1, F.col("previous_stop")).otherwise(F.col("stop_before"))
    return (
        _with_carry(marked, marked.withColumns(here))
        .withColumn("changed", F.coalesce(F.col("first_stop") != previous, F.lit(False)))
        .select(*df.columns, "changed")
    )


def _filled(carrying: DataFrame, columns: list[str]) -> DataFrame:
    latest = F.coalesce("latest_here", "carried")
    return carrying.withColumn("latest", latest).select(
        *columns, F.col("latest.exit_time").alias("first_time"), F.col("latest.exit_stop").alias("run_stop")
    )


def fill_starts(df: DataFrame) -> DataFrame:
    """Add ``first_time`` and ``run_stop``, the exit time and stop of the latest change so far."""
    marked = _placed_rows(df)
    return _filled(_with_carry(marked, _with_latest(marked)), df.columns)


def _valid_runs(filled: DataFrame, columns: list[str]) -> DataFrame:
    kept = filled.filter(F.col("first_stop") == F.col("run_stop")).dropna(subset=["first_time"])
    return kept.select("first_time", *columns)


def trip_starts(df: DataFrame) -> DataFrame:
    """Rows of runs that open at their first stop, with ``first_time`` as the leading column.

    A vehicle's first run has no change before it and drops out.
    """
    return _valid_runs(fill_starts(df), df.columns)


def later_starts(df: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``trip_starts`` of days that all lie after those of a state, and the state after them.

    A state has one row per vehicle seen so far: its last day, the first stop of its last segment, and the change in
    force (null before the first one). Only the given rows and the state are read; the summaries of the days are
    stored, as the rows and the next state both come from them. Without a state the days are the first ones.
    """
    marked = _placed_rows(df)
    edges = stage(_day_edges(marked), "day-edges")
    known = edges if state is None else edges.unionByName(_as_edges(state, edges))
    carrying = calendar_features(_with_latest(marked).join(_carried_in(known), VEHICLE_DAY))
    after = (
        _placed_changes(known)
        .groupBy("vehicle_id")
        .agg(
            F.max("service_date").alias("service_date"),
            F.max_by("closing_stop", "service_date").alias("closing_stop"),
            F.max_by("day_change", F.when(F.col("day_change").isNotNull(), F.col("service_date"))).alias("change"),
        )
    )
    return _valid_runs(_filled(carrying, df.columns), df.columns), after
