import random
from datetime import datetime

from helpers import CLEAN, DAY, clean, fold_dedup, rows

from tripweave.operators import cleaning

TEXT = ", ".join(f"{c} string" for c in cleaning.PING_COLUMNS)
PINGS = (
    "time_received timestamp_ntz, vehicle_id long, distance_along_trip double, inferred_phase string, "
    "next_scheduled_stop_distance double, next_scheduled_stop_id string"
)
KEPT = ["second_of_day", "distance_along_trip", "next_scheduled_stop_distance", "next_scheduled_stop_id"]


def test_typing_keeps_what_parses(spark):
    raw = spark.createDataFrame(
        [
            ("2014-08-01 06:00:01", "512", "10.5", "IN_PROGRESS", "3", "MTA_7"),
            ("2014-08-01 06:00", "512.0", "x", "IN_PROGRESS", "1e2", "7"),
            ("2014-13-01 06:00:01", "abc", None, None, None, None),
        ],
        TEXT,
    )
    got = cleaning.type_pings(raw).collect()
    assert got[0][:3] == (512, datetime(2014, 8, 1, 6, 0, 1), 10.5)
    assert got[1][:5] == (512, None, None, "IN_PROGRESS", 100.0)
    assert got[2][:3] == (None, None, None)


def test_rejects_name_the_column(spark):
    good = ("2014-08-01 06:00:01", "512", "10.5", "IN_PROGRESS", "3", "MTA_7")

    def bad(i, value):
        return (*good[:i], value, *good[i + 1 :])

    raw = spark.createDataFrame(
        [good, bad(0, "noon"), bad(1, "abc"), bad(2, "-"), bad(4, "near"), bad(5, "BUS_7"), bad(3, "LAYOVER"), bad(4, None)],
        TEXT,
    )
    reasons = {r["reason"] for r in cleaning.ping_rejects(raw).collect()}
    assert reasons == set(cleaning.PING_COLUMNS) - {"inferred_phase", "next_scheduled_stop_id"}
    assert cleaning.ping_rejects(raw).count() == 4


def test_clean_filters_phase_and_nulls(spark):
    t = datetime(2014, 8, 1, 6, 0, 1)
    pings = spark.createDataFrame(
        [
            (t, 1, 1.0, "IN_PROGRESS", 2.0, "MTA_1"),
            (t, 1, 1.0, "LAYOVER_DURING", 2.0, "MTA_1"),
            (t, None, 1.0, "IN_PROGRESS", 2.0, "MTA_1"),
            (None, 1, 1.0, "IN_PROGRESS", 2.0, "MTA_1"),
            (t, 1, None, "IN_PROGRESS", 2.0, "MTA_1"),
            (t, 1, 1.0, None, 2.0, "MTA_1"),
            (t, 1, 1.0, "IN_PROGRESS", None, "MTA_1"),
            (t, 1, 1.0, "IN_PROGRESS", 2.0, None),
        ],
        PINGS,
    )
    assert [tuple(r) for r in cleaning.clean_pings(pings).collect()] == [(1, DAY, 21601, 1.0, 2.0, "MTA_1")]


def test_dedup_steps_and_ties(spark):
    pings = clean(
        spark,
        [
            (10, 100, 50, 1),
            (20, 100, 40, 1),  # repeated distance, later
            (30, 130, 20, 2),
            (30, 140, 10, 1),  # same second: the smaller stop id stays
            (40, 150, 50, 1),  # repeated (distance ahead, stop), later
            (50, 160, 50, 2),
        ],
    )
    assert rows(cleaning.dedup_pings(pings), *KEPT) == [
        (10, 100.0, 50.0, "MTA_1"),
        (30, 140.0, 10.0, "MTA_1"),
        (50, 160.0, 50.0, "MTA_2"),
    ]


def test_a_row_dropped_early_does_not_hide_others(spark):
    # The second row loses to the first by distance, so the third is the only one at its second.
    pings = clean(spark, [(10, 100, 50, 1), (20, 100, 40, 1), (20, 110, 40, 1)])
    assert rows(cleaning.dedup_pings(pings), *KEPT) == [(10, 100.0, 50.0, "MTA_1"), (20, 110.0, 40.0, "MTA_1")]


def random_pings(seed, n, seconds):
    rng = random.Random(seed)
    return [
        (rng.randrange(seconds), float(rng.randrange(60)), float(rng.randrange(5)), rng.randrange(1, 4)) for _ in range(n)
    ]


def test_crowded_vehicle_days_equal_the_step_by_step_reading(spark):
    data = {v: random_pings(v, 400 if v == 1 else 40, 50) for v in (1, 2, 3)}
    full = [(v, DAY, s, d, n, f"MTA_{p}") for v, group in data.items() for s, d, n, p in group]
    got = rows(cleaning.dedup_pings(spark.createDataFrame(full, CLEAN)), "vehicle_id", *KEPT)
    assert got == sorted((v, s, d, n, f"MTA_{p}") for v, g in data.items() for s, d, n, p in fold_dedup(g))
