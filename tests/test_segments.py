import random

import pytest
from helpers import CLEAN, DAY, clean, fold_segments, rows

from tripweave.operators import segments as seg

SEGMENT = ["exit_stop", "target_stop", "distance", "exit_us", "arrive_us"]


def kinds(spark, pings):
    return [r["pair_kind"] for r in seg.classify_pairs(seg.ping_pairs(clean(spark, pings))).orderBy("second_of_day").collect()]


def built(spark, pings):
    got = rows(seg.segments_of(clean(spark, pings)), *SEGMENT)
    assert got == sorted(fold_segments([(s, float(d), float(n), p) for s, d, n, p in pings]))
    return got


def drive(hops, start=0, step=50):
    """Pings 50 s apart that pass one stop per pair, each stop ``hop`` metres after the last."""
    pings, along = [], start
    position = start
    for i, hop in enumerate(hops):
        pings.append((i * step, position, 10, i + 1))
        position += hop
    pings.append((len(hops) * step, position, 10, len(hops) + 1))
    return pings


def test_plain_run(spark):
    got = built(spark, drive([200, 200, 200]))
    assert [(g[0], g[1], g[2]) for g in got] == [(1, 2, 200.0), (2, 3, 200.0)]


def test_pair_kinds(spark):
    assert kinds(spark, [(0, 100, 50, 1), (10, 90, 40, 1)]) == ["backward"]
    assert kinds(spark, [(0, 100, 50, 1), (10, 120, 50, 1)]) == ["inconsistent"]
    assert kinds(spark, [(0, 100, 50, 1), (10, 120, 30, 1)]) == ["same_stop"]
    assert kinds(spark, [(0, 100, 50, 1), (10, 120, 30, 2)]) == ["overshoot"]
    assert kinds(spark, [(0, 100, 1, 1), (100, 105, 30, 2)]) == ["implausible"]
    assert kinds(spark, [(0, 100, 1, 1), (10, 350, 30, 2)]) == ["implausible"]
    assert kinds(spark, [(0, 100, 1, 1), (10, 300, 30, 2)]) == ["crossing"]


def test_swallowed_pair_survives_going_backward(spark):
    pings = [(0, 100, 50, 1), (10, 120, 50, 1), (20, 110, 60, 1), (30, 200, 20, 2), (40, 260, 20, 3)]
    assert kinds(spark, pings) == ["inconsistent", "backward", "swallowed", "crossing"]
    built(spark, pings)


def test_half_metres_round_to_even(spark):
    # 2.5 and 2 both round to 2; half-up rounding would call this pair inconsistent.
    assert kinds(spark, [(0, 100, 50, 1), (10, 102.5, 48, 1)]) == ["same_stop"]
    assert kinds(spark, [(0, 100, 50, 1), (10, 103.5, 47, 1)]) == ["inconsistent"]


@pytest.mark.parametrize("bad, expected", [(1, 3), (2, 4), (3, 3), (4, 4)])
def test_runs_of_implausible_distances(spark, bad, expected):
    # Three plausible segments, the run, one more plausible one, which an odd run leaves without a start.
    got = built(spark, drive([200, 200, 200] + [50] * bad + [200, 200]))
    assert len([g for g in got if g[2] == 200]) == expected


def test_distance_limits_are_inclusive(spark):
    assert len(built(spark, drive([100, 100, 200], step=100))) == 2
    assert len(built(spark, drive([99, 99, 200], step=100))) == 0
    far = [(0, 0, 10, 1), (100, 2000, 10, 2), (200, 4000, 10, 3), (300, 6000, 10, 4)]
    assert [g[2] for g in built(spark, far)] == [2000.0, 2000.0]


def test_microseconds_are_rounded_before_seconds_are_cut(spark):
    # 2.9999999 s rounds to 3,000,000 microseconds, so the stop is passed at second 3.
    pings = [(0, 0, 29.999999, 1), (10, 100, 50, 2), (20, 200, 50, 3)]
    crossing = seg.stop_crossings(seg.classify_pairs(seg.ping_pairs(clean(spark, pings)))).orderBy("second_of_day").first()
    assert crossing["crossed_us"] == 3_000_000


def test_stops_without_a_number_are_set_apart(spark):
    pings = [(1, DAY, i * 50, 200.0 * i, 10.0, stop) for i, stop in enumerate(["MTA_1", "LIRR", "MTA_3", "MTA_4", "MTA_5"])]
    crossings = seg.stop_crossings(seg.classify_pairs(seg.ping_pairs(spark.createDataFrame(pings, CLEAN))))
    assert rows(seg.build_segments(crossings), "exit_stop", "target_stop") == [(3, 4)]
    assert rows(seg.segment_rejects(crossings), "exit_stop_id", "target_stop_id") == [("LIRR", "MTA_3"), ("MTA_1", "LIRR")]


def random_day(seed):
    """A noisy run of pings in time order, distinct seconds."""
    rng = random.Random(seed)
    second, along, stop, to_stop, pings = 0, 0.0, 1, rng.uniform(20, 300), []
    for _ in range(300):
        pings.append((second, along, to_stop + (rng.choice([0, 0, 0, 0, 25.5])), stop))
        second += rng.randrange(1, 60)
        move = rng.choice([0, 0.5, 10, 40, 150, 150.5, 300, 900])
        if rng.random() < 0.03:
            along, stop, to_stop = 0.0, rng.randrange(1, 9), rng.uniform(20, 300)
            continue
        along += move
        to_stop -= move
        while to_stop < 0:
            stop += 1
            to_stop += rng.choice([30, 90, 100, 150, 400, 1200, 2500])
    return pings


def test_windows_equal_the_step_by_step_reading(spark):
    days = {v: random_day(v) for v in range(1, 121)}
    full = [(v, DAY, s, d, n, f"MTA_{p}") for v, pings in days.items() for s, d, n, p in pings]
    got = rows(seg.segments_of(spark.createDataFrame(full, CLEAN)), "vehicle_id", *SEGMENT)
    want = sorted((v, *s) for v, pings in days.items() for s in fold_segments(pings))
    assert len(want) > 400
    assert got == want
