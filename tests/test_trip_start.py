import random
from datetime import date, timedelta

from helpers import rows

from tripweave.operators import trip_start

SCHEMA = (
    "vehicle_id int, service_date date, exit_time double, label double, exit_stop int, target_stop int, "
    "first_stop int, distance double, total_distance double"
)
KEY = ["vehicle_id", "service_date", "exit_time", "label", "exit_stop"]


def make(days):
    """Rows from {vehicle: [[(exit_stop, first_stop), ...] per day]}."""
    start = date(2014, 8, 30)
    return [
        (v, start + timedelta(days=d), (i + 1) / 100, (i + 1) / 100 + 0.005, a, a + 1, f, 1.0, 2.0)
        for v, per_day in days.items()
        for d, day in enumerate(per_day)
        for i, (a, f) in enumerate(day)
    ]


def look_back(data):
    """Per vehicle over all its rows in time order: the latest change of first stop."""
    out = []
    for vehicle in {r[0] for r in data}:
        previous, start = None, (None, None)
        for r in sorted(r for r in data if r[0] == vehicle):
            changed = previous is not None and r[6] != previous
            if changed:
                start = (r[2], r[4])
            previous = r[6]
            out.append((*r[:5], changed, *start))
    return out


def check(spark, days):
    data = make(days)
    df = spark.createDataFrame(data, SCHEMA)
    want = look_back(data)
    assert rows(trip_start.trip_changes(df), *KEY, "changed") == sorted(w[:6] for w in want)
    got = {tuple(r) for r in trip_start.fill_starts(df).select(*KEY, "first_time", "run_stop").collect()}
    assert got == {(*w[:5], *w[6:]) for w in want}
    kept = {(*w[:5], w[6]) for w in want if w[6] is not None and w[7] == {tuple(r[:5]): r[6] for r in data}[w[:5]]}
    starts = trip_start.trip_starts(df)
    assert starts.columns[0] == "first_time"
    assert {tuple(r) for r in starts.select(*KEY, "first_time").collect()} == kept
    return kept


def test_first_run_drops_out(spark):
    assert check(spark, {1: [[(1, 1), (2, 1), (3, 1)]]}) == set()


def test_run_must_open_at_its_first_stop(spark):
    assert len(check(spark, {1: [[(1, 1), (5, 5), (6, 5), (8, 7), (9, 7)]]})) == 2


def test_runs_reach_over_days(spark):
    # The second day goes on with the same first stop; the third opens with a change.
    kept = check(spark, {1: [[(1, 1), (5, 5)], [(6, 5), (7, 5)], [], [(2, 2), (3, 2)]]})
    assert len(kept) == 5


def test_random_vehicles(spark):
    rng = random.Random(5)
    days = {
        v: [[(rng.randrange(1, 4), rng.randrange(1, 4)) for _ in range(rng.randrange(0, 8))] for _ in range(6)]
        for v in range(1, 25)
    }
    assert check(spark, days)
