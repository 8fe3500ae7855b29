"""Small inputs and a step-by-step reading of the segment rules, for cross-checks."""

from __future__ import annotations

from datetime import date

DAY = date(2014, 8, 1)
CLEAN = (
    "vehicle_id long, service_date date, second_of_day int, distance_along_trip double, "
    "next_scheduled_stop_distance double, next_scheduled_stop_id string"
)


def clean(spark, rows, vehicle=1, day=DAY):
    """Rows of (second, distance, next stop distance, next stop number)."""
    full = [(vehicle, day, s, float(d), float(n), f"MTA_{stop}") for s, d, n, stop in rows]
    return spark.createDataFrame(full, CLEAN)


def fold_segments(rows):
    """Segments of one vehicle-day from its de-duplicated pings in time order, one pair at a time."""
    found, anchor, skip = [], None, False
    for (s, d, ahead, stop), (s2, d2, ahead2, stop2) in zip(rows, rows[1:], strict=False):
        gap = d2 - d
        if gap < 0:
            anchor = None
        elif stop == stop2 and round(gap) != round(ahead - ahead2):
            anchor, skip = None, True
        elif skip:
            skip = False
        elif stop != stop2:
            speed = gap / (s2 - s)
            if ahead > gap or speed < 0.1 or speed > 20:
                anchor = None
                continue
            here = (stop, s * 1_000_000 + round(ahead / speed * 1_000_000), gap - ahead, d2)
            if anchor is not None:
                distance = anchor[2] + d - anchor[3] + ahead
                if not 100 <= distance <= 2000:
                    anchor = None
                    continue
                found.append((anchor[0], stop, distance, anchor[1], here[1]))
            anchor = here
    return found


def fold_dedup(rows):
    """Rows of (second, distance, next stop distance, stop) kept first by each key in turn."""
    kept = sorted(rows, key=lambda r: (r[0], f"MTA_{r[3]}", r[2], r[1]))
    for key in (lambda r: r[1], lambda r: r[0], lambda r: (r[2], r[3])):
        seen, left = set(), []
        for r in kept:
            if key(r) not in seen:
                seen.add(key(r))
                left.append(r)
        kept = left
    return kept


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
