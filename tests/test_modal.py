from helpers import DAY, rows

from tripweave.operators import modal

SEGMENTS = (
    "vehicle_id long, service_date date, exit_stop long, target_stop long, distance double, exit_us long, arrive_us long"
)


def segments(spark, distances, trip=(1, 2)):
    return spark.createDataFrame([(i, DAY, *trip, float(d), 0, 1) for i, d in enumerate(distances)], SEGMENTS)


def cleaned(df):
    rounded = modal.round_distances(df)
    return rows(modal.keep_modal(rounded, modal.trip_modes(rounded)), "vehicle_id", "distance")


def test_tens_round_half_even(spark):
    got = rows(modal.round_distances(segments(spark, [125, 135, 124.9, 105])), "vehicle_id", "distance")
    assert got == [(0, 120.0), (1, 140.0), (2, 120.0), (3, 100.0)]


def test_tie_goes_to_the_smaller_distance(spark):
    assert cleaned(segments(spark, [300, 301, 500, 502, 700])) == [(0, 300.0), (1, 300.0)]


def test_most_frequent_wins_and_overwrites(spark):
    assert cleaned(segments(spark, [300, 498, 500, 503, 505.1])) == [(1, 500.0), (2, 500.0), (3, 500.0)]


def test_each_trip_and_day_has_its_own_mode(spark):
    both = segments(spark, [300, 300, 500]).union(segments(spark, [500, 500, 300], trip=(2, 3)))
    assert [d for _, d in cleaned(both)] == [300.0, 500.0, 300.0, 500.0]


def test_the_row_is_within_ten_metres_of_the_mode(spark):
    # The literal rule, strictly within ten metres of the mode, keeps the same rows.
    distances = [100 + 7 * (i % 13) + (i * i % 29) for i in range(200)]
    rounded = rows(modal.round_distances(segments(spark, distances)), "distance")
    counts = {}
    for (d,) in rounded:
        counts[d] = counts.get(d, 0) + 1
    mode = min(d for d in counts if counts[d] == max(counts.values()))
    assert len(cleaned(segments(spark, distances))) == sum(1 for (d,) in rounded if mode - 10 < d < mode + 10)
