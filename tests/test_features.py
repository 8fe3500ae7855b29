from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tripweave.functions import columns
from tripweave.operators import encoding, features, scaling, views
from tripweave.operators.ordinal import sliced_ordinal
from tripweave.operators.scaling import Bounds, ZScore


def test_calendar_counts_days_from_monday(spark):
    days = spark.createDataFrame([(date(2014, 8, 4),), (date(2014, 8, 10),), (date(2014, 10, 31),)], "service_date date")
    got = rows(features.calendar_features(days), "service_date", "month", "day_of_month", "day_of_week")
    assert got == [(date(2014, 8, 4), 8, 4, 0), (date(2014, 8, 10), 8, 10, 6), (date(2014, 10, 31), 10, 31, 4)]


def test_times_are_cut_to_the_second(spark):
    df = spark.createDataFrame([(0, 43_200_999_999)], "exit_us long, arrive_us long")
    assert rows(features.time_fractions(df), "exit_time", "arrive_time") == [(0.0, 0.5)]


def test_stop_numbers(spark):
    ids = spark.createDataFrame([("MTA_0042",), ("MTA_",), ("42",), ("MTA_4x",), ("NYCT_MTA_9",), (None,)], "id string")
    got = [r[0] for r in ids.select(columns.parse_stop(F.col("id"))).collect()]
    assert got == [42, None, None, None, 9, None]


def test_null_tokens(spark):
    text = spark.createDataFrame([("",), ("NA",), ("NULL",), ("NaN",), ("null",), ("n/a",), ("none",), ("0",)], "t string")
    assert [r[0] for r in text.select(columns.blank_to_null(F.col("t"))).collect()] == [None] * 6 + ["none", "0"]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_codes_follow_the_ids_across_partitions(spark, coalesce):
    ids = [7, 3, 70_000, 65_536, 65_535, 200_000, -1, 2**62, -(2**62)]
    df = spark.createDataFrame([(i,) for i in [*ids, None]], "id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        assert rows(encoding.number_ids(df), "id", "code") == [(i, n) for n, i in enumerate(sorted(ids), 1)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sliced_ordinal_is_row_number(spark):
    data = [(g, (i * 7) % 5, (i * 13) % 31, i) for g in (1, 2) for i in range(31)]
    df = spark.createDataFrame(data, "g int, s int, o int, i int")
    got = rows(sliced_ordinal(df, ["g"], "s", ["o"], "nth"), "g", "nth", "s", "o")
    for g in (1, 2):
        ordered = sorted((s, o) for gg, s, o, _ in data if gg == g)
        assert [r[1:] for r in got if r[0] == g] == [(n, s, o) for n, (s, o) in enumerate(ordered, 1)]


def test_unknown_ids_become_null_and_are_reported(spark):
    df = spark.createDataFrame([(1, 10, 20, 10), (9, 10, 30, 10)], "vehicle_id int, exit_stop long, target_stop long, first_stop long")
    stops = spark.createDataFrame([(10, 1), (20, 2)], "id long, code int")
    vehicles = spark.createDataFrame([(1, 1), (9, 2)], "id long, code int")
    coded = encoding.encode_ids(df, stops, vehicles)
    assert {tuple(r) for r in coded.select(*df.columns).collect()} == {(1, 1, 2, 1), (2, 1, None, 1)}
    assert [r["vehicle_id"] for r in encoding.encode_rejects(coded).collect()] == [2]


def test_both_distances_use_the_total_range(spark):
    df = spark.createDataFrame([(100.0, 50.0, 0.1), (300.0, 200.0, 0.2)], "total_distance double, distance double, arrive_time double")
    bounds = scaling.fit_bounds(df)
    got = scaling.minmax_scale(df, bounds)
    assert rows(got, "total_distance", "distance", "label") == [(0.0, -0.25, 0.1), (1.0, 0.5, 0.2)]


def test_empty_range_gives_null(spark):
    df = spark.createDataFrame([(5.0, 5.0, 0.1)], "total_distance double, distance double, arrive_time double")
    assert rows(scaling.minmax_scale(df, scaling.fit_bounds(df)), "total_distance") == [(None,)]


SCALED = "total_distance double, distance double, first_time double, exit_time double, label double, vehicle_id int"


def test_unscale_undoes_scale_and_keeps_nulls(spark):
    bounds = Bounds(100.0, 12_600.0)
    df = spark.createDataFrame([((730 - 100) / 12_500, 0.0, None, 0.25, 1 / 86400, 3)], SCALED)
    got = scaling.unscale(df, bounds)
    assert got.columns == ["vehicle_id", "total_distance", "distance", "first_time", "exit_time", "label"]
    assert tuple(got.first()) == (3, 730, 100, None, 21600, 1)


def test_unscale_rounds_half_up(spark):
    df = spark.createDataFrame([(0.5 / 41160, 1.0, 0.0, 0.5 / 86400, 1.5 / 86400, 3)], SCALED)
    assert tuple(scaling.unscale(df).first())[1:] == (101, 41260, 0, 1, 2)


def test_bounds_are_stored(spark, tmp_path):
    Bounds(1.5, 2.5).save(spark, str(tmp_path / "b"))
    assert Bounds.load(spark, str(tmp_path / "b")) == Bounds(1.5, 2.5)


def test_zscore_centres_constant_columns_and_inverts(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    fitted = ZScore.fit(df, ["a", "b"])
    assert rows(fitted.transform(df), "a", "b") == [(-1.0, 0.0), (1.0, 0.0)]
    fitted.save(spark, str(tmp_path / "z"))
    stored = ZScore.load(spark, str(tmp_path / "z"))
    assert stored == fitted
    assert rows(stored.inverse(stored.transform(df)), "a", "b") == [(1.0, 5.0), (3.0, 5.0)]


def test_speeds(spark):
    df = spark.createDataFrame(
        [(100, 100, 0, 50, 50), (201, 1005, 0, 100, 300), (30, 30, 0, 0, 40), (50, 60, None, 10, 60)],
        "distance int, total_distance int, first_time int, exit_time int, label int",
    )
    got = [(r["speed"], r["total_speed"]) for r in views.add_speeds(df).collect()]
    # No travel time and no trip start give null; 1.005 rounds up as a decimal.
    assert got == [(None, 2.0), (1.01, 3.35), (0.75, 0.75), (1.0, None)]
    assert [r["distance"] for r in views.drop_slow(views.add_speeds(df)).collect()] == [201]


COMMUTE = "exit_time double, label double"


def test_commute_windows_are_inclusive(spark):
    df = spark.createDataFrame([(0.29, 0.291), (0.291, 0.458), (0.4, 0.4581), (0.2, 0.2909)], COMMUTE)
    assert rows(views.commute_by_arrival(df), "exit_time") == [(0.29,), (0.291,)]
    assert rows(views.commute_by_both(df), "exit_time") == [(0.291,)]


def test_union_of_views_drops_the_repeats_of_a_day_and_sorts(spark):
    schema = (
        "service_date date, day_of_week int, first_time double, exit_time double, first_stop int, "
        "exit_stop int, target_stop int, total_distance double, distance double, label double"
    )
    first, second, years_later = date(2014, 8, 1), date(2014, 8, 2), date(2025, 8, 1)
    same = (4, 0.2, 0.2, 1, 1, 5, 9.0, 9.0, 0.4)
    rows_ = [(second, 5, 0.1, 0.3, 1, 4, 5, 9.0, 2.0, 0.4), (first, *same), (years_later, *same)]
    got = views.short_long_union(spark.createDataFrame(rows_, schema))
    assert got.columns == ["day_of_week", "exit_time", "exit_stop", "distance", "target_stop", "label"]
    assert [tuple(r) for r in got.collect()] == [
        (4, 0.2, 1, 9.0, 5, 0.4),
        (5, 0.1, 1, 9.0, 5, 0.4),
        (5, 0.3, 4, 2.0, 5, 0.4),
        (4, 0.2, 1, 9.0, 5, 0.4),
    ]


@pytest.mark.parametrize("x, want", [(125, 120), (135, 140), (104.99, 100), (-15, -20)])
def test_nearest_ten(spark, x, want):
    assert spark.range(1).select(columns.nearest_ten(F.lit(float(x)))).first()[0] == want
