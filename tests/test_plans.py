"""What the physical plans must look like."""

import re
from datetime import datetime

from helpers import CLEAN, DAY

from tripweave.operators import cleaning, encoding, modal, segments, trip_start, views
from tripweave.plans import daily
from tripweave.plans import features as build
from tripweave.plans import sample_pings as plans_sample_pings
from tripweave.session import stage
from tripweave.sources import datasets
from tripweave.plans.sample_pings import pings_from_lines, sample_pings


def executed(df):
    """The final adaptive plan."""
    df.toArrow()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def exchanges(plan):
    return re.findall(r"\bExchange (\w+)", plan)


def test_pings_to_segments(spark, sf_dir):
    """Two exchanges thin the pings, the third, by vehicle-day, serves everything up to the segments."""
    plan = executed(segments.segments_of(cleaning.dedup_pings(cleaning.clean_pings(stage(sample_pings(spark, sf_dir), "pings")))))
    assert exchanges(plan) == ["hashpartitioning"] * 3
    assert plan.count("FileScan") == 1
    assert "Python" not in plan and "InMemory" not in plan.replace("InMemoryFileIndex", "")


def test_pings_are_thinned_before_each_exchange(spark):
    pings = stage(spark.createDataFrame([(v, DAY, s, 1.0, 1.0, "MTA_1") for v in (1, 2) for s in range(9)], CLEAN), "clean")
    plan = executed(cleaning.dedup_pings(pings))
    assert plan.count("FileScan") == 1
    # Below the exchange by (vehicle-day, distance) each task already keeps one row per key.
    assert re.search(r"Exchange hashpartitioning\([^\n]*distance_along_trip[^\n]*\n[^\n]*WindowGroupLimit", plan)
    assert re.search(r"Exchange hashpartitioning\([^\n]*second_of_day[^\n]*\n[^\n]*WindowGroupLimit", plan)


def test_sparse_ids_are_not_numbered_in_one_task(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("xxhash64(id) AS vehicle_id").write.parquet(path)
    df = encoding.vehicle_dictionary(datasets.read_dataset(spark, path))
    assert "SinglePartition" not in executed(df)
    got = df.orderBy("id").collect()
    assert [r["code"] for r in got] == list(range(1, 5001))


def test_stored_modes_are_broadcast_and_segments_stay(spark, sf_dir):
    pings = stage(sample_pings(spark, sf_dir), "pings")
    found = stage(segments.segments_of(cleaning.dedup_pings(cleaning.clean_pings(pings))), "segments")
    rounded = modal.round_distances(found)
    plan = executed(modal.keep_modal(rounded, stage(modal.trip_modes(rounded), "modes")))
    assert exchanges(plan) == []
    assert "BroadcastHashJoin" in plan


def test_large_modes_are_not_broadcast(spark, sf_dir):
    pings = stage(sample_pings(spark, sf_dir), "pings")
    rounded = modal.round_distances(stage(segments.segments_of(cleaning.dedup_pings(cleaning.clean_pings(pings))), "segments"))
    modes = stage(modal.trip_modes(rounded), "modes")
    wanted = {tuple(r) for r in modal.keep_modal(rounded, modes).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = modal.keep_modal(rounded, modes)
        assert "SortMergeJoin" in executed(df)
        assert {tuple(r) for r in df.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_trip_is_split_in_the_join(spark, tmp_path):
    """A third of all segments on one trip, modes too large to broadcast."""
    path = str(tmp_path / "segments")
    spark.range(60_000).repartition(6).selectExpr(
        "id AS vehicle_id", "date'2014-08-01' AS service_date", "IF(id % 3 = 0, 0, id % 500) AS exit_stop",
        "1L AS target_stop", "200.0D AS distance", "id AS exit_us", "id AS arrive_us",
    ).write.parquet(path)
    rounded = modal.round_distances(datasets.read_dataset(spark, path))
    modes = stage(modal.trip_modes(rounded), "modes")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = modal.keep_modal(rounded, modes).repartition(*cleaning.VEHICLE_DAY)
        assert "SortMergeJoin(skew=true)" in executed(df)
        assert df.count() == 60_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_modes_are_counted_before_the_exchange(spark, sf_dir):
    pings = sample_pings(spark, sf_dir)
    rounded = modal.round_distances(stage(segments.segments_of(cleaning.dedup_pings(cleaning.clean_pings(pings))), "segments"))
    plan = executed(modal.trip_modes(rounded))
    assert re.search(r"Exchange hashpartitioning\([^\n]*distance[^\n]*\n[^\n]*HashAggregate[^\n]*partial_count", plan)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_commute_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(0.3, 0.4, 1)], "exit_time double, label double, other int").write.parquet(path)
    plan = executed(views.commute_by_arrival(datasets.read_dataset(spark, path)).select("exit_time"))
    assert "GreaterThanOrEqual(label,0.291), LessThanOrEqual(label,0.458)" in plan
    assert re.search(r"ReadSchema: struct<exit_time:double,label:double>", plan)


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(DAY, 1)], "service_date date, x int")
    df.write.partitionBy("service_date").parquet(path)
    plan = executed(datasets.read_dataset(spark, path).filter("service_date = date'2014-08-01'"))
    assert re.search(r"PartitionFilters: \[.*service_date", plan)


def test_trip_starts_share_one_exchange(spark, sf_dir):
    linked = stage(daily.linked(stage(sample_pings(spark, sf_dir), "pings")), "linked")
    plan = executed(build.started(linked)[0])
    by_vehicle_day = r"Exchange hashpartitioning\([^\n]*REPARTITION_BY_COL"
    assert len(re.findall(r"\+- " + by_vehicle_day, plan)) == 1
    assert len(re.findall(r"ReusedExchange [^\n]*" + by_vehicle_day, plan)) == 1


def test_a_dictionary_reads_its_ids_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id % 50 AS exit_stop", "id % 70 AS target_stop").write.parquet(path)
    plan = executed(encoding.stop_dictionary(datasets.read_dataset(spark, path)))
    assert plan.count("FileScan") == 1


LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz"


def order_lines(spark, vehicles, n):
    """Lines with repeated shipping times and keys, and some without supplier, time or part."""
    shipped = [datetime(1992 + i % 7, 1 + i % 12, 1 + i % 3) for i in range(n)]
    rows = [(i % 90, i % 4, None if i % 31 == 0 else i % 50, v, shipped[i]) for v in vehicles for i in range(n)]
    return spark.createDataFrame([*rows, (1, 1, 1, None, shipped[0]), (1, 1, 1, vehicles[0], None)], LINES)


def test_pings_of_a_vehicle_stay_where_its_lines_are_numbered(spark):
    """One exchange numbers the lines and serves the trips and both thinning steps; the other is by vehicle-day."""
    lines = stage(order_lines(spark, [1, 2, 3], 450), "lines")
    plan = executed(cleaning.dedup_pings(cleaning.clean_pings(pings_from_lines(lines))))
    assert exchanges(plan) == ["hashpartitioning"] * 2


def test_vehicles_with_many_lines_give_the_same_pings(spark, monkeypatch):
    lines = stage(order_lines(spark, [4, 14], 450).unionByName(order_lines(spark, [7], 900)), "lines")
    whole = sorted(map(str, pings_from_lines(lines).collect()))
    monkeypatch.setattr(plans_sample_pings, "MOST_LINES", 500)
    df = pings_from_lines(lines)
    assert "quarter" in df._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, df.collect())) == whole and len(whole) == 1800


def test_rows_are_stored_before_their_ranges_are_found(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(build, "in_order", lambda df: seen.append(df))
    build.model_table(stage(daily.linked(stage(sample_pings(spark, sf_dir), "pings")), "linked"))
    plan = executed(seen[0])
    assert exchanges(plan) == [] and "Window" not in plan and plan.count("FileScan") == 1


def test_trip_starts_sort_a_day_once_for_all_its_windows(spark, sf_dir):
    """Also where the summaries of the days are too large to broadcast: the rows are not sorted within the day again."""
    scaled = stage(build.scaled(stage(daily.linked(stage(sample_pings(spark, sf_dir), "pings")), "linked"))[0], "scaled")
    wanted = sorted(map(str, trip_start.trip_starts(scaled).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = trip_start.trip_starts(scaled)
        within_day = re.findall(r"\bSort \[[^\]]*exit_time[^\]]*\]", executed(df))
        assert sorted(map(str, df.collect())) == wanted and wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One below the rows, one below the summaries.
    assert len(within_day) == 2
