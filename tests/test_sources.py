from collections import Counter
from datetime import date, datetime

import pytest
from helpers import rows

from tripweave.operators import cleaning
from tripweave.operators.features import LINKED_SCHEMA
from tripweave.sources import compaction, datasets, files, pings_tsv, profile

HEADER = "latitude\ttime_received\tvehicle_id\tdistance_along_trip\tinferred_phase\tnext_scheduled_stop_distance\tnext_scheduled_stop_id"


def line(day, vehicle="7", distance="1.5"):
    return f"40.7\t2014-08-0{day} 06:00:00\t{vehicle}\t{distance}\tIN_PROGRESS\t10\tMTA_3"


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_columns_are_picked_by_name_and_days_read_together(spark, tmp_path):
    write(tmp_path, "a.txt", HEADER, line(1), line(1, vehicle="NA"))
    write(tmp_path, "b.txt", HEADER, line(2, distance="NULL"))
    raw = pings_tsv.read_pings_tsv(spark, str(tmp_path / "*.txt"))
    assert raw.columns == cleaning.PING_COLUMNS
    got = rows(cleaning.type_pings(raw).fillna(-1), "time_received", "vehicle_id", "distance_along_trip")
    assert got == [
        (datetime(2014, 8, 1, 6), -1, 1.5),
        (datetime(2014, 8, 1, 6), 7, 1.5),
        (datetime(2014, 8, 2, 6), 7, -1.0),
    ]


def test_files_with_swapped_columns_are_refused(spark, tmp_path):
    swapped = HEADER.split("\t")
    swapped[2], swapped[3] = swapped[3], swapped[2]
    write(tmp_path, "a.txt", HEADER, line(1))
    write(tmp_path, "b.txt", "\t".join(swapped), line(2))
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        pings_tsv.read_pings_tsv(spark, str(tmp_path / "*.txt")).collect()


def test_headerless_positions(spark, tmp_path):
    write(tmp_path, "a.txt", "\t".join(f"v{i}" for i in range(11)))
    got = pings_tsv.read_headerless_tsv(spark, str(tmp_path / "a.txt"))
    assert got.columns == ["_c2", "_c3", "_c4", "_c9", "_c10"]
    assert tuple(got.first()) == ("v2", "v3", "v4", "v9", "v10")


def test_written_pings_read_back(spark, tmp_path):
    t = datetime(2014, 8, 1, 6, 0, 1)
    pings = spark.createDataFrame(
        [(t, 1, 1.0, "IN_PROGRESS", None, "MTA_1"), (datetime(2014, 8, 2), 2, 2.0, "X", 2.0, "MTA_2")],
        "time_received timestamp_ntz, vehicle_id long, distance_along_trip double, inferred_phase string, "
        "next_scheduled_stop_distance double, next_scheduled_stop_id string",
    )
    path = str(tmp_path / "tsv")
    pings_tsv.write_pings_tsv(pings, path)
    back = cleaning.type_pings(pings_tsv.read_pings_tsv(spark, f"{path}/*")).select(*pings.columns)
    assert back.schema.simpleString() == pings.schema.simpleString()
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in pings.collect()}


def linked(spark, day, vehicle):
    return spark.createDataFrame([(vehicle, day.month, day.day, 0, 1, 1, 2, 100.0, 100.0, 0.1, 0.2, day)], LINKED_SCHEMA)


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "linked")
    first, second = date(2014, 8, 1), date(2014, 8, 2)
    datasets.write_linked(linked(spark, first, 1).union(linked(spark, second, 1)), path)
    datasets.write_linked(linked(spark, second, 5), path)
    back = datasets.read_dataset(spark, path)
    assert rows(back, "service_date", "vehicle_id") == [(first, 1), (second, 5)]
    want = {f.name: f.dataType for f in LINKED_SCHEMA}
    assert {f.name: f.dataType for f in back.schema} == want


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartition(12).write.parquet(path)
    report = compaction.compact_folder(spark, path).first()
    assert (report["files_before"], report["files_after"], report["rewritten"]) == (12, 1, 12)
    assert rows(datasets.read_dataset(spark, path), "id") == [(i,) for i in range(1000)]


def test_compaction_keeps_the_day_layout(spark, tmp_path):
    path = str(tmp_path / "many")
    df = spark.range(90).selectExpr("id", "date_add(date'2014-08-01', int(id % 3)) AS day")
    df.repartition(5).write.partitionBy("day").parquet(path)
    report = compaction.compact_folder(spark, path)
    assert rows(report, "files_before", "files_after") == [(5, 1)] * 3
    back = datasets.read_dataset(spark, path)
    assert {tuple(r) for r in back.select("id", "day").collect()} == {tuple(r) for r in df.collect()}
    plan = back.filter("day = date'2014-08-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def wide_rows(spark, n, seed=0):
    return spark.range(n).selectExpr("id", f"sha2(string(id + {seed}), 512) AS text", "int(id % 2) AS half")


@pytest.mark.parametrize(
    "settings",
    [
        {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3"},
        {"spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "200"},
        {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.files.maxRecordsPerFile": "50"},
    ],
)
def test_the_files_left_over_follow_from_stored_bytes_alone(spark, tmp_path, settings):
    path = str(tmp_path / "data")
    for i in range(3):
        wide_rows(spark, 4000, i).repartition(4).write.partitionBy("half").mode("append").parquet(path)
    wide_rows(spark, 30_000, 9).coalesce(1).write.partitionBy("half").mode("append").parquet(path)
    want = Counter(tuple(r) for r in spark.read.parquet(path).collect())
    before = {r["path"]: r["length"] for r in files.listed(spark, path, "*.parquet").collect()}
    target = 300_000
    large = {p for p, n in before.items() if n >= target / 2}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        report = compaction.compact_folder(spark, path, target).collect()
        again = compaction.compact_folder(spark, path, target).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    left = {r["path"]: r["length"] for r in files.listed(spark, path, "*.parquet").collect()}
    assert large and large <= set(left) and not (set(before) - large) & set(left)
    assert Counter(tuple(r) for r in spark.read.parquet(path).collect()) == want
    assert [r["files_after"] for r in report] == [4, 4] and {r["rewritten"] for r in again} == {0}


def test_a_plan_fills_bins_and_leaves_single_files():
    sizes = [50, 10, 90, 40, 60, 30, 20]
    bins = compaction.packed(sizes, 100)
    held = Counter()
    for size, bin_ in zip(sizes, bins, strict=True):
        held[bin_] += size
    assert max(held.values()) <= 100 and len(held) == 3
    assert compaction.packed([], 100) == []


@pytest.mark.parametrize("step", ["written", "listed", "deleted", "moved"])
def test_a_compaction_that_was_cut_off_is_completed_or_undone(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "data")
    wide_rows(spark, 900).repartition(6).write.partitionBy("half").parquet(path)
    want = Counter(tuple(r) for r in spark.read.parquet(path).collect())
    calls = Counter()

    def failing(name, after):
        original = getattr(files.Folder, name)

        def call(self, *args):
            calls[name] += 1
            if calls[name] == after:
                raise RuntimeError("cut off")
            return original(self, *args)

        monkeypatch.setattr(files.Folder, name, call)

    if step == "written":
        monkeypatch.setattr(compaction, "_replace", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    elif step == "listed":
        failing("delete", 1)
    else:
        failing(*(("delete", 4) if step == "deleted" else ("move", 2)))
    with pytest.raises(RuntimeError):
        compaction.compact_folder(spark, path)
    monkeypatch.undo()
    report = compaction.compact_folder(spark, path)
    assert {r["files_after"] for r in report.collect()} == {1}
    spark.catalog.refreshByPath(path)
    assert Counter(tuple(r) for r in spark.read.parquet(path).collect()) == want


def test_files_without_rows_keep_their_schema(spark, tmp_path):
    path = str(tmp_path / "data")
    for _ in range(3):
        spark.range(0).coalesce(1).write.mode("append").parquet(path)
    assert compaction.compact_folder(spark, path).first()["files_after"] == 1
    assert spark.read.parquet(path).columns == ["id"]


def test_a_dataset_is_overwritten(spark, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_dataset(spark.range(10), path)
    datasets.write_dataset(spark.range(3), path)
    assert rows(datasets.read_dataset(spark, path), "id") == [(0,), (1,), (2,)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (3, None)], "x int, y string")
    assert tuple(profile.profile(df).first()) == (3, "int", 1, 1, 3, "string", 1, "a", "b")
    assert [tuple(r) for r in profile.column_types(df).orderBy("place").collect()] == [(1, "x", "int"), (2, "y", "string")]


def test_calendar_gaps(spark):
    days = spark.createDataFrame([(date(2014, 8, 1),), (date(2014, 8, 3),), (date(2014, 8, 3),)], "d date")
    assert rows(profile.calendar_gaps(days, "d"), "day") == [(date(2014, 8, 2),)]
    wide = profile.calendar_gaps(days, "d", date(2014, 7, 31), date(2014, 8, 4))
    assert rows(wide, "day") == [(date(2014, 7, 31),), (date(2014, 8, 2),), (date(2014, 8, 4),)]


def test_times_do_not_depend_on_the_session_zone(spark, tmp_path):
    """02:30 does not exist in New York on 9 March 2014, and 01:30 exists twice on 2 November."""
    lines = [line(1).replace("2014-08-01 06:00:00", t) for t in ("2014-03-09 02:30:00", "2014-11-02 01:30:00")]
    write(tmp_path, "a.txt", HEADER, *lines)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        pings = cleaning.type_pings(pings_tsv.read_pings_tsv(spark, str(tmp_path / "a.txt")))
        got = rows(cleaning.clean_pings(pings), "service_date", "second_of_day")
        pings_tsv.write_pings_tsv(pings, str(tmp_path / "out"))
        again = cleaning.type_pings(pings_tsv.read_pings_tsv(spark, str(tmp_path / "out" / "*")))
        assert rows(again, "time_received") == rows(pings, "time_received")
        gaps = rows(profile.calendar_gaps(pings, "time_received", date(2014, 3, 8), date(2014, 3, 10)), "day")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(date(2014, 3, 9), 9000), (date(2014, 11, 2), 5400)]
    assert gaps == [(date(2014, 3, 8),), (date(2014, 3, 10),)]


def test_a_bin_is_sorted_as_packed_chunks_in_the_order_of_its_files(spark, tmp_path):
    path = str(tmp_path / "data")
    kinds = "id", "timestamp_ntz'2014-08-01 06:00:00' AS t", "IF(id % 3 = 0, NULL, struct(string(id) AS s, array(id))) AS n"
    for first in (0, 40_000, 80_000):
        spark.range(first, first + 40_000, 1, 1).selectExpr(*kinds).write.mode("append").parquet(path)
    want = sorted(map(str, spark.read.parquet(path).collect()))
    listed = sorted(f["path"] for f in files.listed(spark, path, "*.parquet").collect())
    order = [r["id"] for p in listed for r in sorted(spark.read.parquet(p).select("id").collect())]
    seen = []
    frame = type(spark.range(0))
    original = frame.sortWithinPartitions
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(frame, "sortWithinPartitions", lambda df, *by: seen.append(df.columns) or original(df, *by))
        assert compaction.compact_folder(spark, path).first()["files_after"] == 1
    assert seen and all(columns == ["_bin", "_file", "_row", "_packed"] for columns in seen)
    spark.catalog.refreshByPath(path)
    left = spark.read.parquet(path)
    assert sorted(map(str, left.collect())) == want
    assert [r["id"] for r in left.select("id", "_metadata.row_index").orderBy("row_index").collect()] == order
