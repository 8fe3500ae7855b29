"""Days that keep arriving: files with headers of their own, the ledger, states of trip starts, growing dictionaries."""

import os
import random
import re
from datetime import date, timedelta

import pytest
from helpers import rows
from test_trip_start import SCHEMA, look_back, make

from tripweave.operators import cleaning, encoding, trip_start
from tripweave.operators.cleaning import PING_COLUMNS
from tripweave.plans import daily, ingest, registry
from tripweave.session import stage
from tripweave.sources import datasets, files, pings_tsv

DAY = date(2014, 8, 1)


def value(name, vehicle, day, i):
    return {
        "time_received": f"{DAY + timedelta(days=day)} 06:{i:02d}:00",
        "vehicle_id": str(vehicle),
        "distance_along_trip": str(i * 300),
        "inferred_phase": "IN_PROGRESS",
        "next_scheduled_stop_distance": "100" if i % 2 else "400",
        "next_scheduled_stop_id": f"MTA_{i // 2}",
    }.get(name, "x")


def write(path, vehicle, days, names=PING_COLUMNS, n=16, quote=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = ["\t".join(f"{quote}{c}{quote}" for c in names)]
    lines += ["\t".join(value(c, vehicle, d, i) for c in names) for d in days for i in range(n)]
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def linked_of(spark, source):
    raw, _ = pings_tsv.read_unlike_tsv(spark, pings_tsv.file_headers(spark, source))
    return rows(daily.build(raw)[0], *LINKED)


LINKED = ["vehicle_id", "service_date", "first_stop", "exit_stop", "target_stop", "distance", "total_distance", "exit_time"]


def test_files_with_unlike_headers_are_read_by_name(spark, tmp_path):
    at = lambda name: str(tmp_path / "in" / name)
    write(at("a/1.txt"), 1, [0])
    write(at("a/2.txt"), 2, [0], PING_COLUMNS[::-1], quote='"')
    write(at("b/3.txt"), 3, [0], ["route", *PING_COLUMNS[:3], "latitude", *PING_COLUMNS[3:], "route"])
    write(at("b/4.txt"), 4, [0], [c for c in PING_COLUMNS if c != "vehicle_id"])
    open(at("empty.txt"), "w").close()
    write(at("only-header.txt"), 5, [])
    headers = pings_tsv.file_headers(spark, at(""))
    raw, unread = pings_tsv.read_unlike_tsv(spark, headers, uri=True)
    got = rows(raw, *PING_COLUMNS)
    assert got == sorted(tuple(value(c, v, 0, i) for c in PING_COLUMNS) for v in (1, 2, 3) for i in range(16))
    assert {os.path.basename(r["uri"]) for r in raw.select("uri").distinct().collect()} == {"1.txt", "2.txt", "3.txt"}
    missing = {os.path.basename(r["path"]): r["missing"] for r in unread.collect()}
    assert missing == {"4.txt": ["vehicle_id"]}


def test_no_readable_file_gives_no_rows(spark, tmp_path):
    write(str(tmp_path / "in/a.txt"), 1, [0], ["x", "y"])
    raw, unread = pings_tsv.read_unlike_tsv(spark, pings_tsv.file_headers(spark, str(tmp_path / "in")))
    assert raw.columns == PING_COLUMNS and raw.isEmpty() and unread.count() == 1


def test_steps_equal_one_full_build(spark, tmp_path):
    source, out, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    run = lambda: [r[0] for r in ingest.ingest(spark, source, out, ledger).collect()]
    days = [DAY + timedelta(days=i) for i in range(4)]

    def equal():
        spark.catalog.refreshByPath(out)
        assert rows(datasets.read_dataset(spark, out), *LINKED) == linked_of(spark, source)

    write(f"{source}/1.txt", 1, [0, 1])
    assert run() == days[:2]
    equal()
    write(f"{source}/2.txt", 2, [2], PING_COLUMNS[::-1])
    assert run() == days[2:3]
    equal()
    write(f"{source}/late.txt", 3, [0])  # a late file for an old day
    before = {r["path"] for r in files.listed(spark, out, "*.parquet").collect()}
    assert run() == days[:1]
    equal()
    after = {r["path"] for r in files.listed(spark, out, "*.parquet").collect()}
    assert {p for p in before if f"={days[0]}" not in p} == {p for p in after if f"={days[0]}" not in p}
    assert run() == []
    write(f"{source}/1.txt", 1, [1, 3], n=14)  # changed: the first day is gone from it, another one came
    assert run() == [days[0], days[1], days[3]]
    equal()
    os.remove(f"{source}/2.txt")  # a day without files is no longer there
    assert run() == [days[2]]
    equal()
    assert not os.path.exists(f"{out}/service_date={days[2]}")
    write(f"{source}/bad.txt", 9, [0], ["x"])
    assert run() == []
    assert run() == []
    unread = spark.read.parquet(f"{out}-rejects/run=*").filter("step = 'file'")
    assert unread.count() == 1


def test_a_run_that_was_cut_off_is_done_again(spark, tmp_path, monkeypatch):
    source, out, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    write(f"{source}/1.txt", 1, [0])
    monkeypatch.setattr(ingest.Ledger, "store", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    with pytest.raises(RuntimeError):
        ingest.ingest(spark, source, out, ledger)
    monkeypatch.undo()
    assert ingest.ingest(spark, source, out, ledger).count() == 1
    assert rows(datasets.read_dataset(spark, out), *LINKED) == linked_of(spark, source)


def test_the_daily_build_computes_segments_once(spark, tmp_path, monkeypatch):
    write(str(tmp_path / "in/a.txt"), 1, [0, 1])
    raw, _ = pings_tsv.read_unlike_tsv(spark, pings_tsv.file_headers(spark, str(tmp_path / "in")))
    stored = []
    monkeypatch.setattr(daily, "stage", lambda df, label: stored.append(label) or stage(df, label))
    linked, rejects = daily.build(raw)
    assert stored[0] == "chains"
    linked.collect(), rejects.collect()
    plan = rejects._jdf.queryExecution().executedPlan().toString()
    # The only scan of the text is that for rejected pings, without a shuffle.
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan
    assert "FileScan csv" not in linked._jdf.queryExecution().executedPlan().toString()


def day_by_day(spark, df, tmp_path, order):
    at = [str(tmp_path / n) for n in ("rows", "starts", "states")]
    for day in order:
        df.filter(df.service_date == day).write.mode("append").partitionBy("service_date").parquet(at[0])
        ingest.extend_starts(spark, *at, [day])
    return datasets.read_dataset(spark, at[1]), at


@pytest.mark.parametrize("seed", range(3))
def test_starts_day_by_day_equal_all_at_once(spark, tmp_path, seed):
    rng = random.Random(seed)
    days = {
        v: [[(rng.randrange(4), rng.randrange(3)) for _ in range(rng.choice([0, 1, 3, 8]))] for _ in range(5)]
        for v in range(12)
    }
    data = make(days)
    df = spark.createDataFrame(data, SCHEMA)
    want = rows(trip_start.trip_starts(df), "first_time", *df.columns)
    assert len(want) < len(look_back(data))
    order = sorted({r[1] for r in data})
    if seed:
        rng.shuffle(order)
    got, _ = day_by_day(spark, df, tmp_path, order)
    assert rows(got, "first_time", *df.columns) == want


def test_a_new_day_reads_its_rows_and_the_state_only(spark, tmp_path):
    data = make({v: [[(1, 1), (2, 1)], [(5, 5), (6, 5)], [(6, 5), (2, 2)]] for v in range(3)})
    df = spark.createDataFrame(data, SCHEMA)
    order = sorted({r[1] for r in data})
    _, at = day_by_day(spark, df, tmp_path, order[:2])
    df.filter(df.service_date == order[2]).write.mode("append").partitionBy("service_date").parquet(at[0])
    day = datasets.read_dataset(spark, at[0]).filter(f"service_date = date'{order[2]}'")
    state = ingest.States(spark, at[2]).before(order[2])
    starts, after = trip_start.later_starts(day, state)
    used = {re.sub(r".*/([^/]+)/[^/]+$", r"\1", f) for f in starts.inputFiles() if "day-edges" not in f}
    assert f"as-of={order[1]}" in used and f"as-of={order[0]}" not in used
    plan = starts._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^]]*service_date", plan)) == 1
    assert rows(after, "vehicle_id", "service_date", "closing_stop") == [(v, order[2], 2) for v in range(3)]


def test_codes_stay_and_new_ids_follow(spark, tmp_path):
    dictionary = encoding.StableDictionary(spark, str(tmp_path / "codes"))
    ids = lambda *found: spark.createDataFrame([(i,) for i in found], "id long")
    assert dictionary.codes().isEmpty()
    assert rows(dictionary.merge(ids(30, 10, 10, None)), "id", "code") == [(10, 1), (30, 2)]
    assert rows(dictionary.merge(ids(20, 30, 5)), "id", "code") == [(5, 3), (10, 1), (20, 4), (30, 2)]
    assert rows(dictionary.merge(ids(20)), "id", "code", "version") == [(5, 3, 2), (10, 1, 1), (20, 4, 2), (30, 2, 1)]
    assert dictionary.versions() == [1, 2]
    assert rows(dictionary.codes(1), "id") == [(10,), (30,)]
    os.makedirs(tmp_path / "codes" / "version=3")  # cut off before it was complete
    assert rows(dictionary.merge(ids(7)), "id", "code")[1] == (7, 5)


def test_a_model_fitted_on_old_codes_scores_the_same(spark, sf_dir, tmp_path):
    from tripweave.operators import models
    from tripweave.plans.sample_pings import sample_pings

    linked = stage(daily.linked(sample_pings(spark, sf_dir)), "linked")
    dictionary = encoding.StableDictionary(spark, str(tmp_path / "codes"))
    first = linked.filter("service_date <= date'2014-08-02'")

    def coded():
        return encoding.encode_column(first, "exit_stop", dictionary.codes()).withColumnRenamed("arrive_time", "label")

    dictionary.merge(encoding.all_stops(first))
    features = ["day_of_week", "exit_time", "exit_stop"]
    model = models.fit_pipeline(coded(), features, models.fit_linear)
    before = rows(models.score(model, coded()), "vehicle_id", "exit_time", "exit_stop", "prediction")
    dictionary.merge(encoding.all_stops(linked).union(spark.range(1, 5)))
    assert rows(models.score(model, coded()), "vehicle_id", "exit_time", "exit_stop", "prediction") == before


def test_pings_of_unlike_files_are_typed(spark, tmp_path):
    write(str(tmp_path / "in/a.txt"), 1, [0])
    raw, _ = pings_tsv.read_unlike_tsv(spark, pings_tsv.file_headers(spark, str(tmp_path / "in/*.txt")))
    assert cleaning.clean_pings(cleaning.type_pings(raw)).count() == 16


def test_rejects_read_their_text_pings_from_a_stored_table(spark, sf_dir):
    """Read by several steps, their text would be made anew by each, and once more in each filter on it."""
    plan = registry._broken_text(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Project" not in plan


def test_headers_of_known_files_are_not_read_again(spark, tmp_path, monkeypatch):
    source, out, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    read = []

    def reading(spark, paths):
        read.append(sorted(os.path.basename(p) for p in paths))
        return pings_tsv.first_lines(spark, paths)

    monkeypatch.setattr(ingest, "first_lines", reading)
    for name, vehicle in (("a.txt", 1), ("b.txt", 2), (None, None)):
        if name:
            write(f"{source}/{name}", vehicle, [0])
        ingest.ingest(spark, source, out, ledger)
    assert read == [["a.txt"], ["b.txt"], []]
    assert rows(datasets.read_dataset(spark, out), *LINKED) == linked_of(spark, source)
