"""The whole chain, job by job, over text pings."""

import os

from tripweave.__main__ import build_parser, main, run
from tripweave.operators.cleaning import PING_COLUMNS, clean_pings, type_pings
from tripweave.plans import daily, features
from tripweave.session import scratch_dir, stage
from tripweave.sources.pings_tsv import read_headerless, read_pings_tsv, write_pings_tsv
from tripweave.plans.sample_pings import sample_pings


def test_chain(spark, sf_dir, tmp_path, capfd):
    at = lambda name: str(tmp_path / name)
    pings = stage(sample_pings(spark, sf_dir), "pings")
    write_pings_tsv(pings, at("pings"))
    for job in (
        ["daily", at("pings/*"), at("linked")],
        ["compact", at("linked"), "--target-mb", "64"],
        ["trips", at("linked"), at("trips")],
        ["commute", at("trips"), at("commute")],
        ["union", at("trips"), at("union")],
        ["table", at("commute"), at("table"), "--bounds", at("trips-bounds")],
        ["fit", at("table"), at("model"), "--scaler", "all"],
        ["score", at("table"), at("model"), "--report", at("report")],
        ["best", at("table"), at("best-model"), "--features", "short"],
        ["scored", at("table"), at("scored")],
        ["preview", at("table"), "-n", "3"],
        ["profile", at("table")],
        ["gaps", at("pings/*"), "--from", "2014-08-01", "--to", "2014-10-31", "-n", "200"],
    ):
        main(job)
        assert not os.path.exists(scratch_dir(spark).removeprefix("file:"))
    shown = capfd.readouterr().out
    assert "within_600" in shown and "2014-10-31" in shown and "label_min" in shown

    pings = sample_pings(spark, sf_dir)
    want = features.model_table(stage(daily.linked(pings), "linked")).table
    table = spark.read.parquet(at("table")).select(*want.columns)
    assert {tuple(r) for r in table.collect()} == {tuple(r) for r in want.collect()}

    def metrics(*job):
        return {r["metric"]: r["value"] for r in run(spark, build_parser().parse_args(job))[0].collect()}

    assert metrics("score", at("table"), at("model"))["rows"] == want.count() - int(want.count() * 0.9)
    assert metrics("score", at("table"), at("model"), "--resplit", "0.8")["rows"] == want.count() - int(want.count() * 0.8)
    assert spark.read.parquet(at("report") + "/0").count() == 7
    assert spark.read.parquet(at("linked-rejects")).isEmpty() and spark.read.parquet(at("trips-rejects")).isEmpty()
    day = spark.read.parquet(at("linked")).filter("service_date = date'2014-08-01'")
    assert "PartitionFilters: [isnotnull(service_date" in day._jdf.queryExecution().executedPlan().toString()


def test_rejects_and_kept_pings_are_all_pings(spark, tmp_path):
    header = "\t".join(PING_COLUMNS)
    lines = [f"2014-08-01 06:00:{i:02d}\t{'x' if i % 7 == 0 else 5}\t{i * 40}\tIN_PROGRESS\t{900 - i * 40}\tMTA_1" for i in range(60)]
    (tmp_path / "a.txt").write_text("\n".join([header, *lines]) + "\n")
    raw = read_pings_tsv(spark, str(tmp_path / "a.txt"))
    rejected = daily.rejects(raw)
    assert {(r["step"], r["reason"]) for r in rejected.collect()} == {("ping", "vehicle_id")}
    assert rejected.count() + clean_pings(type_pings(raw)).count() == 60


def test_headerless_files_by_names(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\t2014-08-01 06:00:01\t7\t1.5\tIN_PROGRESS\t10\tMTA_3\n")
    names = "id,time_received,vehicle_id,distance_along_trip,inferred_phase,next_scheduled_stop_distance,next_scheduled_stop_id"
    got = read_headerless(spark, str(tmp_path / "a.txt"), names.split(","))
    assert got.columns == PING_COLUMNS and got.first()["vehicle_id"] == "7"
