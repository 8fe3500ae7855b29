import random
from datetime import date

import pytest

from pyspark.sql import functions as F

from tripweave.operators import splits
from tripweave.operators.views import CHRONOLOGICAL

SCHEMA = "service_date date, exit_time int, label int, vehicle_id int, note string"


def table(spark, n, seed=0, seconds=5):
    rng = random.Random(seed)
    data = [
        (date(2014, 8, rng.randrange(1, 4)), rng.randrange(seconds), rng.randrange(3), i, rng.choice(["a", "b"])) for i in range(n)
    ]
    return data, spark.createDataFrame(data, SCHEMA)


def collected(part):
    return sorted(tuple(r) for r in part.collect())


def in_order(data):
    return sorted(data)


@pytest.mark.parametrize("n", [7, 10, 200])
def test_holdout(spark, n):
    data, df = table(spark, n)
    train, test = splits.holdout_split(splits.in_order(df))
    cut = int(n * 0.9)
    assert collected(train) == in_order(data)[:cut]
    assert collected(test) == in_order(data)[cut:]


@pytest.mark.parametrize("n, sizes", [(7, (5, 1, 1)), (10, (8, 1, 1)), (11, (8, 1, 2)), (200, (160, 20, 20))])
def test_three_parts(spark, n, sizes):
    data, df = table(spark, n, seed=n)
    rows = splits.in_order(df)
    parts = [collected(p) for p in splits.three_way_split(rows)]
    assert tuple(len(p) for p in parts) == sizes
    assert parts[0] + parts[1] + parts[2] == in_order(data)
    labelled = rows.label(splits.three_way_cuts(n), ["a", "b", "c"])
    for name, part in zip("abc", parts, strict=True):
        assert collected(labelled.filter(F.col("split") == name).drop("split")) == part


@pytest.mark.parametrize("n, held", [(7, 1), (10, 1), (11, 2), (30, 3)])
def test_tail_is_rounded_up(spark, n, held):
    data, df = table(spark, n)
    train, test = splits.tail_split(splits.in_order(df), 0.1)
    assert collected(train) == in_order(data)[: n - held]
    assert collected(test) == in_order(data)[n - held :]


def test_identical_rows_are_shared_out(spark):
    data = [(date(2014, 8, 1), 1, 1, 1, "a")] * 8 + [(date(2014, 8, 2), 1, 1, 1, "a")] * 2
    df = spark.createDataFrame(data, SCHEMA)
    rows = splits.in_order(df)
    head, tail = rows.split([5])
    assert collected(head) == data[:5]
    assert collected(tail) == data[5:]
    assert collected(rows.boundary(5).after(df)) == data[5:]


def test_missing_values_sort_first_and_stay(spark):
    data = [(None, None, 1, 1, "a"), (None, 2, None, 2, None), (date(2014, 8, 1), None, 1, 3, "a"), (date(2014, 8, 1), 3, 1, 4, None)]
    df = spark.createDataFrame(data, SCHEMA)
    for cut in range(5):
        head, tail = splits.in_order(df).split([cut])
        assert {r["vehicle_id"] for r in head.collect()} == set(range(1, cut + 1))
        assert {r["vehicle_id"] for r in tail.collect()} == set(range(cut + 1, 5))


def test_except_form_loses_repeats(spark):
    data, df = table(spark, 30, seconds=2)
    columns = ["exit_time", "label"]
    train, test = splits.except_split(splits.in_order(df), columns)
    seen = {r[1:3] for r in in_order(data)[:27]}
    want = {r[1:3] for r in in_order(data)[27:]} - seen
    assert train.count() == 27
    assert collected(test) == sorted(want)


def test_head_is_ordered(spark):
    data, df = table(spark, 50)
    got = [tuple(r) for r in splits.ordered_head(df, 5).collect()]
    assert got == in_order(data)[:5]


def test_order_covers_every_column(spark):
    _, df = table(spark, 1)
    assert set(splits.total_order(df, CHRONOLOGICAL)) == set(df.columns)


def test_positions_are_those_of_the_order(spark):
    data, df = table(spark, 120)
    got = splits.in_order(df).numbered("position").collect()
    assert [tuple(r)[:-1] for r in sorted(got, key=lambda r: r["position"])] == in_order(data)
    assert sorted(r["position"] for r in got) == list(range(1, 121))


def test_a_stored_boundary_tells_the_same_rows_apart(spark, tmp_path):
    data, df = table(spark, 60, seconds=2)
    rows = splits.in_order(df)
    rows.boundary(41).save(spark, str(tmp_path / "b"))
    held = splits.Boundary.load(spark, str(tmp_path / "b")).after(df.repartition(3))
    assert collected(held) == in_order(data)[41:]
    assert rows.boundary(60) is None


def test_files_hold_neighbouring_days_and_parts_skip_the_others(spark):
    df = spark.range(4000).selectExpr("date_add(date'2014-08-01', int(id % 40)) AS service_date", "int(id) AS exit_time")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = splits.in_order(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    days = rows.rows.groupBy(F.input_file_name()).agg(F.count_distinct("service_date").alias("days")).collect()
    assert len(days) > 1 and sum(r["days"] for r in days) <= 40 + len(days)
    plan = rows.between(0, 400)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_place)" in plan
    assert "Exchange" not in plan
    assert rows.label([400], ["a", "b"])._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
