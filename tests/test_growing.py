"""What grows without reading everything again: order, moments, sketches, boosting, and the search that learns."""

import math
import random
import re
import statistics
from datetime import date, timedelta

import pytest

from tripweave.operators import boosting, metrics, models, moments, order_index, splits
from tripweave.sources import datasets, files, profile

FIRST = date(2014, 8, 1)
SCHEMA = "service_date date, exit_time double, label double, exit_stop int"


def some_rows(rng, n, days=4):
    found = [(FIRST + timedelta(days=rng.randrange(days)), rng.randrange(20) / 20, 1.0, rng.randrange(3)) for _ in range(n)]
    return found + found[: n // 4] + [(None, 0.5, 1.0, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_cuts_over_runs_equal_those_of_one_sort(spark, tmp_path, seed):
    rng = random.Random(seed)
    data = some_rows(rng, 120)
    index = order_index.OrderIndex(spark, str(tmp_path / "index"))
    for part in range(3):
        index.append(spark.createDataFrame(data[part::3], SCHEMA))
    whole = splits.in_order(spark.createDataFrame(data, SCHEMA))
    assert index.count() == whole.count == len(data)
    cuts = sorted(rng.sample(range(len(data)), 2)) + [len(data)]
    same = cuts[:1] * 2 + cuts[1:2]
    for at in (cuts, same, [0, 1]):
        got = [sorted(map(tuple, p.collect()), key=str) for p in index.split(at)]
        assert got == [sorted(map(tuple, p.collect()), key=str) for p in whole.split(at)]
    index.merge()
    assert len(index.runs()) == 1 and index.count() == len(data)
    assert [p.count() for p in index.split(cuts[:1])] == [cuts[0], len(data) - cuts[0]]


def test_parts_over_runs_read_the_days_of_their_cuts_only(spark, tmp_path):
    """Every scan of a part says what the cut means for the day, by which sorted files are skipped."""
    index = order_index.OrderIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame([(FIRST + timedelta(days=i), 0.5, 1.0, i) for i in range(6)], SCHEMA))
    for part, bounds in zip(index.split([2, 4]), ({"<="}, {">=", "<=", "="}, {">=", "="}), strict=True):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        compared = [re.findall(r"\(service_date#\d+ (\S+) 2014", line) for line in plan.splitlines() if "struct(" in line]
        assert all(compared) and {c for found in compared for c in found} == bounds


def test_an_append_leaves_stored_runs_alone(spark, tmp_path):
    rng = random.Random(9)
    index = order_index.OrderIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame(some_rows(rng, 50), SCHEMA))
    before = {(r["path"], r["modified"]) for r in files.listed(spark, index.folder.path, "*.parquet").collect()}
    index.append(spark.createDataFrame(some_rows(rng, 50), SCHEMA))
    after = {(r["path"], r["modified"]) for r in files.listed(spark, index.folder.path, "*.parquet").collect()}
    assert before <= after
    # A run whose counts are missing was cut off, and is written anew.
    index.folder.delete(index._path(2, "days"))
    assert index.runs() == [1]
    index.append(spark.createDataFrame(some_rows(rng, 10), SCHEMA))
    assert index.runs() == [1, 2] and index.rows().count() == index.count()


def test_merged_moments_equal_a_full_fit(spark, tmp_path):
    rng = random.Random(2)
    data = [(FIRST + timedelta(days=i % 5), rng.gauss(1e6, 3.0), None if i % 3 else float(i), 7.0) for i in range(400)]
    df = spark.createDataFrame(data, "service_date date, a double, b double, c double")
    path = str(tmp_path / "moments")
    moments.write_moments(moments.day_moments(df.filter("day(service_date) < 3"), ["a", "b", "c"]), path)
    moments.write_moments(moments.day_moments(df.filter("day(service_date) >= 3"), ["a", "b", "c"]), path)
    moments.write_moments(moments.day_moments(df.filter("day(service_date) = 2"), ["a", "b", "c"]), path)  # again
    stored = datasets.read_dataset(spark, path)
    for states, kept in ((stored, data), (stored.filter("day(service_date) <> 4"), [r for r in data if r[0].day != 4])):
        got = {r["feature"]: r for r in moments.merged(states).collect()}
        scaler = moments.zscore_of(states)
        for i, c in enumerate("abc", 1):
            values = [r[i] for r in kept if r[i] is not None]
            assert got[c]["n"] == len(values) and (got[c]["low"], got[c]["high"]) == (min(values), max(values))
            assert scaler.mean[c] == pytest.approx(statistics.fmean(values), rel=1e-9)
            assert scaler.deviation[c] == pytest.approx(statistics.pstdev(values) or 1.0, rel=1e-9)
    assert moments.bounds_of(stored, "b").high == 399.0


def test_profiles_of_days_are_merged_without_rows(spark, tmp_path):
    rng = random.Random(3)
    data = [(FIRST + timedelta(days=i % 6), rng.randrange(5000), rng.random() if i % 9 else None, None) for i in range(20_000)]
    df = spark.createDataFrame(data, "service_date date, a int, b double, c double")
    path = str(tmp_path / "profiles")
    profile.day_profiles(df, ["a", "b", "c"]).write.partitionBy("service_date").parquet(path)
    some = datasets.read_dataset(spark, path).filter("day(service_date) between 2 and 5")
    got = {r["column"]: r for r in profile.merged_profile(some).collect()}
    kept = [r for r in data if 2 <= r[0].day <= 5]
    for i, c in enumerate("ab", 1):
        values = sorted(r[i] for r in kept if r[i] is not None)
        assert (got[c]["row_count"], got[c]["nulls"]) == (len(kept), len(kept) - len(values))
        assert got[c]["distinct_about"] == pytest.approx(len(set(values)), rel=3 * profile.DISTINCT_ERROR)
        for q in (25, 50, 75):
            rank = sum(v <= got[c][f"q{q}"] for v in values) / len(values)
            assert rank == pytest.approx(q / 100, abs=profile.RANK_ERROR + 1e-3)
    assert got["c"]["q50"] is None and got["c"]["nulls"] == len(kept)


@pytest.fixture(scope="module")
def parts(spark):
    data = [(i % 7, float(i * i % 31), float(3 * (i % 7) + (i * i % 31) ** 1.5)) for i in range(300)]
    df = spark.createDataFrame(data, "a int, b double, label double")
    return models.scale_parts([df.filter("a < 6"), df.filter("a = 6")], ["a", "b"])


def test_a_resumed_run_equals_an_uninterrupted_one(spark, parts, tmp_path, monkeypatch):
    train, validation = parts
    whole = boosting.boost(train, validation, str(tmp_path / "whole"), 6, per_round=2, step=0.5, depth=2)
    boosting.boost(train, validation, str(tmp_path / "cut"), 6, per_round=2, step=0.5, depth=2, most_rounds=1)
    store = boosting.Rounds.store

    def cut_off(self, number, trees, kept, losses):
        store(self, number, trees, dict(list(kept.items())[:1]), losses) if number < 0 else None
        raise RuntimeError("cut off")

    monkeypatch.setattr(boosting.Rounds, "store", cut_off)
    with pytest.raises(RuntimeError):
        boosting.boost(train, validation, str(tmp_path / "cut"), 6, per_round=2, step=0.5, depth=2)
    monkeypatch.undo()
    resumed = boosting.boost(train, validation, str(tmp_path / "cut"), 6, per_round=2, step=0.5, depth=2)
    assert resumed.losses == pytest.approx(whole.losses, rel=1e-9)
    trees = boosting.Rounds(spark, str(tmp_path / "cut")).trees(6)
    full = models.trees_as_model(spark, trees, [boosting.weight_of(i, 0.5) for i in range(6)])
    assert boosting.loss_after(full, validation) == pytest.approx(whole.losses, rel=1e-9)
    error = models.score(resumed.model, validation).agg(metrics.rmse()).first()[0]
    assert error**2 == pytest.approx(min(whole.losses))


def test_patience_stops_the_growth(spark, parts, tmp_path):
    train, validation = parts
    best = boosting.boost(train, validation, str(tmp_path / "m"), 12, per_round=3, patience=0, step=0.5, depth=2)
    assert len(best.losses) == 3


BOX = {"x": (0.0, 10.0), "y": (-5.0, 5.0), "n": (1, 40)}


def hill(point, whole=True):
    return -((point["x"] - 7.3) ** 2) - 2 * (point["y"] + 1.1) ** 2 - 0.05 * (point["n"] - 12) ** 2


def test_the_search_beats_as_many_random_draws():
    won = 0
    for seed in range(20):
        trials = models.search(hill, BOX, 40, 50, random.Random(seed))
        assert len(trials) == 90 and [t["trial"] for t in trials] == list(range(1, 91))
        for t in trials:
            assert all(low <= t[c] <= high for c, (low, high) in BOX.items())
        guided = max(t["target"] for t in trials if t["share"] == 1.0)
        drawn = random.Random(1000 + seed)
        won += guided > max(hill(models._draw(drawn, BOX)) for _ in range(90))
    assert won >= 17


def test_only_the_best_proposals_go_on_to_all_rows():
    calls = []

    def objective(point, whole):
        calls.append(whole)
        return hill(point) - (0 if whole else 100)

    trials = models.search(objective, BOX, 5, 10, random.Random(1))
    guided = trials[5:]
    assert sum(t["share"] == 1.0 for t in guided) == 4 and calls.count(False) == 10
    lost = [t["target"] + 100 for t in guided if t["share"] < 1]
    assert min(t["target"] for t in guided if t["share"] == 1) >= max(lost)
    assert math.isclose(max(t["target"] for t in trials if t["share"] == 1), max(hill(t) for t in trials if t["share"] == 1))


def test_without_random_trials_the_first_round_is_drawn():
    assert len(models.search(hill, BOX, 0, 12, random.Random(1))) == 12


def test_a_parameter_with_one_value_keeps_it():
    box = {"x": (0.0, 10.0), "fixed": (7, 7)}
    trials = models.search(lambda p, whole: -abs(p["x"] - 3), box, 5, 30, random.Random(2))
    assert len(trials) == 35 and {t["fixed"] for t in trials} == {7}
    assert max(t["target"] for t in trials) > max(t["target"] for t in trials[:5])
