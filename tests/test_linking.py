import random

import pytest
from helpers import DAY, rows

from tripweave.operators import linking

EDGES = "vehicle_id long, service_date date, exit_stop long, target_stop long, distance double"
LINKED = ["vehicle_id", "exit_stop", "target_stop", "distance", "first_stop", "total_distance"]


def edges(spark, found, vehicle=1):
    return spark.createDataFrame([(vehicle, DAY, a, b, float(d)) for a, b, d in found], EDGES)


def linked(spark, found):
    got = linking.link_routes(edges(spark, found))
    return rows(got, "exit_stop", "target_stop", "first_stop", "total_distance")


def walk(found):
    """Route by route, pass by pass: roots ascending, shortest known way to each stop."""
    targets = {b for _, b, _ in found}
    routes = {r: {r: 0.0} for r in sorted({a for a, _, _ in found} - targets)}
    claimed, result = set(), []
    for _ in range(len(found)):
        for root, known in routes.items():
            now = [i for i, e in enumerate(found) if i not in claimed and e[0] in known]
            reached = {}
            for i in now:
                a, b, d = found[i]
                claimed.add(i)
                result.append((a, b, root, d + known[a]))
                reached[b] = min(reached.get(b, float("inf")), d + known[a])
            for stop, total in reached.items():
                known[stop] = min(known.get(stop, float("inf")), total)
    return sorted(result)


def test_chain(spark):
    assert linked(spark, [(1, 2, 100), (2, 3, 200)]) == [(1, 2, 1, 100.0), (2, 3, 1, 300.0)]


def test_two_roots_same_depth_smaller_root_wins(spark):
    got = linked(spark, [(5, 9, 100), (4, 9, 300), (9, 10, 100)])
    assert (9, 10, 4, 400.0) in got


def test_fewer_hops_beat_a_smaller_root(spark):
    got = linked(spark, [(1, 2, 100), (2, 9, 100), (5, 9, 700), (9, 10, 100)])
    assert (9, 10, 5, 800.0) in got


def test_shortest_way_within_a_route(spark):
    got = linked(spark, [(1, 9, 300), (1, 9, 200), (9, 10, 100)])
    assert (9, 10, 1, 300.0) in got


def test_cycles_and_self_loops(spark):
    assert linked(spark, [(1, 2, 100), (2, 1, 100)]) == []
    assert linked(spark, [(1, 1, 100)]) == []
    assert linked(spark, [(1, 2, 100), (2, 2, 100), (2, 3, 100)]) == [
        (1, 2, 1, 100.0),
        (2, 2, 1, 200.0),
        (2, 3, 1, 200.0),
    ]


def test_any_number_of_hops(spark):
    got = linked(spark, [(i, i + 1, 10) for i in range(1, 151)])
    assert len(got) == 150
    assert got[-1] == (150, 151, 1, 1500.0)


def random_edges(seed, n=60, stops=40):
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        a = rng.randrange(1, stops)
        b = min(stops, a + rng.randrange(1, 4)) if rng.random() < 0.9 else rng.randrange(1, stops)
        found.append((a, b, 10 * rng.randrange(10, 200)))
    return found


@pytest.mark.parametrize("batch", [10_000, 7])
def test_many_vehicles_equal_the_pass_by_pass_reading(spark, batch):
    days = {v: random_edges(v) for v in range(1, 31)}
    table = spark.createDataFrame([(v, DAY, a, b, float(d)) for v, f in days.items() for a, b, d in f], EDGES)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = rows(linking.link_routes(table), "vehicle_id", "exit_stop", "target_stop", "first_stop", "total_distance")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted((v, *e) for v, f in days.items() for e in walk([(a, b, float(d)) for a, b, d in f]))


def test_relational_hops_agree(spark):
    table = edges(spark, random_edges(99))
    claims = linking.root_claims(table).checkpoint()
    found, everything = [], claims
    fresh = claims
    for _ in range(20):
        hop = linking.frontier_segments(table, fresh).checkpoint()
        if hop.isEmpty():
            break
        found += rows(hop, *LINKED)
        fresh = linking.next_claims(hop, everything).checkpoint()
        everything = everything.unionByName(fresh).checkpoint()
    assert sorted(found) == rows(linking.link_routes(table), *LINKED)


def test_empty_input(spark):
    assert linked(spark, []) == []
