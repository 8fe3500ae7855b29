"""The registered queries in plain SQL, for checking them on another engine.

Written independently of the operators where the semantics allow: plain windows over whole groups
where the operators split them, and a recursive query for the routes.
"""

from __future__ import annotations

import re

# Each step may use the steps it names. Steps are text: nothing here is executed by Spark.
STEPS: dict[str, tuple[list[str], str]] = {}


def _step(name: str, needs: list[str], sql: str) -> None:
    STEPS[name] = (needs, sql)


_step("lines", [], """
 SELECT CAST(l_suppkey AS BIGINT) AS vehicle_id,
  (l_orderkey*7 + l_partkey*13 + l_linenumber*31) AS h,
  ROW_NUMBER() OVER (PARTITION BY l_suppkey
   ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS n
 FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL""")

_step("trips", ["lines"], """
 SELECT *, CAST(floor(d/spacing) AS BIGINT) + 1 AS idx FROM (
  SELECT *, SUM(step) OVER (PARTITION BY vehicle_id, dayno, trip_no ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d FROM (
   SELECT vehicle_id, h, n, CAST(floor(n/200) AS BIGINT) AS dayno, n%200 AS m,
    CAST(floor((n%200)/50) AS BIGINT) AS trip_no, vehicle_id%5 AS r,
    CASE vehicle_id%5 WHEN 0 THEN 80 WHEN 1 THEN 150 WHEN 2 THEN 300 WHEN 3 THEN 450 ELSE 600 END AS spacing,
    CASE WHEN h%37=0 THEN 0 WHEN h%29=0 THEN 900 ELSE 40 + h%200 END AS step
   FROM lines))""")

_step("pings", ["trips"], """
 SELECT vehicle_id,
  TIMESTAMP '2014-08-01 06:00:00' + dayno * INTERVAL '1' DAY + (m*50 + h%7) * INTERVAL '1' SECOND AS time_received,
  CAST(d AS DOUBLE) AS distance_along_trip,
  CASE WHEN h%23=0 THEN 'LAYOVER_DURING' ELSE 'IN_PROGRESS' END AS inferred_phase,
  CASE WHEN h%41=0 THEN NULL ELSE CAST(idx*spacing - d + CASE WHEN h%17=0 THEN 25 ELSE 0 END AS DOUBLE) END
   AS next_scheduled_stop_distance,
  concat('MTA_', CAST(100000 + r*1000 + CASE WHEN r=4 AND vehicle_id%10=4 THEN idx%4 ELSE idx END AS BIGINT))
   AS next_scheduled_stop_id
 FROM trips""")

_step("clean", ["pings"], """
 SELECT vehicle_id, CAST(time_received AS DATE) AS service_date,
  CAST(hour(time_received)*3600 + minute(time_received)*60 + second(time_received) AS INTEGER) AS second_of_day,
  distance_along_trip, next_scheduled_stop_distance, next_scheduled_stop_id
 FROM pings
 WHERE inferred_phase = 'IN_PROGRESS' AND vehicle_id IS NOT NULL AND time_received IS NOT NULL
  AND distance_along_trip IS NOT NULL AND next_scheduled_stop_distance IS NOT NULL
  AND next_scheduled_stop_id IS NOT NULL""")

_ARRIVAL = "second_of_day, next_scheduled_stop_id, next_scheduled_stop_distance, distance_along_trip"

_step("dedup", ["clean"], f"""
 SELECT * FROM (
  SELECT * FROM (
   SELECT * FROM clean QUALIFY ROW_NUMBER() OVER (
    PARTITION BY vehicle_id, service_date, distance_along_trip ORDER BY {_ARRIVAL}) = 1)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY vehicle_id, service_date, second_of_day ORDER BY {_ARRIVAL}) = 1)
 QUALIFY ROW_NUMBER() OVER (
  PARTITION BY vehicle_id, service_date, next_scheduled_stop_distance, next_scheduled_stop_id ORDER BY {_ARRIVAL}) = 1""")

_step("pairs", ["dedup"], """
 SELECT *, lead(second_of_day) OVER w AS next_second, lead(distance_along_trip) OVER w AS next_distance,
  lead(next_scheduled_stop_distance) OVER w AS next_stop_distance, lead(next_scheduled_stop_id) OVER w AS next_stop_id
 FROM dedup
 WINDOW w AS (PARTITION BY vehicle_id, service_date ORDER BY second_of_day)
 QUALIFY lead(second_of_day) OVER w IS NOT NULL""")

_step("classified", ["pairs"], """
 SELECT * EXCLUDE (same_stop, inconsistent, marker, pending),
  CASE WHEN gap < 0 THEN 'backward' WHEN inconsistent THEN 'inconsistent'
   WHEN pending = 1 THEN 'swallowed' WHEN same_stop THEN 'same_stop'
   WHEN next_scheduled_stop_distance > gap THEN 'overshoot'
   WHEN speed < 0.1 OR speed > 20 THEN 'implausible' ELSE 'crossing' END AS pair_kind
 FROM (
  SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY vehicle_id, service_date ORDER BY second_of_day
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pending
  FROM (
   SELECT *, CASE WHEN gap < 0 THEN NULL WHEN inconsistent THEN 1 ELSE 0 END AS marker FROM (
    SELECT *, same_stop AND round_even(gap, 0) <> round_even(next_scheduled_stop_distance - next_stop_distance, 0)
      AS inconsistent
    FROM (
     SELECT *, next_distance - distance_along_trip AS gap,
      (next_distance - distance_along_trip) / (next_second - second_of_day) AS speed,
      next_scheduled_stop_id = next_stop_id AS same_stop
     FROM pairs))))""")

_step("crossings", ["classified"], """
 SELECT vehicle_id, service_date, second_of_day, chain_no, next_scheduled_stop_id AS stop_id,
  CAST(second_of_day AS BIGINT) * 1000000
   + CAST(round_even(next_scheduled_stop_distance / speed * 1000000, 0) AS BIGINT) AS crossed_us,
  distance_along_trip, next_scheduled_stop_distance AS metres_before,
  gap - next_scheduled_stop_distance AS metres_past, next_distance AS metres_along
 FROM (
  SELECT *, CAST(SUM(CASE WHEN pair_kind IN ('backward','inconsistent','overshoot','implausible') THEN 1 ELSE 0 END)
    OVER (PARTITION BY vehicle_id, service_date ORDER BY second_of_day
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS chain_no
  FROM classified)
 WHERE pair_kind = 'crossing'""")

_step("segments", ["crossings"], """
 SELECT vehicle_id, service_date,
  CAST(regexp_extract(exit_id, 'MTA_(\\d+)$', 1) AS BIGINT) AS exit_stop,
  CAST(regexp_extract(stop_id, 'MTA_(\\d+)$', 1) AS BIGINT) AS target_stop,
  distance, exit_us, arrive_us
 FROM (
  SELECT *, max(CASE WHEN ok THEN pos END) OVER (PARTITION BY vehicle_id, service_date, chain_no ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_ok
  FROM (
   SELECT *, pos = 1 OR (distance >= 100 AND distance <= 2000) AS ok FROM (
    SELECT vehicle_id, service_date, chain_no, stop_id, crossed_us AS arrive_us,
     ROW_NUMBER() OVER w AS pos, lag(stop_id) OVER w AS exit_id, lag(crossed_us) OVER w AS exit_us,
     lag(metres_past) OVER w + distance_along_trip - lag(metres_along) OVER w + metres_before AS distance
    FROM crossings
    WINDOW w AS (PARTITION BY vehicle_id, service_date, chain_no ORDER BY second_of_day))))
 WHERE pos > 1 AND ok AND (pos - 1 - last_ok) % 2 = 0""")

_step("rounded", ["segments"], """
 SELECT * REPLACE (round_even(distance / 10, 0) * 10 AS distance) FROM segments""")

_step("modes", ["rounded"], """
 SELECT service_date, exit_stop, target_stop, distance FROM (
  SELECT service_date, exit_stop, target_stop, distance, count(*) AS n
  FROM rounded GROUP BY service_date, exit_stop, target_stop, distance)
 QUALIFY ROW_NUMBER() OVER (PARTITION BY service_date, exit_stop, target_stop ORDER BY n DESC, distance) = 1""")

_step("modal", ["rounded", "modes"], """
 SELECT r.vehicle_id, r.service_date, r.exit_stop, r.target_stop, m.distance, r.exit_us, r.arrive_us
 FROM rounded r JOIN modes m ON r.service_date = m.service_date AND r.exit_stop = m.exit_stop
  AND r.target_stop = m.target_stop
 WHERE r.distance > m.distance - 10 AND r.distance < m.distance + 10""")

_step("roots", ["modal"], """
 SELECT DISTINCT vehicle_id, service_date, exit_stop AS stop FROM modal e
 WHERE NOT EXISTS (SELECT 1 FROM modal t WHERE t.vehicle_id = e.vehicle_id
  AND t.service_date = e.service_date AND t.target_stop = e.exit_stop)""")

_step("claim(vehicle_id, service_date, stop, first_stop, base, hop) USING KEY (vehicle_id, service_date, stop)",
      ["roots", "modal"], """
 SELECT vehicle_id, service_date, stop, stop, CAST(0 AS DOUBLE), 0 FROM roots
 UNION
 SELECT vehicle_id, service_date, target_stop, first_stop, total, hop + 1 FROM (
  SELECT e.vehicle_id, e.service_date, e.target_stop, c.first_stop, c.base + e.distance AS total, c.hop,
   ROW_NUMBER() OVER (PARTITION BY e.vehicle_id, e.service_date, e.target_stop
    ORDER BY c.first_stop, c.base + e.distance) AS nth
  FROM claim c JOIN modal e ON e.vehicle_id = c.vehicle_id AND e.service_date = c.service_date AND e.exit_stop = c.stop
  WHERE NOT EXISTS (SELECT 1 FROM recurring.claim r WHERE r.vehicle_id = e.vehicle_id
   AND r.service_date = e.service_date AND r.stop = e.target_stop))
 WHERE nth = 1""")

CLAIM = next(reversed(STEPS))

_step("routes", [CLAIM, "modal"], """
 SELECT e.vehicle_id, e.service_date, e.exit_stop, e.target_stop, e.distance, e.exit_us, e.arrive_us,
  c.first_stop, e.distance + c.base AS total_distance
 FROM modal e JOIN claim c ON e.vehicle_id = c.vehicle_id AND e.service_date = c.service_date
  AND e.exit_stop = c.stop""")

_step("linked", ["routes"], """
 SELECT CAST(vehicle_id AS INTEGER) AS vehicle_id, CAST(month(service_date) AS INTEGER) AS month,
  CAST(day(service_date) AS INTEGER) AS day_of_month, CAST(isodow(service_date) - 1 AS INTEGER) AS day_of_week,
  first_stop, exit_stop, target_stop, total_distance, distance,
  (exit_us // 1000000) / 86400 AS exit_time, (arrive_us // 1000000) / 86400 AS arrive_time, service_date
 FROM routes""")

_step("stops", ["linked"], """
 SELECT id, CAST(ROW_NUMBER() OVER (ORDER BY id) AS INTEGER) AS code
 FROM (SELECT exit_stop AS id FROM linked UNION SELECT target_stop FROM linked)""")

_step("vehicles", ["linked"], """
 SELECT id, CAST(ROW_NUMBER() OVER (ORDER BY id) AS INTEGER) AS code
 FROM (SELECT DISTINCT CAST(vehicle_id AS BIGINT) AS id FROM linked)""")

_step("encoded", ["linked", "stops", "vehicles"], """
 SELECT l.* REPLACE (v.code AS vehicle_id, f.code AS first_stop, e.code AS exit_stop, t.code AS target_stop)
 FROM linked l LEFT JOIN vehicles v ON v.id = l.vehicle_id LEFT JOIN stops f ON f.id = l.first_stop
  LEFT JOIN stops e ON e.id = l.exit_stop LEFT JOIN stops t ON t.id = l.target_stop""")

_step("bounds", ["linked"], """
 SELECT min(total_distance) AS low, max(total_distance) AS high FROM linked""")

_step("scaled", ["encoded", "bounds"], """
 SELECT * EXCLUDE (arrive_time, low, high) REPLACE (
   (total_distance - low) / (high - low) AS total_distance, (distance - low) / (high - low) AS distance),
  arrive_time AS label
 FROM encoded, bounds""")

_VEHICLE_ORDER = "service_date, exit_time, label, exit_stop, target_stop, first_stop, distance, total_distance"

_step("changes", ["scaled"], f"""
 SELECT *, COALESCE(first_stop <> lag(first_stop) OVER (PARTITION BY vehicle_id ORDER BY {_VEHICLE_ORDER}), FALSE)
  AS changed
 FROM scaled""")

_step("filled", ["changes"], f"""
 SELECT * EXCLUDE (changed),
  last_value(CASE WHEN changed THEN exit_time END IGNORE NULLS) OVER w AS first_time,
  last_value(CASE WHEN changed THEN exit_stop END IGNORE NULLS) OVER w AS run_stop
 FROM changes
 WINDOW w AS (PARTITION BY vehicle_id ORDER BY {_VEHICLE_ORDER}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

_step("started", ["filled"], """
 SELECT * EXCLUDE (run_stop) FROM filled WHERE first_stop = run_stop AND first_time IS NOT NULL""")

_step("commute", ["started"], """
 SELECT * FROM started WHERE label >= 0.291::DOUBLE AND label <= 0.458::DOUBLE""")

_step("commute_both", ["started"], """
 SELECT * FROM started WHERE exit_time >= 0.291::DOUBLE AND label <= 0.458::DOUBLE""")


def _unscaled(low: str, high: str) -> str:
    distances = [f"CAST(round({c} * ({high} - {low}) + {low}) AS INTEGER) AS {c}" for c in ("total_distance", "distance")]
    times = [f"CAST(round({c} * 86400) AS INTEGER) AS {c}" for c in ("first_time", "exit_time", "label")]
    return ", ".join(distances + times)


_step("unscaled", ["commute", "bounds"], f"""
 SELECT commute.* REPLACE ({_unscaled("low", "high")}) FROM commute, bounds""")

_step("unscaled_default", ["commute"], f"""
 SELECT * REPLACE ({_unscaled("CAST(100 AS DOUBLE)", "CAST(41260 AS DOUBLE)")}) FROM commute""")


def _ratio(a: str, b: str) -> str:
    """a / b for whole numbers, rounded half-up to two decimals without passing through binary fractions."""
    sign = f"(CASE WHEN (({a}) < 0) <> (({b}) < 0) THEN -1 ELSE 1 END)"
    whole = f"((200 * abs(CAST({a} AS BIGINT)) + abs({b})) // (2 * abs(CAST({b} AS BIGINT))))"
    return f"CASE WHEN {b} <> 0 THEN {sign} * {whole} / 100 END"


_step("with_speeds", ["unscaled"], f"""
 SELECT *, {_ratio("distance", "(label - exit_time)")} AS speed,
  {_ratio("total_distance", "(label - first_time)")} AS total_speed
 FROM unscaled""")

_step("model_input", ["with_speeds"], "SELECT * FROM with_speeds WHERE speed > 1")

_step("ranked", ["model_input"], """
 SELECT *, ROW_NUMBER() OVER (ORDER BY service_date, exit_time, label, exit_stop, target_stop, vehicle_id,
   first_stop, first_time, distance, total_distance, month, day_of_month, day_of_week, speed, total_speed) AS nth,
  count(*) OVER () AS n
 FROM model_input""")

_step("baseline", ["ranked"], """
 SELECT label, exit_time + distance / pace AS prediction
 FROM ranked, (
  SELECT CAST(sum(distance) AS DOUBLE) / CAST(sum(label - exit_time) AS DOUBLE) AS pace
  FROM ranked WHERE nth <= CAST(floor(n * 0.9::DOUBLE) AS BIGINT))
 WHERE nth > CAST(floor(n * 0.9::DOUBLE) AS BIGINT)""")


_step("chain", [], """
 SELECT * FROM (
  SELECT CAST(o_orderkey // 2000 AS BIGINT) AS vehicle_id, CAST(o_orderkey AS BIGINT) AS exit_stop,
   lead(CAST(o_orderkey AS BIGINT)) OVER (PARTITION BY o_orderkey // 2000 ORDER BY o_orderkey) AS target_stop,
   CAST(o_orderkey % 7 * 10 + 100 AS DOUBLE) AS distance
  FROM (SELECT DISTINCT o_orderkey FROM orders))
 WHERE target_stop IS NOT NULL""")


def _some(step: str) -> str:
    """A dictionary of the ids that vehicles other than every fourth use."""
    return re.sub(r"\bFROM linked\b", "FROM (SELECT * FROM linked WHERE vehicle_id % 4 <> 0)", STEPS[step][1])


for _name in ("stops", "vehicles"):
    _step(f"some_{_name}", ["linked"], _some(_name))

# The steps up to the crossings once more, over pings with broken values, which the cleaning drops; stop ids stay text.
_step("pings_broken", ["pings"], """
 SELECT * REPLACE (CASE WHEN distance_along_trip % 109 = 4 THEN replace(next_scheduled_stop_id, 'MTA', 'BUS')
   ELSE next_scheduled_stop_id END AS next_scheduled_stop_id)
 FROM pings WHERE NOT (distance_along_trip % 101 = 1 OR distance_along_trip % 103 = 2
  OR (distance_along_trip % 107 = 3 AND next_scheduled_stop_distance IS NOT NULL))""")

_CHAIN = ["pings", "clean", "dedup", "pairs", "classified", "crossings"]
for _before, _name in zip(_CHAIN, _CHAIN[1:], strict=False):
    _step(f"{_name}_broken", [f"{_before}_broken"], re.sub(rf"\bFROM {_before}\b", f"FROM {_before}_broken", STEPS[_name][1]))

_step("segments_broken", ["crossings_broken"], """
 SELECT vehicle_id, service_date, exit_id AS exit_stop_id, stop_id AS target_stop_id, distance, exit_us, arrive_us,
  CASE WHEN NOT regexp_matches(exit_id, 'MTA_\\d+$') THEN 'exit_stop_id'
   WHEN NOT regexp_matches(stop_id, 'MTA_\\d+$') THEN 'target_stop_id' END AS reason
"""+STEPS["segments"][1][STEPS["segments"][1].index(" FROM (\n  SELECT *, max(CASE"):].replace("FROM crossings", "FROM crossings_broken"))

_FIVE = ["day_of_week", "exit_time", "distance", "exit_stop", "target_stop"]


def _solve(n: int) -> list[tuple[str, str]]:
    """Gauss-Jordan elimination of an n x (n + 1) system in the columns a<row>_<column> of one row, step by step."""
    steps, source = [], "moments"
    for p in range(n):
        new = []
        for i in range(n):
            for j in range(n + 1):
                pivot = f"a{p}_{j} / a{p}_{p}"
                new.append(f"{pivot} AS a{i}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * {pivot} AS a{i}_{j}")
        steps.append((f"solved{p}", f"SELECT mean_y, {', '.join(f'mean_{i}' for i in range(n))}, {', '.join(new)} FROM {source}"))
        source = f"solved{p}"
    return steps


# Least squares of the label on five features: the normal equations of the centred columns, solved.
_TRAIN = "(SELECT * FROM ranked WHERE nth <= CAST(floor(n * 0.9::DOUBLE) AS BIGINT))"
_step("moments", ["ranked"], "SELECT avg(label) AS mean_y, " + ", ".join(
    [f"avg({c}) AS mean_{i}" for i, c in enumerate(_FIVE)]
    + [f"covar_pop({a}, {b}) AS a{i}_{j}" for i, a in enumerate(_FIVE) for j, b in enumerate([*_FIVE, "label"])]
) + f" FROM {_TRAIN}")
for _name, _sql in _solve(len(_FIVE)):
    _step(_name, ["moments" if _name == "solved0" else f"solved{int(_name[6:]) - 1}"], _sql)
_step("linear", ["ranked", f"solved{len(_FIVE) - 1}"], f"""
 SELECT ranked.*, mean_y + {" + ".join(f"a{i}_{len(_FIVE)} * ({c} - mean_{i})" for i, c in enumerate(_FIVE))} AS prediction
 FROM ranked, solved{len(_FIVE) - 1} WHERE nth > CAST(floor(n * 0.9::DOUBLE) AS BIGINT)""")


# Boosted trees of one cut each, over features of which every cut is tried: the first tree on the labels, each further one
# on twice what is left to explain and counted by the step. A cut lies between two neighbouring values of the training part.
CUT_FEATURES = ["day_of_week", "distance", "first_stop", "exit_stop", "target_stop"]
STUMPS = 5
_STEP = 0.1


def _stumps(name: str, ranked: str, fits: str) -> None:
    """Steps ``name``_0 to ``name``_<STUMPS>: the rows with their ``prediction`` after so many trees."""
    _step(f"{name}_0", [ranked], f"SELECT *, {fits} AS fits, 0::DOUBLE AS prediction FROM {ranked}")
    for i in range(STUMPS):
        before, cut = f"{name}_{i}", f"{name}_cut_{i}"
        rest = "2 * (label - prediction)" if i else "label"
        counted = " UNION ALL ".join(
            f"SELECT {f} AS feature, CAST({c} AS DOUBLE) AS value, count(*) AS n, sum(CAST({rest} AS DOUBLE)) AS total "
            f"FROM {before} WHERE fits GROUP BY 2"
            for f, c in enumerate(CUT_FEATURES)
        )
        _step(cut, [before], f"""
 SELECT feature, (value + following) / 2 AS cut, below / n_below AS lower_mean, above / n_above AS upper_mean FROM (
  SELECT feature, value, lead(value) OVER up AS following, sum(n) OVER up AS n_below, sum(total) OVER up AS below,
   sum(n) OVER whole - sum(n) OVER up AS n_above, sum(total) OVER whole - sum(total) OVER up AS above
  FROM ({counted}) WINDOW up AS (PARTITION BY feature ORDER BY value), whole AS (PARTITION BY feature))
 WHERE following IS NOT NULL
 ORDER BY below * below / n_below + above * above / n_above DESC, feature, value LIMIT 1""")
        value = "CASE feature " + " ".join(f"WHEN {f} THEN {c}" for f, c in enumerate(CUT_FEATURES)) + " END"
        grown = f"CASE WHEN {value} <= cut THEN lower_mean ELSE upper_mean END"
        _step(f"{name}_{i + 1}", [before, cut], f"""
 SELECT * EXCLUDE (feature, cut, lower_mean, upper_mean) REPLACE (prediction + {_STEP if i else 1.0}::DOUBLE * {grown} AS prediction)
 FROM {before}, {cut}""")


_step("ranked_with_speed", ["ranked"], """
 SELECT * REPLACE (ROW_NUMBER() OVER (ORDER BY nth) AS nth, count(*) OVER () AS n) FROM ranked WHERE total_speed IS NOT NULL""")

_stumps("stumps", "ranked", "nth <= CAST(floor(n * 0.9::DOUBLE) AS BIGINT)")
_stumps("three_way", "ranked", "nth <= n - CAST(ceil(n * 0.2::DOUBLE) AS BIGINT)")
_stumps("searched", "ranked_with_speed", "nth <= n - CAST(ceil(n * 0.1::DOUBLE) AS BIGINT)")


def after_each(name: str) -> str:
    """The rows of ``_stumps`` after every tree."""
    return " UNION ALL ".join(f"SELECT *, {i} AS iteration FROM {name}_{i}" for i in range(1, STUMPS + 1))


def _order_of(step: str, seen: list[str]) -> list[str]:
    for need in STEPS[step][0]:
        _order_of(need, seen)
    if step not in seen:
        seen.append(step)
    return seen


def sql(select: str, *needs: str) -> str:
    """``select`` over the named steps, with every step it needs in front."""
    steps: list[str] = []
    for need in needs:
        _order_of(need, steps)
    if not steps:
        return select
    ctes = [f"{s} AS ({STEPS[s][1]}\n)" if s == CLAIM else f"{s} AS MATERIALIZED ({STEPS[s][1]}\n)" for s in steps]
    return f"WITH RECURSIVE {',\n'.join(ctes)}\n{select}"
