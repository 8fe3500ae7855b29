"""Every operator as a query over the sample pings (or the order tables), with its SQL counterpart.

Queries start from the given tables. Stages that are read more than once are staged on the way, as in
the plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.operators import (
    boosting,
    cleaning,
    encoding,
    features,
    linking,
    metrics,
    modal,
    models,
    moments,
    order_index,
    scaling,
)
from tripweave.operators import segments as seg
from tripweave.operators import splits, trip_start, views
from tripweave.plans import daily, ingest, training
from tripweave.plans import features as build
from tripweave.plans.oracle import CLAIM, STUMPS, after_each, sql
from tripweave.plans.sample_pings import sample_pings
from tripweave.session import scratch_path, stage
from tripweave.sources import compaction, datasets, pings_tsv, profile

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# The queries with days and timestamps in their own types.
TYPED: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Days and timestamps as text, which every engine compares alike."""
    dated = (T.DateType, T.TimestampNTZType)
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, dated) else f.name for f in df.schema]
    )


def query(select: str | None = None, *needs: str) -> Callable[[Query], Query]:
    """Register a query under the function's name, with the SQL it must agree with, if there is one."""

    def register(fn: Query) -> Query:
        name = fn.__name__
        TYPED[name] = fn
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if select is not None:
            ORACLES[name] = sql(select, *needs)
        return fn

    return register


DAY = "CAST(service_date AS VARCHAR) AS service_date"
TEXT_DAY = f"SELECT * REPLACE ({DAY}) FROM"


# Stages the queries start from.


def _pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pings(spark, sf_dir)


def _broken_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample pings as text, with some values that do not parse; stored, as ping files are."""
    pings = sample_pings(spark, sf_dir)
    at = F.col("distance_along_trip")
    broken = {
        "vehicle_id": F.when(at % 101 == 1, F.concat(F.lit("V"), F.col("vehicle_id").cast("string"))),
        "time_received": F.when(at % 103 == 2, "noon"),
        "next_scheduled_stop_distance": F.when(at % 107 == 3, "near"),
        "next_scheduled_stop_id": F.when(at % 109 == 4, F.replace("next_scheduled_stop_id", F.lit("MTA"), F.lit("BUS"))),
    }
    text = {c: F.col(c).cast("string") for c in pings.columns}
    missing = F.col("next_scheduled_stop_distance").isNull()
    for c, value in broken.items():
        known = F.coalesce(value, text[c])
        text[c] = F.when(~missing, known) if c == "next_scheduled_stop_distance" else known
    return stage(pings.select(*[v.alias(c) for c, v in text.items()]), "pings-text")


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.segments(_pings(spark, sf_dir))


def _modal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(daily.modal_segments(_pings(spark, sf_dir)), "modal-segments")


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(daily.linked(_pings(spark, sf_dir)), "linked")


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.scaled(_linked(spark, sf_dir))[0]


def _started(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.started(_linked(spark, sf_dir))[0]


def _ordered(spark: SparkSession, sf_dir: str) -> splits.Ordered:
    return build.model_table(_linked(spark, sf_dir))


def _model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ordered(spark, sf_dir).table


# Sources and sinks.

PING_TEXT = "SELECT * REPLACE (CAST(time_received AS VARCHAR) AS time_received) FROM pings"


@query(PING_TEXT, "pings")
def tsv_scan(spark, sf_dir):
    path = scratch_path(spark, "pings-tsv")
    pings_tsv.write_pings_tsv(sample_pings(spark, sf_dir), path)
    return cleaning.type_pings(pings_tsv.read_pings_tsv(spark, f"{path}/*"))


@query(
    "SELECT CAST(time_received AS VARCHAR) AS _c2, CAST(vehicle_id AS VARCHAR) AS _c3, "
    "CAST(distance_along_trip AS VARCHAR) AS _c4, CAST(next_scheduled_stop_distance AS VARCHAR) AS _c9, "
    "next_scheduled_stop_id AS _c10 FROM pings",
    "pings",
)
def tsv_headerless(spark, sf_dir):
    path = scratch_path(spark, "pings-headerless")
    pings = sample_pings(spark, sf_dir)
    wide = pings.select(
        (F.col("distance_along_trip") / 1000).alias("latitude"),
        (F.col("distance_along_trip") / 2000).alias("longitude"),
        F.col("time_received").cast("string"),
        "vehicle_id",
        "distance_along_trip",
        (F.col("vehicle_id") % 2).alias("direction"),
        "inferred_phase",
        F.concat(F.lit("ROUTE_"), F.col("vehicle_id") % 5).alias("route"),
        F.concat(F.lit("TRIP_"), F.col("vehicle_id")).alias("trip"),
        "next_scheduled_stop_distance",
        "next_scheduled_stop_id",
    )
    wide.write.csv(path, sep="\t", header=False)
    return pings_tsv.read_headerless_tsv(spark, path)


def _unlike_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in the usual order of columns, in another one, with more columns, and without one that is needed."""
    path = scratch_path(spark, "pings-unlike")
    text = sample_pings(spark, sf_dir).withColumn("time_received", F.col("time_received").cast("string"))
    more = [F.lit("M1").alias("route"), *text.columns, (F.col("vehicle_id") % 2).alias("direction")]
    columns = [text.columns, text.columns[::-1], more, [c for c in text.columns if c != "next_scheduled_stop_id"]]
    for kind, names in enumerate(columns):
        rows = text.filter(F.col("vehicle_id") % 4 == kind)
        rows.select(*names).write.csv(f"{path}/kind-{kind}", sep="\t", header=True)
    return pings_tsv.file_headers(spark, path)


@query(f"{PING_TEXT} WHERE vehicle_id % 4 <> 3", "pings")
def tsv_unlike_headers(spark, sf_dir):
    return cleaning.type_pings(pings_tsv.read_unlike_tsv(spark, _unlike_files(spark, sf_dir))[0])


@query("SELECT DISTINCT 'next_scheduled_stop_id' AS missing, 'kind-3' AS folder FROM pings WHERE vehicle_id % 4 = 3", "pings")
def tsv_unread_files(spark, sf_dir):
    unread = pings_tsv.read_unlike_tsv(spark, _unlike_files(spark, sf_dir))[1]
    folder = F.regexp_extract("path", "(kind-[0-9])", 1)
    return unread.select(F.concat_ws(",", "missing").alias("missing"), folder.alias("folder")).distinct()


@query(f"{TEXT_DAY} linked", "linked")
def incremental_ingest(spark, sf_dir):
    """Files taken in by three runs, the last of which brings one for all earlier days; a fourth finds nothing."""
    source, out, ledger = (scratch_path(spark, n) for n in ("pings-in", "linked-grown", "ledger"))
    pings = stage(sample_pings(spark, sf_dir), "pings")
    late = F.col("vehicle_id") % 7 == 3
    first = F.to_date("time_received") <= F.lit("2014-08-02").cast("date")
    for step, part in enumerate((first & ~late, ~first & ~late, late)):
        text = pings.filter(part).withColumn("time_received", F.col("time_received").cast("string"))
        text.write.csv(f"{source}/step-{step}", sep="\t", header=True)
        ingest.ingest(spark, source, out, ledger)
    again = ingest.ingest(spark, source, out, ledger)
    if not again.isEmpty():
        raise AssertionError("a run without new files built days again")
    return datasets.read_dataset(spark, out)


@query(
    f"SELECT {DAY}, count(*) AS pings, count(DISTINCT vehicle_id) AS vehicles FROM "
    "(SELECT *, CAST(time_received AS DATE) AS service_date FROM pings) GROUP BY 1",
    "pings",
)
def multi_day(spark, sf_dir):
    path = scratch_path(spark, "pings-tsv")
    pings_tsv.write_pings_tsv(sample_pings(spark, sf_dir), path)
    pings = cleaning.type_pings(pings_tsv.read_pings_tsv(spark, f"{path}/*"))
    return pings.groupBy(F.to_date("time_received").alias("service_date")).agg(
        F.count("*").alias("pings"), F.count_distinct("vehicle_id").alias("vehicles")
    )


@query(f"SELECT * REPLACE ({DAY}) FROM modal", "modal")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "segments")
    rows = _modal(spark, sf_dir)
    datasets.write_dataset(rows.filter("distance > 300"), path)
    datasets.write_dataset(rows, path)  # replaces what was there
    return datasets.read_dataset(spark, path)


@query("SELECT * REPLACE (CAST(service_date AS VARCHAR) AS service_date), CAST(service_date AS VARCHAR) AS folder FROM linked", "linked")
def parquet_by_day(spark, sf_dir):
    """Written once, then one day again; with the folder each row lies in."""
    path = scratch_path(spark, "linked-by-day")
    linked = _linked(spark, sf_dir)
    datasets.write_linked(linked, path)
    datasets.write_linked(linked.filter("day_of_month = 1"), path)
    folder = F.regexp_extract("_metadata.file_path", "service_date=([^/]+)", 1)
    return datasets.read_dataset(spark, path).withColumn("folder", folder)


@query(
    f"SELECT {DAY}, count(*) AS pings, CAST(sum(distance_along_trip) AS BIGINT) AS metres, 1::BIGINT AS files, "
    "0::BIGINT AS rewritten_again FROM (SELECT *, CAST(time_received AS DATE) AS service_date FROM pings) GROUP BY 1",
    "pings",
)
def compact(spark, sf_dir):
    """Four files a day become one; a second run rewrites none."""
    path = scratch_path(spark, "pings-many")
    dated = sample_pings(spark, sf_dir).withColumn("service_date", F.to_date("time_received"))
    by_day = scratch_path(spark, "pings-by-day")
    dated.write.partitionBy("service_date").parquet(by_day)
    # A day at a time: the four tasks that write it pass its rows on, without sorting them by day.
    stored = spark.read.schema(dated.schema).parquet(by_day)
    for (day,) in stored.select("service_date").distinct().collect():
        rows = stored.filter(F.col("service_date").eqNullSafe(F.lit(day).cast("date"))).drop("service_date")
        to = f"{path}/service_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"
        rows.repartition(4, "vehicle_id").write.option("maxRecordsPerFile", 0).parquet(to)
    compaction.compact_folder(spark, path)
    again = compaction.compact_folder(spark, path)
    day = F.regexp_extract("folder", "service_date=([^/]+)", 1).cast("date")
    report = again.select(
        day.alias("service_date"), F.col("files_after").alias("files"), F.col("rewritten").alias("rewritten_again")
    )
    counted = datasets.read_dataset(spark, path).groupBy("service_date").agg(
        F.count("*").alias("pings"), F.sum("distance_along_trip").cast("bigint").alias("metres")
    )
    return counted.join(report, "service_date")


def _profile_sql(columns: list[str]) -> str:
    parts = ["count(*) AS row_count"]
    for c in columns:
        value = f"CAST({c} AS VARCHAR)" if c == "service_date" else c
        parts += [f"'{features.LINKED_SCHEMA[c].dataType.simpleString()}' AS {c}_type"]
        parts += [f"count(*) FILTER ({c} IS NULL) AS {c}_nulls", f"min({value}) AS {c}_min", f"max({value}) AS {c}_max"]
    return f"SELECT {', '.join(parts)} FROM linked"


@query(_profile_sql(features.LINKED_SCHEMA.fieldNames()), "linked")
def dataset_profile(spark, sf_dir):
    return profile.profile(daily.linked(_pings(spark, sf_dir)))


@query("SELECT count(*) AS row_count FROM model_input", "model_input")
def row_count(spark, sf_dir):
    return _model_table(spark, sf_dir).agg(F.count("*").alias("row_count"))


@query(
    "SELECT * REPLACE (CAST(time_received AS VARCHAR) AS time_received) FROM "
    "(SELECT * FROM pings ORDER BY time_received, vehicle_id LIMIT 1000)",
    "pings",
)
def dataset_preview(spark, sf_dir):
    return profile.preview(sample_pings(spark, sf_dir), ["time_received", "vehicle_id"], 1000)


@query(
    "SELECT CAST(day AS VARCHAR) AS day FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2014-08-01', "
    "TIMESTAMP '2014-10-31', INTERVAL 1 DAY)) AS DATE) AS day) "
    "WHERE day NOT IN (SELECT CAST(time_received AS DATE) FROM pings)",
    "pings",
)
def calendar_gaps(spark, sf_dir):
    pings = sample_pings(spark, sf_dir)
    return profile.calendar_gaps(pings, "time_received", profile.FIRST_DAY, profile.LAST_DAY)


@query(
    "SELECT CAST(day AS VARCHAR) AS day FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), "
    "INTERVAL 1 DAY)) AS DATE) AS day FROM orders) WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
)
def calendar_gaps_own_range(spark, sf_dir):
    return profile.calendar_gaps(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")


# Cleaning and segments.


@query(f"{TEXT_DAY} clean", "clean")
def ping_clean(spark, sf_dir):
    return cleaning.clean_pings(sample_pings(spark, sf_dir))


BROKEN = (
    "SELECT CASE WHEN distance_along_trip % 103 = 2 THEN 'noon' ELSE CAST(time_received AS VARCHAR) END AS time_received, "
    "CASE WHEN distance_along_trip % 101 = 1 THEN 'V' ELSE '' END || CAST(vehicle_id AS VARCHAR) AS vehicle_id, "
    "CAST(distance_along_trip AS VARCHAR) AS distance_along_trip, inferred_phase, "
    "CASE WHEN distance_along_trip % 107 = 3 THEN 'near' ELSE CAST(next_scheduled_stop_distance AS VARCHAR) END "
    "AS next_scheduled_stop_distance, CASE WHEN distance_along_trip % 109 = 4 "
    "THEN replace(next_scheduled_stop_id, 'MTA', 'BUS') ELSE next_scheduled_stop_id END AS next_scheduled_stop_id, "
    "CASE WHEN distance_along_trip % 101 = 1 THEN 'vehicle_id' WHEN distance_along_trip % 103 = 2 THEN 'time_received' "
    "WHEN distance_along_trip % 107 = 3 THEN 'next_scheduled_stop_distance' END AS reason "
    "FROM pings WHERE inferred_phase = 'IN_PROGRESS' AND next_scheduled_stop_distance IS NOT NULL"
)


@query(f"SELECT * FROM ({BROKEN}) WHERE reason IS NOT NULL", "pings")
def ping_rejects(spark, sf_dir):
    return cleaning.ping_rejects(_broken_text(spark, sf_dir))


@query(
    f"SELECT step, reason, count(*) AS records FROM (SELECT 'ping' AS step, reason FROM ({BROKEN}) WHERE reason IS NOT NULL "
    "UNION ALL SELECT 'segment', reason FROM segments_broken WHERE reason IS NOT NULL) GROUP BY ALL",
    "pings", "segments_broken",
)
def daily_rejects(spark, sf_dir):
    return daily.build(_broken_text(spark, sf_dir))[1].groupBy("step", "reason").agg(F.count("*").alias("records"))


@query(f"{TEXT_DAY} segments_broken WHERE reason IS NOT NULL", "segments_broken")
def segment_rejects(spark, sf_dir):
    pings = cleaning.type_pings(_broken_text(spark, sf_dir))
    return seg.segment_rejects(daily.crossings(pings))


@query(f"{TEXT_DAY} dedup", "dedup")
def ping_dedup(spark, sf_dir):
    return daily.deduped(_pings(spark, sf_dir))


@query(f"{TEXT_DAY} pairs", "pairs")
def ping_pairs(spark, sf_dir):
    return seg.ping_pairs(daily.deduped(_pings(spark, sf_dir)))


@query(f"{TEXT_DAY} classified", "classified")
def pair_classify(spark, sf_dir):
    return seg.classify_pairs(seg.ping_pairs(daily.deduped(_pings(spark, sf_dir))))


@query(f"{TEXT_DAY} crossings", "crossings")
def stop_crossings(spark, sf_dir):
    return daily.crossings(_pings(spark, sf_dir))


@query(f"{TEXT_DAY} segments", "segments")
def segments(spark, sf_dir):
    return _segments(spark, sf_dir)


# Modal distance.


@query(f"{TEXT_DAY} rounded", "rounded")
def distance_round(spark, sf_dir):
    return modal.round_distances(_segments(spark, sf_dir))


@query(f"{TEXT_DAY} modes", "modes")
def trip_mode(spark, sf_dir):
    return modal.trip_modes(modal.round_distances(_segments(spark, sf_dir)))


@query(f"{TEXT_DAY} modal", "modal")
def modal_distance_clean(spark, sf_dir):
    return daily.modal_segments(_pings(spark, sf_dir))


# Route linking.


@query(f"{TEXT_DAY} roots", "roots")
def route_roots(spark, sf_dir):
    return linking.route_roots(_modal(spark, sf_dir))


@query(f"{TEXT_DAY} modal m SEMI JOIN roots r ON r.vehicle_id = m.vehicle_id "
       "AND r.service_date = m.service_date AND r.stop = m.exit_stop", "modal", "roots")
def route_frontier(spark, sf_dir):
    edges = _modal(spark, sf_dir)
    return linking.frontier_segments(edges, linking.root_claims(edges)).select(*edges.columns)


@query(
    f"SELECT r.vehicle_id, CAST(r.service_date AS VARCHAR) AS service_date, exit_stop, target_stop, distance, "
    f"exit_us, arrive_us, r.first_stop, total_distance FROM routes r JOIN claim c ON c.vehicle_id = r.vehicle_id "
    f"AND c.service_date = r.service_date AND c.stop = r.exit_stop WHERE c.hop = 1",
    "routes", CLAIM,
)
def route_base_distance(spark, sf_dir):
    edges = _modal(spark, sf_dir)
    roots = stage(linking.root_claims(edges), "claims")
    first_hop = linking.frontier_segments(edges, roots)
    return linking.frontier_segments(edges, linking.next_claims(first_hop, roots))


@query(f"{TEXT_DAY} routes", "routes")
def route_link(spark, sf_dir):
    return linking.link_routes(daily.modal_segments(_pings(spark, sf_dir)))


@query(
    "SELECT vehicle_id, exit_stop, target_stop, distance, first_stop, total_distance FROM ("
    "SELECT *, min(exit_stop) OVER (PARTITION BY vehicle_id) AS first_stop, "
    "sum(distance) OVER (PARTITION BY vehicle_id ORDER BY exit_stop) AS total_distance FROM chain)",
    "chain",
)
def route_link_long(spark, sf_dir):
    """Chains of orders: every order leads to the next one of its block, far more than a hundred hops."""
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey").distinct()
    block = F.floor(F.col("o_orderkey") / 2000)
    chain = keys.select(
        block.alias("vehicle_id"),
        F.lit("2014-08-01").cast("date").alias("service_date"),
        F.col("o_orderkey").cast("bigint").alias("exit_stop"),
        F.lead("o_orderkey").over(Window.partitionBy(block).orderBy("o_orderkey")).cast("bigint").alias("target_stop"),
        (F.col("o_orderkey") % 7 * 10 + 100).cast("double").alias("distance"),
    )
    return linking.link_routes(chain.dropna()).drop("service_date")


# Features.


@query(
    f"SELECT * REPLACE ({DAY}), CAST(month(service_date) AS INTEGER) AS month, "
    "CAST(day(service_date) AS INTEGER) AS day_of_month, CAST(isodow(service_date) - 1 AS INTEGER) AS day_of_week "
    "FROM segments",
    "segments",
)
def calendar_features(spark, sf_dir):
    return features.calendar_features(_segments(spark, sf_dir))


@query(
    f"SELECT * REPLACE ({DAY}), (exit_us // 1000000) / 86400 AS exit_time, (arrive_us // 1000000) / 86400 AS arrive_time "
    "FROM segments",
    "segments",
)
def time_fraction(spark, sf_dir):
    return features.time_fractions(_segments(spark, sf_dir))


@query(
    "SELECT next_scheduled_stop_id, CAST(substr(next_scheduled_stop_id, 5) AS BIGINT) AS stop, count(*) AS pings "
    "FROM pings GROUP BY ALL",
    "pings",
)
def stop_id_parse(spark, sf_dir):
    per_id = sample_pings(spark, sf_dir).groupBy("next_scheduled_stop_id").agg(F.count("*").alias("pings"))
    return per_id.withColumn("stop", cleaning.parse_stop(F.col("next_scheduled_stop_id")))


@query(f"{TEXT_DAY} linked", "linked")
def linked_schema(spark, sf_dir):
    return daily.linked(_pings(spark, sf_dir))


# Encoding and scaling.


@query("SELECT id FROM stops", "stops")
def distinct_stops(spark, sf_dir):
    return encoding.all_stops(_linked(spark, sf_dir))


@query("SELECT * FROM stops", "stops")
def stop_dictionary(spark, sf_dir):
    return encoding.stop_dictionary(_linked(spark, sf_dir))


@query("SELECT * FROM vehicles", "vehicles")
def vehicle_dictionary(spark, sf_dir):
    return encoding.vehicle_dictionary(_linked(spark, sf_dir))


@query(
    "SELECT id, CAST(row_number() OVER (ORDER BY first_day, id) AS INTEGER) AS code, "
    "CAST(dense_rank() OVER (ORDER BY first_day) AS INTEGER) AS version FROM (SELECT id, min(service_date) AS first_day FROM "
    "(SELECT exit_stop AS id, service_date FROM linked UNION ALL SELECT target_stop, service_date FROM linked) GROUP BY id)",
    "linked",
)
def dictionary_growth(spark, sf_dir):
    """Stops numbered as their days arrive: codes once given stay, new stops follow."""
    linked = _linked(spark, sf_dir)
    dictionary = encoding.StableDictionary(spark, scratch_path(spark, "stop-codes"))
    for day in sorted(r["service_date"] for r in linked.select("service_date").distinct().collect()):
        codes = dictionary.merge(encoding.all_stops(linked.filter(F.col("service_date") == F.lit(day))))
    return codes


@query(f"{TEXT_DAY} encoded", "encoded")
def encode_ids(spark, sf_dir):
    return build.encoded(_linked(spark, sf_dir))


@query(
    "SELECT l.* REPLACE (CAST(l.service_date AS VARCHAR) AS service_date, v.code AS vehicle_id, f.code AS first_stop, "
    "e.code AS exit_stop, t.code AS target_stop) FROM linked l "
    "LEFT JOIN some_vehicles v ON v.id = l.vehicle_id LEFT JOIN some_stops f ON f.id = l.first_stop "
    "LEFT JOIN some_stops e ON e.id = l.exit_stop LEFT JOIN some_stops t ON t.id = l.target_stop "
    "WHERE v.code IS NULL OR f.code IS NULL OR e.code IS NULL OR t.code IS NULL",
    "some_vehicles", "some_stops", "linked",
)
def encode_rejects(spark, sf_dir):
    """Against dictionaries that lack every fourth vehicle."""
    linked = _linked(spark, sf_dir)
    known = linked.filter("vehicle_id % 4 <> 0")
    stops, vehicles = encoding.stop_dictionary(known), encoding.vehicle_dictionary(known)
    return encoding.encode_rejects(encoding.encode_ids(linked, stops, vehicles))


@query("SELECT * FROM bounds", "bounds")
def scale_bounds(spark, sf_dir):
    return scaling.scale_bounds(daily.linked(_pings(spark, sf_dir)))


@query(f"{TEXT_DAY} scaled", "scaled")
def minmax_scale(spark, sf_dir):
    return build.scaled(_linked(spark, sf_dir))[0]


# Trip starts.


@query(f"{TEXT_DAY} changes", "changes")
def trip_change(spark, sf_dir):
    return trip_start.trip_changes(_scaled(spark, sf_dir))


@query(f"{TEXT_DAY} filled", "filled")
def first_time_ffill(spark, sf_dir):
    return trip_start.fill_starts(_scaled(spark, sf_dir))


@query(f"{TEXT_DAY} started", "started")
def first_time(spark, sf_dir):
    return trip_start.trip_starts(_scaled(spark, sf_dir))


@query(f"{TEXT_DAY} started", "started")
def first_time_daily(spark, sf_dir):
    """Day by day from stored states; the second day arrives last."""
    rows, out, states = (scratch_path(spark, n) for n in ("scaled-days", "starts-days", "start-states"))
    scaled = _scaled(spark, sf_dir)
    days = sorted(r["service_date"] for r in scaled.select("service_date").distinct().collect())
    late = days[1:2]
    for part in [[d] for d in days if d not in late] + [late]:
        scaled.filter(F.col("service_date").isin(part)).write.mode("append").partitionBy("service_date").parquet(rows)
        ingest.extend_starts(spark, rows, out, states, part)
    return datasets.read_dataset(spark, out).select("first_time", *scaled.columns)


# Windows and views.


@query(f"{TEXT_DAY} commute", "commute")
def commute_arrival(spark, sf_dir):
    return views.commute_by_arrival(_started(spark, sf_dir))


@query(f"{TEXT_DAY} commute_both", "commute_both")
def commute_both(spark, sf_dir):
    return views.commute_by_both(_started(spark, sf_dir))


CALENDAR = ", ".join(features.CALENDAR)


@query(f"SELECT {CALENDAR}, exit_time, exit_stop, distance, target_stop, label FROM commute_both", "commute_both")
def short_view(spark, sf_dir):
    return views.short_view(views.commute_by_both(_started(spark, sf_dir)))


@query(
    f"SELECT {CALENDAR}, first_time AS exit_time, first_stop AS exit_stop, total_distance AS distance, target_stop, "
    "label FROM commute_both",
    "commute_both",
)
def long_view(spark, sf_dir):
    return views.long_view(views.commute_by_both(_started(spark, sf_dir)))


@query(
    "SELECT * EXCLUDE (service_date), ROW_NUMBER() OVER (ORDER BY service_date, exit_time, label, exit_stop, target_stop, "
    "distance, day_of_week) AS position FROM ("
    "SELECT service_date, day_of_week, exit_time, exit_stop, distance, target_stop, label FROM commute_both "
    "UNION SELECT service_date, day_of_week, first_time, first_stop, total_distance, target_stop, label FROM commute_both)",
    "commute_both",
)
def short_long_union(spark, sf_dir):
    both = views.both_views(stage(views.commute_by_both(_started(spark, sf_dir)), "commute"))
    return splits.in_order(both, ["service_date", *views.UNION_ORDER]).numbered("position").drop("service_date")


@query(
    f"SELECT * REPLACE ({DAY}), ROW_NUMBER() OVER (ORDER BY {', '.join(views.CHRONOLOGICAL)}, month, day_of_month, "
    "day_of_week) AS position FROM started",
    "started",
)
def global_sort(spark, sf_dir):
    return splits.in_order(_started(spark, sf_dir)).numbered("position")


@query(f"{TEXT_DAY} unscaled", "unscaled")
def unscale(spark, sf_dir):
    started, bounds = build.started(_linked(spark, sf_dir))
    return scaling.unscale(views.commute_by_arrival(started), bounds)


@query(f"{TEXT_DAY} unscaled_default", "unscaled_default")
def unscale_default(spark, sf_dir):
    return scaling.unscale(views.commute_by_arrival(_started(spark, sf_dir)))


@query(f"{TEXT_DAY} with_speeds", "with_speeds")
def speeds(spark, sf_dir):
    started, bounds = build.started(_linked(spark, sf_dir))
    return views.add_speeds(scaling.unscale(views.commute_by_arrival(started), bounds))


@query(f"{TEXT_DAY} model_input", "model_input")
def speed_filter(spark, sf_dir):
    return build.model_input(*build.started(_linked(spark, sf_dir)))


@query(f"SELECT {', '.join(views.SHORT_FEATURES)}, label FROM model_input", "model_input")
def short_features(spark, sf_dir):
    return views.feature_view(speed_filter(spark, sf_dir), views.SHORT_FEATURES)


@query(f"SELECT {', '.join(views.LONG_FEATURES)}, label FROM model_input", "model_input")
def long_features(spark, sf_dir):
    return views.feature_view(speed_filter(spark, sf_dir), views.LONG_FEATURES)


@query(f"SELECT {', '.join(views.TUNING_FEATURES)}, label FROM model_input", "model_input")
def tuning_features(spark, sf_dir):
    return views.feature_view(speed_filter(spark, sf_dir), views.TUNING_FEATURES)


# Splits and scalers.


def _split_sql(share: float) -> str:
    return (
        f"SELECT * EXCLUDE (nth, n) REPLACE ({DAY}), "
        f"CASE WHEN nth <= CAST(floor(n * {share}::DOUBLE) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM ranked"
    )


@query(_split_sql(0.9), "ranked")
def ordered_split_90_10(spark, sf_dir):
    rows = _ordered(spark, sf_dir)
    return rows.label(splits.holdout_cuts(rows.count, 0.9), ["train", "test"])


@query(_split_sql(0.8), "ranked")
def ordered_split_80_20(spark, sf_dir):
    rows = _ordered(spark, sf_dir)
    return rows.label(splits.holdout_cuts(rows.count, 0.8), ["train", "test"])


def _tail_sql(share: float) -> str:
    return (
        f"SELECT * EXCLUDE (nth, n) REPLACE ({DAY}), "
        f"CASE WHEN nth <= n - CAST(ceil(n * {share}::DOUBLE) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM ranked"
    )


@query(_tail_sql(0.1), "ranked")
def ordered_tail_10(spark, sf_dir):
    rows = _ordered(spark, sf_dir)
    return rows.label(splits.tail_cuts(rows.count, 0.1), ["train", "test"])


@query(_tail_sql(0.2), "ranked")
def ordered_tail_20(spark, sf_dir):
    rows = _ordered(spark, sf_dir)
    return rows.label(splits.tail_cuts(rows.count, 0.2), ["train", "test"])


HELD = "CAST(ceil(n * 0.2::DOUBLE) AS BIGINT)"


@query(
    f"SELECT * EXCLUDE (nth, n) REPLACE ({DAY}), CASE WHEN nth <= n - {HELD} THEN 'train' "
    f"WHEN nth <= n - CAST(ceil({HELD} * 0.5::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'final' END AS split FROM ranked",
    "ranked",
)
def ordered_split_80_10_10(spark, sf_dir):
    rows = _ordered(spark, sf_dir)
    return rows.label(splits.three_way_cuts(rows.count), ["train", "validation", "final"])


SHORT_ROW = ", ".join([*views.SHORT_FEATURES, "label"])


@query(
    f"SELECT {SHORT_ROW} FROM ranked EXCEPT SELECT {SHORT_ROW} FROM ranked "
    "WHERE nth <= CAST(floor(n * 0.9::DOUBLE) AS BIGINT)",
    "ranked",
)
def except_split(spark, sf_dir):
    return splits.except_split(_ordered(spark, sf_dir), [*views.SHORT_FEATURES, "label"])[1]


@query(f"SELECT * EXCLUDE (nth, n) REPLACE ({DAY}) FROM ranked WHERE nth <= 1000", "ranked")
def ordered_head(spark, sf_dir):
    return splits.ordered_head(_model_table(spark, sf_dir))


@query(
    f"SELECT * EXCLUDE (nth, n) REPLACE ({DAY}), CASE WHEN nth <= n - {HELD} THEN 'train' "
    f"WHEN nth <= n - CAST(ceil({HELD} * 0.5::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'final' END AS split FROM ranked",
    "ranked",
)
def order_index_split(spark, sf_dir):
    """The same parts from an order that grew by four runs, none of them later than the others. The runs are sorted as
    they are appended, so the rows come in no order."""
    rows = build.stored_input(_linked(spark, sf_dir))
    index = order_index.OrderIndex(spark, scratch_path(spark, "order-index"))
    for part in range(4):
        index.append(rows.filter(F.pmod(F.xxhash64("exit_time", "vehicle_id"), F.lit(4)) == part))
    return splits.label_parts(index.split(splits.three_way_cuts(index.count())), ["train", "validation", "final"])


MOMENT_COLUMNS = ["distance", "total_distance", "exit_time", "label", "speed", "total_speed"]


def _moments_sql(where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS deviation, "
        f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM model_input {where}"
        for c in MOMENT_COLUMNS
    )


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "moments")
    rows = _model_table(spark, sf_dir)
    for part in (F.dayofmonth("service_date") != 2, F.dayofmonth("service_date") == 2):
        moments.write_moments(moments.day_moments(rows.filter(part), MOMENT_COLUMNS), path)
    return datasets.read_dataset(spark, path)


def _shown(state: DataFrame) -> DataFrame:
    deviation = F.round(F.sqrt(F.col("m2") / F.col("n")), 6).alias("deviation")
    return state.select("feature", "n", F.round("mean", 6).alias("mean"), deviation, "low", "high")


@query(_moments_sql(""), "model_input")
def moments_merged(spark, sf_dir):
    return _shown(moments.merged(_moments(spark, sf_dir)))


@query(_moments_sql("WHERE service_date <> DATE '2014-08-01'"), "model_input")
def moments_without_a_day(spark, sf_dir):
    return _shown(moments.merged(_moments(spark, sf_dir).filter("service_date <> date'2014-08-01'")))


PROFILED = ["vehicle_id", "exit_stop", "distance", "exit_time"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, true AS distinct_close, true AS median_close "
        "FROM linked WHERE service_date >= DATE '2014-08-02'"
        for c in PROFILED
    ),
    "linked",
)
def profile_of_days(spark, sf_dir):
    """Of a range of days, from stored sketches; measured against the rows, within three standard errors."""
    path = scratch_path(spark, "profiles")
    linked = _linked(spark, sf_dir)
    profile.day_profiles(linked, PROFILED).write.partitionBy("service_date").parquet(path)
    later = "service_date >= date'2014-08-02'"
    found = profile.merged_profile(datasets.read_dataset(spark, path).filter(later))
    rows = linked.filter(later)
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in PROFILED]).first()
    flags = []
    for r in found.collect():
        c = r["column"]
        below, upto, n = rows.agg(F.count_if(F.col(c) < r["q50"]), F.count_if(F.col(c) <= r["q50"]), F.count(c)).first()
        slack = profile.RANK_ERROR * n + 1
        close = abs(r["distinct_about"] / exact[c] - 1) <= 3 * profile.DISTINCT_ERROR
        flags.append((c, close, below - slack <= n / 2 <= upto + slack))
    measured = spark.createDataFrame(flags, "column string, distinct_close boolean, median_close boolean")
    return found.join(measured, "column").select(
        "column", "row_count", "nulls", "low", "high", "distinct_close", "median_close"
    )


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _per_feature_sql(expression: str, columns: list[str], measures: str) -> str:
    scaled = ", ".join(f"round({expression.format(c=c)}, 6) AS {c}" for c in columns)
    fitted = ", ".join(measures.format(c=c) for c in columns)
    return f"SELECT {scaled}, label FROM model_input, (SELECT {fitted} FROM model_input)"


@query(
    _per_feature_sql("model_input.{c} / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", views.SHORT_FEATURES,
                     "stddev_samp({c}) AS s_{c}"),
    "model_input",
)
def unit_scale(spark, sf_dir):
    table = views.feature_view(_model_table(spark, sf_dir), views.SHORT_FEATURES)
    return _rounded(models.unit_scale(table, views.SHORT_FEATURES), views.SHORT_FEATURES)


Z_FIT = "avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}"


@query(_per_feature_sql("(model_input.{c} - m_{c}) / s_{c}", views.LONG_FEATURES, Z_FIT), "model_input")
def zscore(spark, sf_dir):
    table = views.feature_view(_model_table(spark, sf_dir), views.LONG_FEATURES)
    return _rounded(scaling.ZScore.fit(table, views.LONG_FEATURES).transform(table), views.LONG_FEATURES)


@query(_per_feature_sql("CAST(model_input.{c} AS DOUBLE)", views.LONG_FEATURES, Z_FIT), "model_input")
def zscore_inverse(spark, sf_dir):
    table = views.feature_view(_model_table(spark, sf_dir), views.LONG_FEATURES)
    path = scratch_path(spark, "scaler")
    scaling.ZScore.fit(table, views.LONG_FEATURES).save(spark, path)
    stored = scaling.ZScore.load(spark, path)
    return _rounded(stored.inverse(stored.transform(table)), views.LONG_FEATURES)


# Metrics, on a baseline that drives every segment at the training part's mean pace.


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = splits.holdout_split(_ordered(spark, sf_dir))
    metres, seconds = train.agg(F.sum("distance"), F.sum(F.col("label") - F.col("exit_time"))).first()
    return test.select("label", (F.col("exit_time") + F.col("distance") / F.lit(metres / seconds)).alias("prediction"))


@query(
    "SELECT label, round(prediction, 6) AS prediction, round(abs(label - prediction), 6) AS abs_diff FROM baseline",
    "baseline",
)
def absolute_error(spark, sf_dir):
    return _rounded(metrics.with_abs_error(_baseline(spark, sf_dir)), ["prediction", "abs_diff"])


def _within_sql(s: int) -> str:
    return f"round(100 * avg(CASE WHEN abs(label - prediction) <= {s} THEN 1.0::DOUBLE ELSE 0 END), 6)"


RMSE_SQL = "round(sqrt(avg(pow(label - prediction, 2))), 6)"
R2_SQL = "round(1 - avg(pow(label - prediction, 2)) / var_pop(label), 6)"


@query(f"SELECT {', '.join(f'{_within_sql(s)} AS within_{s}' for s in metrics.THRESHOLDS)} FROM baseline", "baseline")
def within_threshold(spark, sf_dir):
    found = metrics.within_thresholds(_baseline(spark, sf_dir))
    return _rounded(found, found.columns)


@query(f"SELECT {RMSE_SQL} AS rmse FROM baseline", "baseline")
def rmse(spark, sf_dir):
    return _baseline(spark, sf_dir).agg(F.round(metrics.rmse(), 6).alias("rmse"))


@query(f"SELECT {R2_SQL} AS r2 FROM baseline", "baseline")
def r2(spark, sf_dir):
    return _baseline(spark, sf_dir).agg(F.round(metrics.r2(), 6).alias("r2"))


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {value} AS value FROM baseline"
        for name, value in {
            **{f"within_{s}": _within_sql(s) for s in metrics.THRESHOLDS},
            "rmse": RMSE_SQL,
            "r2": R2_SQL,
            "rows": "CAST(count(*) AS DOUBLE)",
        }.items()
    ),
    "baseline",
)
def baseline_eval(spark, sf_dir):
    return _rounded(metrics.evaluate(_baseline(spark, sf_dir)), ["value"])


# Fitted models. Least squares has one answer, which SQL finds too. Boosted trees are checked for what must hold of
# any: the rows, the errors that belong to the predictions, the flags that belong to the numbers, a stored model that
# predicts the same, and training errors below those of the mean.


def _predictions(rows: splits.Ordered, kind: str) -> DataFrame:
    return training.fit_and_score(rows, kind, scratch_path(rows.rows.sparkSession, f"{kind}-model"))


@query(
    f"SELECT * EXCLUDE (nth, n, prediction) REPLACE ({DAY}), round(prediction, 3) AS prediction, "
    "round(abs(label - prediction), 3) AS abs_diff FROM linear",
    "linear",
)
def linear_fit_score(spark, sf_dir):
    scored = _predictions(_ordered(spark, sf_dir), "linear")
    return scored.withColumns({c: F.round(c, 3) for c in ("prediction", "abs_diff")})


def _rounded_metrics(source: str) -> str:
    measures = {f"within_{s}": _within_sql(s) for s in metrics.THRESHOLDS} | {
        "rmse": RMSE_SQL, "r2": R2_SQL, "rows": "CAST(count(*) AS DOUBLE)"}
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, round({v}, 4) AS value FROM {source}" for m, v in measures.items())


@query(_rounded_metrics("linear"), "linear")
def model_eval(spark, sf_dir):
    found = metrics.evaluate(_predictions(_ordered(spark, sf_dir), "linear"))
    return found.withColumn("value", F.round("value", 4))


def _beats_mean(scored: DataFrame) -> bool:
    """Whether predictions err less than the mean of the labels would."""
    return scored.agg(metrics.r2()).first()[0] > 0


@query(
    f"SELECT * EXCLUDE (nth, n) REPLACE ({DAY}), true AS error_holds, true AS stored_holds, true AS beats_mean FROM ranked "
    "WHERE nth > CAST(floor(n * 0.9::DOUBLE) AS BIGINT)",
    "ranked",
)
def gbt_fit_score(spark, sf_dir):
    rows = _ordered(spark, sf_dir)
    path = scratch_path(spark, "gbt-model")
    scored = stage(training.fit_and_score(rows, "gbt", path), "scored")
    again = models.score(models.load_model(path), scored.drop("abs_diff").withColumnRenamed("prediction", "first"))
    return again.withColumns(
        {
            "error_holds": F.abs(F.col("label") - F.col("prediction")) == F.col("abs_diff"),
            "stored_holds": F.col("prediction") == F.col("first"),
            # On the training rows: the held-out ones end later than any of them, and trees don't extrapolate.
            "beats_mean": F.lit(_beats_mean(models.score(models.load_model(path), splits.holdout_split(rows)[0]))),
        }
    ).drop("first", "prediction", "abs_diff")


# Trees of one cut each, tried at every value of features that have few: SQL finds the same ones, so that predictions,
# losses and targets are compared as numbers.
EVERY_CUT = {"maxDepth": 1, "maxBins": 2048}
CUT_ROW = ", ".join(views.STOP_FEATURES)


@query(
    f"SELECT * EXCLUDE (nth, n, fits, prediction) REPLACE ({DAY}), round(prediction, 3) AS prediction, "
    f"round(abs(label - prediction), 3) AS abs_diff FROM stumps_{STUMPS} WHERE NOT fits",
    f"stumps_{STUMPS}",
)
def gbt_cuts_score(spark, sf_dir):
    """Fitted, stored, loaded and applied to the held-out rows."""
    path = scratch_path(spark, "gbt-cuts")
    scored = training.fit_and_score(_ordered(spark, sf_dir), "gbt", path, features="stops", maxIter=STUMPS, **EVERY_CUT)
    return scored.withColumns({c: F.round(c, 3) for c in ("prediction", "abs_diff")})


VALIDATION = f"nth > n - {HELD} AND nth <= n - CAST(ceil({HELD} * 0.5::DOUBLE) AS BIGINT)"
CURVE = f"(SELECT iteration, avg(pow(label - prediction, 2)) AS mse FROM ({after_each('three_way')}) WHERE {VALIDATION} GROUP BY 1)"


@query(
    "SELECT iteration, round(mse, 2) AS validation_mse, "
    f"iteration = (SELECT arg_min(iteration, mse) FROM {CURVE}) AS is_best FROM {CURVE}",
    f"three_way_{STUMPS}",
)
def best_iteration_curve(spark, sf_dir):
    curve = training.best_iteration(_ordered(spark, sf_dir), "stops", maxIter=STUMPS, **EVERY_CUT)[0]
    return curve.withColumn("validation_mse", F.round("validation_mse", 2))


def _kept_metrics() -> str:
    kept = (
        f"(SELECT *, CASE WHEN {VALIDATION} THEN 'validation' ELSE 'final' END AS split FROM ({after_each('three_way')}) "
        f"WHERE NOT fits AND iteration = (SELECT arg_min(iteration, mse) FROM {CURVE}))"
    )
    measures = {f"within_{s}": _within_sql(s) for s in metrics.THRESHOLDS} | {
        "rmse": RMSE_SQL, "r2": R2_SQL, "rows": "CAST(count(*) AS DOUBLE)"}
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round({v}, 4) AS value, split FROM {kept} GROUP BY split" for m, v in measures.items()
    )


@query(_kept_metrics(), f"three_way_{STUMPS}")
def best_iteration_metrics(spark, sf_dir):
    """Of the kept trees, on the validation and the final part."""
    report = training.best_iteration(_ordered(spark, sf_dir), "stops", maxIter=STUMPS, **EVERY_CUT)[1]
    return report.withColumn("value", F.round("value", 4))


@query(
    f"SELECT {CUT_ROW}, round(prediction, 3) AS predicted_label FROM three_way_{STUMPS} WHERE fits",
    f"three_way_{STUMPS}",
)
def scored_features_cuts(spark, sf_dir):
    scored = training.scored_training_rows(_ordered(spark, sf_dir), "stops", maxIter=STUMPS, **EVERY_CUT)
    return scored.withColumn("predicted_label", F.round("predicted_label", 3))


TARGETS = (
    f"(SELECT iteration, -sqrt(avg(pow(label - prediction, 2))) AS target FROM ({after_each('searched')}) "
    "WHERE NOT fits GROUP BY 1)"
)


@query(
    f"SELECT iteration AS trees, round(target, 4) AS target, target = (SELECT max(target) FROM {TARGETS}) AS is_best FROM {TARGETS}",
    f"searched_{STUMPS}",
)
def param_search_targets(spark, sf_dir):
    """A search for the number of trees: what its trials on all rows found, and which one it takes."""
    bounds = {"maxIter": (1, STUMPS)} | {name: (value, value) for name, value in EVERY_CUT.items()}
    found = training.parameter_search(_ordered(spark, sf_dir), 10, 10, views.STOP_FEATURES, bounds)
    tried = found.filter("share = 1").groupBy(F.col("maxIter").alias("trees"), F.round("target", 4).alias("target"))
    return tried.agg(F.bool_or("is_best").alias("is_best"))


ITERATIONS = 20


@query(
    f"SELECT CAST(i AS INTEGER) AS iteration, true AS same_loss, true AS loss_holds FROM range(1, {ITERATIONS + 1}) AS r(i)",
)
def boosting_rounds(spark, sf_dir):
    """Trees grown in stored rounds: a run stopped after two rounds and resumed against one that was not stopped, and the
    losses against those of the stored trees put together."""
    train, validation, _ = splits.three_way_split(_ordered(spark, sf_dir))
    train, validation = models.scale_parts([train, validation], views.LONG_FEATURES)
    whole, cut = (scratch_path(spark, n) for n in ("boosted-whole", "boosted-cut"))
    want = boosting.boost(train, validation, whole, ITERATIONS)
    boosting.boost(train, validation, cut, ITERATIONS, most_rounds=2)
    got = boosting.boost(train, validation, cut, ITERATIONS)
    trees = boosting.Rounds(spark, cut).trees(ITERATIONS)
    weights = [boosting.weight_of(i, 0.1) for i in range(ITERATIONS)]
    again = boosting.loss_after(models.trees_as_model(spark, trees, weights), validation)
    rows = [
        (i, abs(a / b - 1) < 1e-9, abs(a / c - 1) < 1e-9)
        for i, (a, b, c) in enumerate(zip(got.losses, want.losses, again, strict=True), 1)
    ]
    return spark.createDataFrame(rows, "iteration int, same_loss boolean, loss_holds boolean")


@query(
    f"SELECT CAST(i AS INTEGER) AS iteration, true AS flag_holds FROM range(1, {ITERATIONS + 1}) AS r(i)",
)
def best_iteration(spark, sf_dir):
    curve = training.best_iteration(_ordered(spark, sf_dir))[0]
    least = curve.agg(F.min("validation_mse")).first()[0]
    first = curve.filter(F.col("validation_mse") == least).agg(F.min("iteration")).first()[0]
    return curve.select("iteration", (F.col("is_best") == (F.col("iteration") == first)).alias("flag_holds"))


@query(
    "SELECT split, CAST(count(*) AS DOUBLE) AS rows, true AS kept_holds FROM "
    f"(SELECT CASE WHEN nth <= n - CAST(ceil({HELD} * 0.5::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'final' END AS split "
    f"FROM ranked WHERE nth > n - {HELD}) GROUP BY 1",
    "ranked",
)
def best_iteration_eval(spark, sf_dir):
    """Also that the kept and stored model reaches the least loss of the curve on the validation part."""
    path = scratch_path(spark, "best-model")
    rows = _ordered(spark, sf_dir)
    curve, report, best = training.best_iteration(rows, path=path)
    validation = splits.three_way_split(rows)[1]
    loss = models.score(models.load_model(path), validation).agg(F.avg(metrics.squared_error())).first()[0]
    holds = abs(loss / min(best.losses) - 1) < 1e-9
    counted = report.filter("metric = 'rows'")
    return counted.select("split", F.col("value").alias("rows"), F.lit(holds).alias("kept_holds"))


@query(
    "SELECT CAST(i AS INTEGER) AS trial, CASE WHEN i <= 40 THEN 'random' ELSE 'guided' END AS phase, true AS in_bounds, "
    "true AS flag_holds, (SELECT count(*) FROM model_input WHERE total_speed IS NULL) AS rows_dropped "
    "FROM range(1, 91) AS r(i)",
    "model_input",
)
def param_search(spark, sf_dir):
    found = training.parameter_search(_ordered(spark, sf_dir))
    whole = found.filter("share = 1")
    best = whole.agg(F.max_by("trial", F.struct("target", -F.col("trial")))).first()[0]
    inside = F.lit(True)
    for name, (low, high) in models.SEARCH_BOUNDS.items():
        inside = inside & F.col(name).between(low, high)
    return found.select(
        "trial",
        "phase",
        inside.alias("in_bounds"),
        (F.col("is_best") == (F.col("trial") == best)).alias("flag_holds"),
        F.col("rows_dropped").cast("bigint").alias("rows_dropped"),
    )


@query(
    f"SELECT {', '.join(views.LONG_FEATURES)}, true AS predicted FROM ranked WHERE nth <= n - {HELD}",
    "ranked",
)
def scored_features(spark, sf_dir):
    scored = training.scored_training_rows(_ordered(spark, sf_dir))
    return scored.withColumn("predicted", F.col("predicted_label").between(0, 86400)).drop("predicted_label")
