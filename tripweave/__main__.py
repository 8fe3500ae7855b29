"""The processing chain as jobs joined by Parquet folders.

    spark-submit -m tripweave <job> ...     (or python -m tripweave)

    daily     PINGS OUT          text pings (folder or glob) to linked segments, one folder per day; what
                                 can't be used goes to OUT-rejects, with the reason
    ingest    PINGS OUT LEDGER   the same for files that keep arriving: only the days that new, changed or
                                 vanished files touch are built again
    compact   DATA               many small Parquet files to few, in place
    trips     LINKED OUT         encoded, scaled segments with trip starts; the scale in OUT-bounds, segments
                                 without a place in a vehicle's order in OUT-rejects
    commute   TRIPS OUT          trips arriving in the commute window
    union     TRIPS OUT          short and long views of trips inside the window, without repeats
    table     COMMUTE OUT        metres, seconds and speeds: the model input
    fit       TABLE MODEL        fit linear or gbt, print its metrics on the held-out rows
    score     TABLE MODEL        metrics of a stored model
    best      TABLE MODEL        validation loss per boosting iteration, metrics of the best, which is stored
    scored    TABLE OUT          training features beside the label a boosted model predicts
    search    TABLE              hyper-parameter search
    preview   DATA               first rows
    profile   DATA               row count, nulls, ranges
    gaps      PINGS              days without pings
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators import scaling, views
from tripweave.operators.cleaning import type_pings
from tripweave.operators.metrics import evaluate
from tripweave.operators.splits import in_order, ordered_head
from tripweave.plans import daily, features, ingest, training
from tripweave.session import clear_staged
from tripweave.sources import datasets, profile
from tripweave.sources.compaction import compact_folder
from tripweave.sources.pings_tsv import file_headers, read_headerless, read_pings_tsv, read_unlike_tsv


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tripweave", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        return sub

    job("daily", "pings", "out").add_argument("--columns", help="column names of files without a header, comma-joined")
    job("ingest", "pings", "out", "ledger")
    job("compact", "data").add_argument("--target-mb", type=int, default=256, help="size of the files to make")
    job("trips", "linked", "out")
    job("commute", "trips", "out")
    job("union", "trips", "out")
    job("table", "commute", "out").add_argument("--bounds", help="stored scale; by default 100 to 41260 m")
    fit = job("fit", "table", "model")
    fit.add_argument("--kind", choices=sorted(training.REGRESSORS), default="linear")
    fit.add_argument("--train", type=float, default=0.9)
    fit.add_argument("--scaler", choices=["train", "all"], default="train")
    fit.add_argument("--features", choices=sorted(training.FEATURES))
    score = job("score", "table", "model")
    score.add_argument("--resplit", type=float, help="cut at this share instead of the model's own; may score training rows")
    best = job("best", "table", "model")
    best.add_argument("--features", choices=sorted(training.FEATURES), default="long")
    best.add_argument("--rounds", help="grow in rounds stored in this folder, and go on from those it holds")
    best.add_argument("--patience", type=int, help="with --rounds: stop when the least loss is so many trees old")
    job("scored", "table", "out")
    search = job("search", "table")
    search.add_argument("--random", type=int, default=40)
    search.add_argument("--guided", type=int, default=50)
    job("preview", "data").add_argument("-n", type=int, default=1000)
    job("profile", "data")
    gaps = job("gaps", "pings")
    gaps.add_argument("--from", dest="first", type=date.fromisoformat, help="first day; by default that of the data")
    gaps.add_argument("--to", dest="last", type=date.fromisoformat, help="last day; by default that of the data")
    for report in ("fit", "score", "best", "search", "profile", "gaps"):
        jobs.choices[report].add_argument("--report", help="write the reports to this folder, one below it for each")
        jobs.choices[report].add_argument("-n", type=int, default=100, help="rows to print of each report")
    return parser


def run(spark: SparkSession, a: argparse.Namespace) -> list[DataFrame]:
    """Do one job; what it returns is reported."""
    read = lambda path: datasets.read_dataset(spark, path)
    match a.job:
        case "daily":
            names = a.columns and a.columns.split(",")
            if names:
                raw, unread = read_headerless(spark, a.pings, names), None
            else:
                raw, unread = read_unlike_tsv(spark, file_headers(spark, a.pings))
            linked, rejects = daily.build(raw)
            datasets.write_linked(linked, a.out)
            if unread is not None:
                reason = F.concat_ws(",", "missing").alias("reason")
                rejects = rejects.unionByName(daily.as_records([("file", unread.select(reason, "path", "header"))]))
            datasets.write_dataset(rejects, f"{a.out}-rejects")
        case "ingest":
            return [ingest.ingest(spark, a.pings, a.out, a.ledger)]
        case "compact":
            return [compact_folder(spark, a.data, a.target_mb << 20)]
        case "trips":
            linked = read(a.linked)
            trips, bounds = features.started(linked)
            datasets.write_dataset(views.chronological(trips), a.out)
            datasets.write_dataset(features.rejects(linked), f"{a.out}-rejects")
            bounds.save(spark, f"{a.out}-bounds")
        case "commute":
            datasets.write_dataset(views.commute_by_arrival(read(a.trips)), a.out)
        case "union":
            datasets.write_dataset(views.short_long_union(views.commute_by_both(read(a.trips))), a.out)
        case "table":
            bounds = scaling.Bounds.load(spark, a.bounds) if a.bounds else scaling.DEFAULT_DISTANCE_BOUNDS
            datasets.write_dataset(views.chronological(features.model_rows(read(a.commute), bounds)), a.out)
        case "fit":
            rows = in_order(read(a.table))
            return [evaluate(training.fit_and_score(rows, a.kind, a.model, a.train, a.scaler, a.features))]
        case "score":
            return [evaluate(training.score_stored(read(a.table), a.model, a.resplit))]
        case "best":
            rows = in_order(read(a.table))
            return list(training.best_iteration(rows, a.features, a.model, a.rounds, a.patience)[:2])
        case "scored":
            datasets.write_dataset(training.scored_training_rows(in_order(read(a.table))), a.out)
        case "search":
            return [training.parameter_search(in_order(read(a.table)), a.random, a.guided)]
        case "preview":
            return [ordered_head(read(a.data), a.n)]
        case "profile":
            return [profile.column_types(read(a.data)), profile.profile(read(a.data))]
        case "gaps":
            return [profile.calendar_gaps(type_pings(read_pings_tsv(spark, a.pings)), "time_received", a.first, a.last)]
    return []


def main(argv: list[str] | None = None) -> None:
    a = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tripweave {a.job}").getOrCreate()
    for i, df in enumerate(run(spark, a)):
        if getattr(a, "report", None):
            datasets.write_dataset(df, f"{a.report}/{i}")
        n = getattr(a, "n", 100)
        df.show(n, truncate=False)
        if df.offset(n).limit(1).count():
            print(f"(more than {n} rows; -n prints more, --report writes all)")
    clear_staged(spark)


if __name__ == "__main__":
    main()
