"""Days that keep arriving: a ledger of ping files, and the stages that go on from what they have stored.

``ingest`` compares the files that are there with the ledger of those taken in (path, length, time of change, the days
they hold). New and changed files, and files that are gone, touch days; the touched days are built again from all files
that hold them, and replaced. The next ledger is stored last, so a run that was cut off is simply done again.

``extend_starts`` computes trip starts day by day from stored states. A day that arrives late is computed from the state
before it, and so are the days after it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.columns import parse_time
from tripweave.operators.cleaning import ping_rejects
from tripweave.operators.trip_start import later_starts
from tripweave.plans import daily
from tripweave.session import stage
from tripweave.sources.datasets import read_dataset, write_dataset, write_linked
from tripweave.sources.files import Folder, listed
from tripweave.sources.pings_tsv import first_lines, read_unlike_tsv

FILE = ["path", "length", "modified"]
ENTRIES = "path string, length long, modified timestamp, uri string, header string, days array<date>"


class Ledger:
    """The files taken in so far: one stored table per run, of which the last complete one counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def _path(self, version: int) -> str:
        return f"{self.folder.path}/run={version}"

    def version(self) -> int:
        runs = [int(n.removeprefix("run=")) for n in self.folder.names(self.folder.path) if n.startswith("run=")]
        return max((r for r in runs if self.folder.exists(f"{self._path(r)}/_SUCCESS")), default=0)

    def entries(self) -> DataFrame:
        version = self.version()
        if not version:
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).parquet(self._path(version))

    def store(self, entries: DataFrame) -> None:
        """The next ledger; the one before stays, older ones go."""
        version = self.version() + 1
        entries.select("path", "length", "modified", "uri", "header", "days").write.mode("overwrite").parquet(
            self._path(version)
        )
        self.folder.delete(self._path(version - 2))


def days_of_files(raw: DataFrame) -> DataFrame:
    """The days each file holds, of text pings with their ``uri``."""
    day = F.to_date(parse_time(F.col("time_received")))
    return raw.select("uri", day.alias("day")).distinct().groupBy("uri").agg(F.collect_set("day").alias("days"))


def ingest(spark: SparkSession, source: str | list[str], out: str, ledger_path: str) -> DataFrame:
    """Bring the linked segments at ``out`` up to date with the files at ``source``; the days that were built again.

    What can't be used goes to a folder of this run below ``out``-rejects: files, and pings and segments of the files
    and days worked on.
    """
    ledger = Ledger(spark, ledger_path)
    known = ledger.entries()
    now = stage(listed(spark, source).filter(F.col("length") > 0), "files")
    new = now.join(known, FILE, "left_anti")
    # The headers of known files are in the ledger: only new files are read.
    headers = first_lines(spark, [r["path"] for r in new.select("path").collect()])
    new = stage(new.join(headers, "uri", "left"), "new-files")
    gone = known.join(now, FILE, "left_anti")
    raw, unread = read_unlike_tsv(spark, new, uri=True)
    held = stage(new.join(days_of_files(raw), "uri", "left"), "new-entries")
    entries = stage(known.join(now, FILE, "left_semi").unionByName(held, allowMissingColumns=True).select(*known.columns), "ledger")
    touched = held.select("days").unionByName(gone.select("days")).select(F.explode("days").alias("day")).distinct()
    days = sorted(r["day"] for r in touched.collect())
    rejects = f"{out}-rejects/run={ledger.version() + 1}"
    found = [("file", unread.select(F.concat_ws(",", "missing").alias("reason"), "path", "header"))]
    found.append(("ping", ping_rejects(raw.drop("uri"))))
    if days:
        wanted = F.array(*[F.lit(d) for d in days])
        mine = entries.filter(F.arrays_overlap("days", wanted))
        pings = read_unlike_tsv(spark, mine)[0].filter(F.to_date(parse_time(F.col("time_received"))).isin(days))
        linked, unused = daily.build(pings)
        linked = stage(linked, "linked")
        write_linked(linked, out)
        _drop_days(spark, out, set(days) - {r[0] for r in linked.select("service_date").distinct().collect()})
        unused = unused.filter("step = 'segment'")
        write_dataset(daily.as_records(found).unionByName(unused), rejects)
    else:
        write_dataset(daily.as_records(found), rejects)
    ledger.store(entries)
    return spark.createDataFrame([(d,) for d in days], "service_date date")


def _drop_days(spark: SparkSession, path: str, days: set[date]) -> None:
    folder = Folder(spark, path)
    for day in days:
        folder.delete(f"{path.rstrip('/')}/service_date={day}")


class States:
    """Stored states, one per day, of a rule that goes over days."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def _path(self, day: date) -> str:
        return f"{self.folder.path}/as-of={day}"

    def days(self) -> list[date]:
        names = [n for n in self.folder.names(self.folder.path) if n.startswith("as-of=")]
        done = [n for n in names if self.folder.exists(f"{self.folder.path}/{n}/_SUCCESS")]
        return sorted(date.fromisoformat(n.removeprefix("as-of=")) for n in done)

    def before(self, day: date) -> DataFrame | None:
        earlier = [d for d in self.days() if d < day]
        return read_dataset(self.spark, self._path(earlier[-1])) if earlier else None

    def store(self, state: DataFrame, day: date) -> None:
        write_dataset(state, self._path(day))

    def forget(self, day: date) -> None:
        """Drop the states from a day on: they no longer hold."""
        for later in [d for d in self.days() if d >= day]:
            self.folder.delete(self._path(later))


def extend_starts(spark: SparkSession, rows_path: str, out: str, states_path: str, days: list[date]) -> list[date]:
    """Trip starts of days that are new or have changed, and of the days after them; the days that were computed.

    Rows and results lie in one folder per day. Every day reads its own rows and the state before it.
    """
    states = States(spark, states_path)
    if not days:
        return []
    names = Folder(spark, rows_path).names(rows_path)
    stored = sorted(date.fromisoformat(n.removeprefix("service_date=")) for n in names if n.startswith("service_date="))
    again = [d for d in stored if d >= min(days)]
    states.forget(min(days))
    for day in again:
        rows = read_dataset(spark, rows_path).filter(F.col("service_date") == F.lit(day))
        starts, state = later_starts(rows, states.before(day))
        (
            starts.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("service_date")
            .parquet(out)
        )
        states.store(state, day)
    return again
