"""An order that grows by sorted runs, without sorting what is stored again.

Every append sorts its own rows only and stores them as a run, with its rows counted by day. A position over all runs
is found in two steps: the counts, one row per run and day, say which day it lies in; that day's rows, read from all
runs, are sorted. The row found there cuts every run where it lies.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.splits import Boundary, in_order, total_order
from tripweave.operators.views import CHRONOLOGICAL
from tripweave.session import stage
from tripweave.sources.files import Folder


class OrderIndex:
    """Sorted runs of rows with a day, in the total order that begins with it."""

    def __init__(self, spark: SparkSession, path: str, order: list[str] = CHRONOLOGICAL):
        self.spark, self.folder, self.order, self.day = spark, Folder(spark, path), order, order[0]

    def _path(self, run: int, part: str) -> str:
        return f"{self.folder.path}/run-{run}/{part}"

    def runs(self) -> list[int]:
        """Complete runs: their counts are written last."""
        names = [n for n in self.folder.names(self.folder.path) if n.startswith("run-")]
        found = sorted(int(n.removeprefix("run-")) for n in names)
        return [r for r in found if self.folder.exists(f"{self._path(r, 'days')}/_SUCCESS")]

    def append(self, df: DataFrame) -> None:
        """Store rows as a run of their own: one range exchange of these rows."""
        run = 1 + max(self.runs(), default=0)
        full = total_order(df, self.order)
        rows = df.repartitionByRange(*full).sortWithinPartitions(*full)
        rows.write.mode("overwrite").parquet(self._path(run, "rows"))
        stored = self.spark.read.schema(df.schema).parquet(self._path(run, "rows"))
        counts = stored.groupBy(self.day).agg(F.count("*").alias("n"))
        counts.coalesce(1).write.mode("overwrite").parquet(self._path(run, "days"))

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(*[self._path(r, "rows") for r in self.runs()])

    def counts(self) -> list[tuple]:
        """(day, rows of all runs), in order: a null day comes first, as in the order of the rows."""
        days = self.spark.read.parquet(*[self._path(r, "days") for r in self.runs()])
        found = days.groupBy(self.day).agg(F.sum("n").alias("n")).orderBy(F.col(self.day).asc_nulls_first()).collect()
        return [(r[self.day], r["n"]) for r in found]

    def count(self) -> int:
        return sum(n for _, n in self.counts())

    def boundary(self, at: int) -> Boundary | None:
        """What tells the rows before a 0-based position from the others; none beyond the last row."""
        before = 0
        for day, n in self.counts():
            if at < before + n:
                held = self.rows().filter(F.col(self.day).eqNullSafe(F.lit(day)))
                return in_order(held, self.order).boundary(at - before)
            before += n
        return None

    def split(self, cuts: list[int]) -> list[DataFrame]:
        """The parts between ascending positions, each read from all runs."""
        rows, parts = self.rows(), []
        edges = [None, *[self.boundary(at) for at in cuts], None]
        for i, (first, last) in enumerate(pairwise(edges)):
            if first is None:
                part = rows.limit(0) if i else rows
            else:
                part = first.after(rows)
            if last is not None:
                part = last.before(part, first.copies if first is not None and first.row == last.row else 0)
            parts.append(part)
        return parts

    def merge(self) -> None:
        """Rewrite all runs as one, when there are many: the only time that stored rows are moved."""
        runs = self.runs()
        if len(runs) > 1:
            self.append(stage(self.rows(), "merged-runs"))
            for run in runs:
                self.folder.delete(f"{self.folder.path}/run-{run}")
