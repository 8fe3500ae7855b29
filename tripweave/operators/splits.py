"""Ordered holdout splits.

The rows are stored once in their order, with a place that ascends in it. A cut is then one place, found
from the number of rows in each stored partition; the parts are comparisons with it, which skip the files
of other parts, and any number of parts is labelled in one scan.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.operators.ordinal import place_of, placed, position
from tripweave.operators.views import CHRONOLOGICAL

PLACE = "_place"


def holdout_cuts(n: int, train: float) -> list[int]:
    """End of the training part, rounded down."""
    return [int(n * train)]


def tail_cuts(n: int, held_out: float) -> list[int]:
    """End of the training part where the held-out part is rounded up."""
    return [n - math.ceil(n * held_out)]


def three_way_cuts(n: int, held_out: float = 0.2, final: float = 0.5) -> list[int]:
    """Ends of the training and validation parts; held-out parts are rounded up."""
    held = math.ceil(n * held_out)
    return [n - held, n - math.ceil(held * final)]


def total_order(df: DataFrame, order: list[str]) -> list[str]:
    """``order`` extended by the other columns, so that only identical rows tie."""
    leading = [c for c in order if c in df.columns]
    return leading + [c for c in df.columns if c not in leading]


@dataclass(frozen=True)
class Ordered:
    """Rows stored in an order, with their places, and the rows of each stored partition."""

    rows: DataFrame
    parts: list[tuple[int, int, int]]
    order: list[str]

    @cached_property
    def table(self) -> DataFrame:
        return self.rows.drop(PLACE)

    @cached_property
    def count(self) -> int:
        return sum(n for _, _, n in self.parts)

    def _cut(self, at: int) -> Column:
        return F.lit(place_of(at, self.parts))

    def between(self, first: int, last: int) -> DataFrame:
        """The rows from a 0-based position up to, but without, another."""
        place = F.col(PLACE)
        return self.rows.filter((place >= self._cut(first)) & (place < self._cut(last))).drop(PLACE)

    def split(self, cuts: list[int]) -> list[DataFrame]:
        """The parts between ascending positions."""
        edges = [0, *cuts, self.count]
        return [self.between(a, b) for a, b in zip(edges, edges[1:], strict=False)]

    def label(self, cuts: list[int], names: list[str]) -> DataFrame:
        """All rows with the name of their part, in one scan."""
        split = F.lit(names[-1])
        for cut, name in reversed(list(zip(cuts, names, strict=False))):
            split = F.when(F.col(PLACE) < self._cut(cut), name).otherwise(split)
        return self.rows.withColumn("split", split).drop(PLACE)

    def numbered(self, name: str) -> DataFrame:
        """All rows with their position, counted from 1."""
        return self.rows.withColumn(name, position(PLACE, self.parts) + 1).drop(PLACE)

    def boundary(self, at: int) -> Boundary | None:
        """What tells the rows before a position from the others in any table that holds the same rows."""
        found = self.rows.filter(F.col(PLACE) == self._cut(at)).drop(PLACE).first()
        if found is None:
            return None
        same = self.between(0, at).filter(_key(self.order) == _pivot(self.table, found, self.order))
        return Boundary(found, same.count(), self.order)


def in_order(df: DataFrame, order: list[str] = CHRONOLOGICAL) -> Ordered:
    """Store ``df`` in its total order: one range exchange; each task sorts a range."""
    full = total_order(df, order)
    rows, parts = placed(df, full, PLACE, "in-order")
    return Ordered(rows, parts, full)


def _key(order: list[str]) -> Column:
    return F.struct(*order)


def _pivot(df: DataFrame, row: Row, order: list[str]) -> Column:
    return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in order])


@dataclass(frozen=True)
class Boundary:
    """The first row after a cut, and how many rows identical to it lie before."""

    row: Row
    copies: int
    order: list[str]

    def _leading(self, df: DataFrame) -> tuple[Column, Column, Column]:
        """What must hold of the leading column before, at and after the cut. It follows from comparing whole keys; said of
        one column, scans of files sorted by it skip those of other parts."""
        first = self.order[0]
        column, value = F.col(first), F.lit(self.row[first]).cast(df.schema[first].dataType)
        if self.row[first] is None:  # nulls come first
            return column.isNull(), column.isNull(), F.lit(True)
        return column.isNull() | (column <= value), column == value, column >= value

    def after(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` after the cut."""
        key, pivot = _key(self.order), _pivot(df, self.row, self.order)
        _, at, behind = self._leading(df)
        later = df.filter(behind & (key > pivot))
        nth = F.row_number().over(Window.partitionBy(*self.order).orderBy(F.lit(1)))
        same = df.filter(at & (key == pivot)).withColumn("_copy", nth).filter(F.col("_copy") > self.copies)
        return later.unionByName(same.drop("_copy"))

    def before(self, df: DataFrame, gone: int = 0) -> DataFrame:
        """The rows of ``df`` before the cut, of whose identical rows ``gone`` are no longer in ``df``."""
        key, pivot = _key(self.order), _pivot(df, self.row, self.order)
        ahead, at, _ = self._leading(df)
        nth = F.row_number().over(Window.partitionBy(*self.order).orderBy(F.lit(1)))
        same = df.filter(at & (key == pivot)).withColumn("_copy", nth).filter(F.col("_copy") <= self.copies - gone)
        return df.filter(ahead & (key < pivot)).unionByName(same.drop("_copy"))

    def save(self, spark: SparkSession, path: str) -> None:
        frame = spark.createDataFrame([(json.dumps(self.row.asDict(), default=str), self.copies, self.order)], BOUNDARY)
        frame.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boundary:
        row = spark.read.parquet(path).first()
        return Boundary(Row(**json.loads(row["row"])), row["copies"], list(row["order"]))


BOUNDARY = "row string, copies long, order array<string>"


def holdout_split(rows: Ordered, train: float = 0.9) -> list[DataFrame]:
    return rows.split(holdout_cuts(rows.count, train))


def tail_split(rows: Ordered, held_out: float = 0.1) -> list[DataFrame]:
    return rows.split(tail_cuts(rows.count, held_out))


def three_way_split(rows: Ordered, held_out: float = 0.2, final: float = 0.5) -> list[DataFrame]:
    return rows.split(three_way_cuts(rows.count, held_out, final))


def except_split(rows: Ordered, columns: list[str], train: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Compatibility form: the test part is the set difference of the projected rows, so repeated rows
    and rows that also occur in training vanish from it."""
    head, _ = holdout_split(rows, train)
    return head.select(*columns), rows.table.select(*columns).subtract(head.select(*columns))


def label_parts(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """Reports of several parts in one table."""
    labelled = [p.withColumn("split", F.lit(n)) for p, n in zip(parts, names, strict=True)]
    both = labelled[0]
    for part in labelled[1:]:
        both = both.unionByName(part)
    return both


def ordered_head(df: DataFrame, n: int = 1000) -> DataFrame:
    return df.orderBy(*total_order(df, CHRONOLOGICAL)).limit(n)
