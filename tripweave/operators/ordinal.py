"""Consecutive numbers over large groups, without one task per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import stage

# Bits of a place that count the rows of one partition.
ROW_BITS = 33


def sliced_ordinal(df: DataFrame, group: list[str], slice_col: str, order: list[str], name: str) -> DataFrame:
    """``row_number`` over (group by slice_col, order), computed slice by slice.

    Rows are sorted within (group, slice) only; the rows of earlier slices come from partial counts.
    One task sees the counts of one group: as many rows as the group has slices. Group and slice must
    not be null: a null-safe join would shuffle the rows once more. Saying so lets the rows and the
    counts share what was computed before.
    """
    keys = [*group, slice_col]
    df = df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    earlier = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("_inside", inside)
        .join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_offset", "_inside")
    )


def placed(df: DataFrame, order: list[str], name: str, label: str) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """A stored table in the given order, and (partition, rows before it, rows) of each of its partitions.

    ``name`` holds a row's place: places ascend in the order, with gaps between partitions. The partitions
    are ranges of the order, so no task sees more than its range, and the driver one count for each.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = stage(rows.withColumn(name, F.monotonically_increasing_id()), label)
    found = table.groupBy(F.shiftright(name, ROW_BITS).alias("part")).count().collect()
    parts, before = [], 0
    for part, rows_here in sorted((r["part"], r["count"]) for r in found):
        parts.append((part, before, rows_here))
        before += rows_here
    return table, parts


def position(name: str, parts: list[tuple[int, int, int]]) -> Column:
    """A row's 0-based position, from its place: one number per partition of the table."""
    before = dict((part, n) for part, n, _ in parts)
    offsets = F.array(*[F.lit(before.get(i, 0)).cast("bigint") for i in range(max(before, default=0) + 1)])
    part = F.shiftright(name, ROW_BITS)
    return F.get(offsets, part.cast("int")) + F.col(name) - F.shiftleft(part, ROW_BITS)


def place_of(position_: int, parts: list[tuple[int, int, int]]) -> int:
    """The place of a 0-based position; beyond the last row a place above all others."""
    for part, before, n in parts:
        if position_ < before + n:
            return (part << ROW_BITS) + position_ - before
    return 2**63 - 1
