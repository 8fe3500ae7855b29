"""Shards of near-equal size by sampled splitters.

Rows are ordered by (hash of the text, id, row). Keys drawn with a chance in proportion to a row's size give splitters,
so that ranges between them hold near-equal sizes. Every range is then measured; an overfull one is sampled again and
subdivided. The exact sizes of the ranges before a row and a running sum inside its range give every row its place in
the whole order, in bytes and in rows; a shard is an equal stretch of it.

Equal texts are neighbours in this order. A group of equal texts at the edge of two shards goes to one of them whole,
unless it is larger than a twenty-fifth of a shard: such groups are cut, or one group could fill a shard.

Defined results: a null text has no bytes; a null id sorts before all others; repeated rows have places of their own;
an empty table gives no rows; with fewer rows than shards some shards stay empty; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.common import ROW_KEY, column, drop_staged, row_key
from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: what a row takes besides its text.
ROW_BYTES = 8

# Ranges per shard at least, rows per range at most on average, and sampled keys per range.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 1_000_000
SAMPLED_PER_RANGE = 16
# A range is overfull beyond this many times the mean; so often its inside is sampled at most.
OVERFULL = 2
REFINEMENTS = 8
# A group of equal texts is kept whole up to this part of a shard.
WHOLE_GROUP = 0.04

KEY = ["_hash", "_id", "_row"]


def sized(docs: DataFrame, text: str, more: Sequence[Column] = ()) -> DataFrame:
    """Key, size and checksum of every row, and ``more``; the texts stay behind."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(content) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(content).alias("_hash"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("_id"),
        *more,
    )
    return rows.withColumn("_row", F.monotonically_increasing_id())


def sampled_keys(rows: DataFrame, each: float, draw: int) -> list[tuple]:
    """The sorted keys of rows drawn with a chance of their size divided by ``each``; other draws give other rows."""
    chance = F.pmod(F.xxhash64(F.lit(draw), *KEY), F.lit(2**40)) / F.lit(float(2**40))
    return sorted(tuple(r) for r in rows.filter(chance < F.col("size") / F.lit(each)).select(*KEY).collect())


def in_ranges(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Add ``_range``: how many splitters are at or below a row's key."""
    cuts = np.array(splitters, dtype=np.int64).reshape(-1, len(KEY))
    names = rows.columns
    at = [names.index(c) for c in KEY]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.stack([batch[i].to_numpy() for i in at], axis=1)
            both = np.concatenate([cuts, own])
            is_cut = np.arange(len(both)) < len(cuts)
            order = np.lexsort((~is_cut, both[:, 2], both[:, 1], both[:, 0]))
            number = np.empty(len(both), dtype=np.int64)
            number[order] = np.cumsum(is_cut[order])
            yield batch.append_column("_range", pa.array(number[len(cuts) :]))

    return rows.mapInArrow(find, T.StructType([*rows.schema.fields, T.StructField("_range", T.LongType())]))


def measured(rows: DataFrame) -> list[tuple[int, int, int]]:
    """Range, bytes and rows of every range: as many rows as there are ranges."""
    found = rows.groupBy("_range").agg(F.sum("size"), F.count("*")).collect()
    return sorted((r[0], r[1], r[2]) for r in found)


def balanced_ranges(rows: DataFrame, total: int, n_ranges: int) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """Rows with their range, and the exact size of each range; overfull ranges are sampled again inside."""
    keys = sampled_keys(rows, total / (n_ranges * SAMPLED_PER_RANGE), 0)
    splitters = keys[SAMPLED_PER_RANGE::SAMPLED_PER_RANGE]
    limit = OVERFULL * total / n_ranges
    for draw in range(1, REFINEMENTS + 1):
        ranged = in_ranges(rows, splitters)
        sizes = measured(ranged)
        over = [r for r, size, n in sizes if size > limit and n > 1]
        if not over:
            break
        inside = sampled_keys(ranged.filter(F.col("_range").isin(over)), limit / SAMPLED_PER_RANGE, draw)
        splitters = sorted({*splitters, *inside[:: max(1, SAMPLED_PER_RANGE // 2)]})
    return ranged, sizes


def placed(rows: DataFrame, sizes: list[tuple[int, int, int]]) -> DataFrame:
    """Add the bytes and rows before each row in the order of the keys."""
    before, offsets = (0, 0), []
    for number, size, n in sizes:
        offsets.append((number, *before))
        before = (before[0] + size, before[1] + n)
    start = rows.sparkSession.createDataFrame(offsets, "_range long, _bytes_before long, _rows_before long")
    inside = Window.partitionBy("_range").orderBy(*KEY)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumns(
            {
                "_at": F.coalesce(F.sum("size").over(upto), F.lit(0)),
                "_nth": F.row_number().over(inside) - 1,
            }
        )
        .join(start, "_range")
        .withColumns({"_at": F.col("_at") + F.col("_bytes_before"), "_nth": F.col("_nth") + F.col("_rows_before")})
        .drop("_range", "_bytes_before", "_rows_before")
    )


def _shard(cuts: list[int]) -> Column:
    """How many cuts are at or before the middle of a row: one comparison for each shard."""
    middle = F.col("_at") + F.floor(F.col("size") / 2)
    return sum(((middle >= c).cast("int") for c in cuts), F.lit(0))


def whole_groups(rows: DataFrame, cuts: list[int], shard_bytes: float) -> list[int]:
    """Cuts moved to the nearer end of the group of equal texts they fall into, if it is small."""
    first = rows.groupBy(_shard(cuts).alias("shard")).agg(F.min(F.struct("_at", "_hash")).alias("first")).collect()
    at_cut = {r["shard"]: r["first"] for r in first if r["shard"]}
    extents = {
        r["_hash"]: (r["low"], r["high"])
        for r in rows.filter(F.col("_hash").isin([r["_hash"] for r in at_cut.values()]))
        .groupBy("_hash")
        .agg(F.min("_at").alias("low"), F.max(F.col("_at") + F.col("size")).alias("high"))
        .collect()
    }
    moved = list(cuts)
    for shard, row in at_cut.items():
        low, high = extents[row["_hash"]]
        if low < row["_at"] and high - low <= WHOLE_GROUP * shard_bytes:
            cut = cuts[shard - 1]
            moved[shard - 1] = low if cut - low <= high - cut else high
    return moved


def shards(docs: DataFrame, n_shards: int, text: str = "text", more: list[Column] | None = None) -> DataFrame:
    """Id, size, checksum, shard and gapless slot of every row, and what ``more`` gives of it."""
    rows = stage(sized(docs, text, more or []), "sized")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not n:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("bigint")}).drop(*KEY)
    n_ranges = max(RANGES_PER_SHARD * n_shards, -(-n // ROWS_PER_RANGE))
    ranged, sizes = balanced_ranges(rows, total, n_ranges)
    ordered = stage(placed(ranged, sizes), "placed")
    drop_staged(rows)
    cuts = [-(-total * i // n_shards) for i in range(1, n_shards)]
    ordered = ordered.withColumn("shard", _shard(whole_groups(ordered, cuts, total / n_shards)))
    first = {r["shard"]: r["n"] for r in ordered.groupBy("shard").agg(F.min("_nth").alias("n")).collect()}
    starts = F.array(*[F.lit(first.get(i, 0)).cast("bigint") for i in range(n_shards)])
    return ordered.withColumn("slot", F.col("_nth") - F.get(starts, "shard")).drop(*KEY, "_at", "_nth")


def write_shards(docs: DataFrame, n_shards: int, path: str, text: str = "text") -> None:
    """Write the rows themselves, one folder for each shard, in the order of their slots."""
    place = shards(docs, n_shards, text, row_key(docs)).select(*ROW_KEY, F.struct("shard", "slot").alias("_place")).dropDuplicates(ROW_KEY)
    keyed = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("document"), *row_key(docs))
    (
        keyed.join(place, ROW_KEY)
        .select("document", "_place.*")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
