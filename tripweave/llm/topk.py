"""Exact top-k inner-product search by distributed histogram selection.

All rows are scored against a block of queries. Every task counts its scores per query in the bins of an interval that
surely holds the k-th value; the summed counts say which bin does, and that bin is the next interval, until it is one
score wide. Then the rows above the k-th value are filtered out, and of the rows that tie with it those with the
smallest ids, as many as are missing. A task reports bins from its top down to its own k-th row only, since the global
k-th value is never below it.

Vectors become whole numbers, so scores are exact in any order of summation. Scores come from a matrix product of
doubles; a pair whose lengths allow a score beyond 53 bits is taken out and summed in 64-bit or, beyond those, in
unbounded whole numbers. A few vectors with large components therefore cost their own pairs more and nothing else.

Defined results: a score beyond the range of a long counts as the largest or smallest long but two; vectors that are null or hold null or non-finite components and candidates without an id take no part; empty vectors score zero
among themselves; vectors of different lengths are not compared; of rows that repeat a query's id one asks, the smallest
vector, and none of them is its candidate; repeated candidate rows each count; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import drop_staged
from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Queries scored in one pass, bins of a histogram, rows scored at once.
QUERY_BLOCK = 1024
BINS = 1024
ROWS_AT_ONCE = 2048
# Whole numbers up to here are exact as doubles, so sums of products may be taken by matrix products of doubles.
EXACT = 2**53
# Sums of products up to here fit 64 bits, with room for the rounding of the bound; the largest score kept apart
# from the mark of a query's own row; pairs that are summed at once.
LONG_SAFE = 2.0**62
LARGEST = 2**63 - 3
PAIRS_AT_ONCE = 1 << 16

RESULT = "query_id long, rank int, vec_id long, score long"


def whole(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of equal length as whole numbers, with their positions: floor(scale * x) of every component."""
    sizes = np.array([-1 if v is None else v for v in pa.compute.list_value_length(column).to_pylist()])
    for size in np.unique(sizes[sizes >= 0]):
        at = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(at)).flatten().cast(pa.float64())
        matrix = flat.to_numpy(zero_copy_only=False).reshape(len(at), size)  # null components become NaN
        with np.errstate(over="ignore"):
            scaled = np.floor(scale * matrix)
        good = np.isfinite(scaled).all(axis=1)
        yield at[good], scaled[good]


def whole_vectors(rows: DataFrame, scale: float, vector: str) -> DataFrame:
    """Id and whole-number vector of the rows that take part."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in whole(batch[1], scale):
                values = pa.array(matrix.ravel())
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * matrix.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch[0].take(pa.array(at)), pa.ListArray.from_arrays(offsets, values)], ["vec_id", "vector"]
                )

    return rows.select(F.col("vec_id").cast("bigint"), F.col(vector).cast("array<double>")).mapInArrow(
        convert, "vec_id long, vector array<double>"
    )


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths; squares beyond the range of doubles stay out of reach by scaling."""
    largest = np.abs(vectors).max(axis=1, initial=1.0)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(axis=1))


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors, by query and row."""
    with np.errstate(over="ignore", invalid="ignore"):
        limit = lengths(queries)[:, None] * lengths(rows)[None, :] * (1 + 1e-9)
        far = limit >= EXACT
        score = np.where(far, 0, queries @ rows.T).astype(np.int64)
        pairs = np.argwhere(far)
        for a in range(0, len(pairs), PAIRS_AT_ONCE):
            q, r = pairs[a : a + PAIRS_AT_ONCE].T
            wide = limit[q, r] >= LONG_SAFE
            short_q, short_r = q[~wide], r[~wide]
            # A length below the bound bounds every component, or the other vector is zero.
            left, right = (np.clip(x, -LONG_SAFE, LONG_SAFE).astype(np.int64) for x in (queries[short_q], rows[short_r]))
            score[short_q, short_r] = (left * right).sum(axis=1)
            for i, j in zip(q[wide].tolist(), r[wide].tolist(), strict=True):
                exact = sum(int(x) * int(y) for x, y in zip(queries[i].tolist(), rows[j].tolist(), strict=True))
                score[i, j] = max(-LARGEST, min(LARGEST, exact))
    return score


class Block:
    """Queries of one length: ids, vectors, and the interval that holds the k-th score of each, ends included."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, k: int):
        self.ids, self.vectors = ids, vectors
        bound = [min(LARGEST, int(min(n * longest, 2.0**63)) + 1) for n in lengths(vectors).tolist()]
        self.low = np.array([-b for b in bound], dtype=np.int64)
        self.high = np.array(bound, dtype=np.int64)
        self.width = np.array([2 * b // BINS + 1 for b in bound], dtype=np.int64)
        self.missing = np.full(len(ids), k)

    def bins(self, score: np.ndarray) -> np.ndarray:
        """The bin of each score of the interval: bins begin at multiples of the width."""
        width = np.maximum(1, self.width)[:, None]
        return score // width - self.low[:, None] // width

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate ids and their scores by query, in pieces; a query's own id scores below every interval."""
        for at, matrix in whole(batch[1], 1.0):
            if matrix.shape[1] != self.vectors.shape[1]:
                continue
            ids = np.array([-1 if v is None else v for v in batch[0].take(pa.array(at)).to_pylist()], dtype=np.int64)
            known = batch[0].is_valid().to_numpy(zero_copy_only=False)[at]
            for a in range(0, len(at), ROWS_AT_ONCE):
                part = ids[a : a + ROWS_AT_ONCE]
                score = inner_products(self.vectors, matrix[a : a + ROWS_AT_ONCE])
                own = (part[None, :] == self.ids[:, None]) | ~known[None, a : a + ROWS_AT_ONCE]
                score[own] = np.iinfo(np.int64).min
                yield part, score


def histograms(candidates: DataFrame, b: Block) -> DataFrame:
    """Counts per query and bin of its interval, from the top down to each task's own k-th row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(b.ids), BINS + 2), dtype=np.int64)
        rows = np.arange(len(b.ids))[:, None] * counts.shape[1]
        for batch in batches:
            for _, score in b.scores(batch):
                inside = (score >= b.low[:, None]) & (score <= b.high[:, None])
                counts += np.bincount((rows + b.bins(score))[inside], minlength=counts.size).reshape(counts.shape)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        query, bin_ = np.nonzero((counts > 0) & (above < b.missing[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(bin_), pa.array(counts[query, bin_])], ["query", "bin", "n"]
        )

    return candidates.mapInArrow(count, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def refine(candidates: DataFrame, block: Block) -> None:
    """Narrow every query's interval to the score of its k-th row; one row per query comes to the driver each time.

    The counts are summed from the top only as far as some task needs, so a bin's count may be too small, but never
    before the k-th row is reached.
    """
    spark = candidates.sparkSession
    down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    open_ = np.ones(len(block.ids), dtype=bool)
    while open_.any():
        missing = spark.createDataFrame([(i, int(m)) for i, m in enumerate(block.missing)], "query long, missing long")
        found = (
            histograms(candidates, block)
            .withColumn("upto", F.sum("n").over(down))
            .join(missing, "query")
            .filter(F.col("upto") >= F.col("missing"))
            .groupBy("query")
            .agg(F.min(F.struct("upto", "bin", "n")).alias("kth"))
            .select("query", "kth.*")
            .collect()
        )
        kth = {r["query"]: r for r in found}
        for i in np.flatnonzero(open_):
            if i not in kth:  # fewer rows than asked for: all of them are taken
                block.width[i], open_[i] = 0, False
                continue
            r = kth[i]
            block.missing[i] -= r["upto"] - r["n"]
            width = int(block.width[i])
            first = (int(block.low[i]) // width + r["bin"]) * width
            block.low[i] = max(int(block.low[i]), first)
            block.high[i] = min(int(block.high[i]), first + width - 1)
            open_[i] = block.low[i] < block.high[i]
            block.width[i] = max(1, -(-width // BINS))


def selected(candidates: DataFrame, b: Block) -> DataFrame:
    """Rows above the k-th score, and each task's smallest ids among those that tie with it."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest = np.where(b.width == 0, np.iinfo(np.int64).min + 1, b.low)
        tied: list[np.ndarray] = [np.zeros(0, dtype=np.int64) for _ in b.ids]

        def rows(query, ids, score):
            return pa.RecordBatch.from_arrays(
                [pa.array(b.ids[query]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"]
            )

        for batch in batches:
            for ids, score in b.scores(batch):
                query, at = np.nonzero((score > lowest[:, None]) | ((b.width == 0)[:, None] & (score >= lowest[:, None])))
                yield rows(query, ids[at], score[query, at])
                ties = (score == b.low[:, None]) & (b.width > 0)[:, None]
                for q in np.flatnonzero(ties.any(axis=1)):
                    tied[q] = np.sort(np.concatenate([tied[q], ids[ties[q]]]))[: b.missing[q]]
        query = np.repeat(np.arange(len(b.ids)), [len(t) for t in tied])
        yield rows(query, np.concatenate([*tied, np.zeros(0, dtype=np.int64)]), b.low[query])

    return candidates.mapInArrow(pick, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, is_query: Column, k: int, scale: float = 1024.0, vector: str = "embedding") -> DataFrame:
    """The ``k`` highest scores of every query row against all other rows, ties to the smaller id."""
    candidates = stage(whole_vectors(rows, scale, vector), "vectors")
    spark = rows.sparkSession
    queries = stage(
        candidates.filter(is_query & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vector").alias("vector")),
        "query-vectors",
    )
    # No vector is longer than its largest component times the root of their number.
    norm = F.array_max(F.transform("vector", F.abs)) * F.sqrt(F.size("vector"))
    longest = candidates.agg(F.max(norm)).first()[0] or 0.0
    n_blocks = -(-queries.count() // QUERY_BLOCK)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    parts = []
    for number in range(n_blocks):
        mine = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == number).orderBy("vec_id").collect()
        for size in sorted({len(r["vector"]) for r in mine}):
            same = [r for r in mine if len(r["vector"]) == size]
            vectors = np.array([r["vector"] for r in same], dtype=np.float64).reshape(len(same), size)
            block = Block(np.array([r["vec_id"] for r in same], dtype=np.int64), vectors, longest * (1 + 1e-9), k)
            refine(candidates, block)
            best = (
                selected(candidates, block)
                .withColumn("rank", F.row_number().over(ranked))
                .filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score")
            )
            parts.append(stage(best, "top"))
    drop_staged(candidates)
    if not parts:
        return spark.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, parts)
