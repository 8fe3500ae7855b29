"""Lines that many documents share, found with levelled sorted runs of line hashes and dropped everywhere.

The runs are the memory of all batches seen so far: tables of (line hash, documents), bucketed and sorted by hash. A
batch counts its own line hashes, merge-anti-joins them with the keys the runs already hold as frequent, and adds the
others as a run of level 0. Whenever a level holds ``FANOUT`` runs they are merged into one run of the next level,
which sums their counts. Runs of one store share their buckets, so the joins move the batch only; a run is moved when it
is merged, which happens once per level.

A line's key is the line without white space at its ends, A-Z in lower case; its hash has 128 bits.

Defined results: a null text has one empty line and stays null; an empty line is never dropped; equal lines of one
document count once, repeated rows count as documents of their own; a text may lose all its lines and is then empty;
an empty table gives no rows; all other columns pass through untouched.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.common import ROW_KEY, column, drop_staged, row_key, texts_of
from tripweave.session import scratch_path, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Runs per level before they are merged.
FANOUT = 3
# The white space that is no part of a line's key.
BLANK = b" \t\n\x0b\x0c\r"

LINE = ["h1", "h2"]


def line_hashes(text: bytes, min_chars: int = 1) -> list[bytes | None]:
    """The hash of every line's key; None for keys that are too short to count."""
    keys = [line.strip(BLANK).lower() for line in text.split(b"\n")]
    return [
        xxhash.xxh3_128_digest(k) if len(k) >= min_chars and (min_chars < 2 or len(k.decode()) >= min_chars) else None
        for k in keys
    ]


def document_lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """One row per document and distinct line: the row's key and the line's hash."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [set(line_hashes(t, min_chars)) - {None} for t in texts_of(batch[2])]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            hashes = np.frombuffer(b"".join(h for f in found for h in f), dtype=">i8").reshape(-1, 2)
            columns = [batch[0].take(pa.array(at)), batch[1].take(pa.array(at))]
            columns += [pa.array(hashes[:, i].astype(np.int64)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, [*ROW_KEY, *LINE])

    return docs.select(*row_key(docs), F.col(text).cast("string").alias("_text")).mapInArrow(
        lines, ", ".join(f"{c} long" for c in [*ROW_KEY, *LINE])
    )


class LineRuns:
    """Levelled sorted runs of (line hash, documents)."""

    def __init__(self, spark: SparkSession, enough: int, fanout: int = FANOUT):
        self.spark, self.enough, self.fanout = spark, enough, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.repartition(self.buckets, *LINE).write.bucketBy(self.buckets, *LINE).sortBy(*LINE)
        self.paths[name] = scratch_path(self.spark, name)
        writer.option("path", self.paths[name]).saveAsTable(name)
        return name

    def _put(self, level: int, run: str) -> None:
        """Add a run to a level; a full level is merged into one run of the next."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self._write(self._summed(old))
            self.levels[level] = []
            for name in old:
                self._drop(name)
            self._put(level + 1, merged)

    def _summed(self, runs: list[str]) -> DataFrame:
        # Read as plain files: the planner takes a union of bucketed tables for bucketed, which it is not.
        rows = [self.spark.read.schema(self.spark.table(r).schema).parquet(self.paths[r]) for r in runs]
        return reduce(DataFrame.unionByName, rows).groupBy(*LINE).agg(F.sum("n").alias("n"))

    def _drop(self, run: str) -> None:
        drop_staged(self.spark.table(run))
        self.spark.sql(f"DROP TABLE {run}")

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Take in a batch: a row per document and distinct line."""
        counts = lines.groupBy(*LINE).agg(F.count("*").alias("n"))
        for run in self.runs():
            counts = counts.join(self.spark.table(run).filter(F.col("n") >= self.enough), LINE, "left_anti")
        self._put(0, self._write(counts))

    def frequent(self) -> DataFrame:
        """Hashes of the lines found in enough documents of all batches."""
        return self._summed(self.runs()).filter(F.col("n") >= self.enough).select(*LINE)

    def close(self) -> None:
        for run in self.runs():
            self._drop(run)
        self.levels = []


def shared_lines(lines: DataFrame, min_docs: int, batches: int) -> DataFrame:
    """The stored hashes of lines found in at least ``min_docs`` documents, taken in batch by batch."""
    runs = LineRuns(lines.sparkSession, min_docs)
    for batch in range(batches):
        runs.add(lines.filter(F.pmod(F.col(ROW_KEY[0]), F.lit(batches)) == batch))
    found = stage(runs.frequent(), "shared-lines")
    runs.close()
    return found


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    text: str = "text",
    batches: int = 4,
    counts: bool = False,
) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents share, the others joined by newline.

    ``counts`` adds the columns ``n_lines`` and ``n_dropped``, in place of columns so named.
    """
    lines = stage(document_lines(docs, text, min_chars), "lines")
    shared = shared_lines(lines, min_docs, batches)
    hashed = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in LINE])
    dropped = lines.join(shared, LINE, "left_semi").groupBy(*ROW_KEY).agg(F.collect_set(hashed).alias("_dropped"))
    dropped = stage(dropped, "dropped")  # a plain exchange: adaptive execution can split rows that repeat very often

    columns = [c for c in docs.columns if not (counts and c in ("n_lines", "n_dropped"))]
    kept = T.StructType([docs.schema[c] for c in columns])
    kept[text].dataType = T.StringType()
    if counts:
        kept = kept.add("n_lines", "long").add("n_dropped", "long")
    at = columns.index(text)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch[batch.num_columns - 1].to_pylist()
            texts, n_lines, n_dropped = batch[at].cast(pa.string()).to_pylist(), [], []
            for i, value in enumerate(texts):
                held = (value or "").split("\n")
                stay = held
                if gone[i] is not None:
                    off = set(gone[i])
                    hashes = line_hashes(value.encode(), min_chars)
                    stay = [line for line, h in zip(held, hashes, strict=True) if h is None or h not in off]
                    texts[i] = "\n".join(stay)
                n_lines.append(len(held))
                n_dropped.append(len(held) - len(stay))
            arrays = [batch[i] for i in range(len(columns))]
            arrays[at] = pa.array(texts, pa.string())
            if counts:
                arrays += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, kept.names)

    named = {f"_{i}": column(c) for i, c in enumerate(columns)}
    keyed = docs.select(*[c.alias(n) for n, c in named.items()], *row_key(docs))
    return keyed.join(dropped, ROW_KEY, "left").select(*named, "_dropped").mapInArrow(drop, kept)
