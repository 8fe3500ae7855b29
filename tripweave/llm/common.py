"""What several operators share: row keys, text access in Arrow batches, byte-level word splitting."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.session import delete

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Two independent 64-bit hashes of a row: collisions are out of reach for any number of rows.
ROW_KEY = ["_k1", "_k2"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A top-level column by its name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(df: DataFrame) -> list[Column]:
    """A 128-bit content key of the rows; never null, and null differs from every value.

    Columns whose types have no hash (maps, variants, also inside others) enter as JSON text.
    """
    parts = []
    for field in df.schema:
        own = column(field.name)
        kind = field.dataType.simpleString()
        hashed = F.to_json(F.struct(own.alias("_"))) if "map<" in kind or "variant" in kind else own
        parts += [own.isNull(), hashed]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(ROW_KEY)]


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        delete(df.sparkSession, folder)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def text_slices(batch: pa.RecordBatch, column: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``at_once`` bytes of text; a longer text is a slice of its own. No row, no slice."""
    size = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(size, dtype=np.int64) // at_once
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield batch.slice(a, b - a)
