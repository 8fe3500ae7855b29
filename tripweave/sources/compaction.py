"""Compaction of Parquet folders by a plan of files.

The plan is made from the listed sizes alone, folder by folder: files of at least half the target are kept as they are,
smaller ones are packed into bins of at most the target, largest first, each into the fullest bin that has room. A bin
of several files is rewritten as one file; a bin of one file is left alone. Rounds follow until no plan joins anything,
so the files left over depend on the stored bytes only, not on the session, and a second run finds nothing to do.

Rows keep the order of their files and of their places in them. They travel and are sorted as packed chunks of a file, so
that the task that writes a bin holds about the bytes of its files, however many rows these are. A folder's files are replaced only when all new files
are written and the list of replacements is stored beside them; a run that was cut off after that point is completed by
the next one, before it, undone. Readers should wait while files are replaced.

Folders of any partitioning, nested ones too, keep it: partition columns are never read.
"""

from __future__ import annotations

import sys
import uuid
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.sources.files import Folder, listed

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TARGET_BYTES = 256 << 20
# The part of the target from which a file is kept.
KEPT_FROM = 0.5
# Files that are rewritten in one job.
FILES_AT_ONCE = 10_000
# Begins the names of folders that readers pass over.
WORK = "_compaction-"

PLAN = "path string, uri string, folder string, length long, bin int"
CHUNKS = "_bin int, _file int, _row long, _packed binary"


def packed(sizes: list[int], target: int) -> list[int]:
    """The bin of each size: largest first, into the fullest bin with room, or a new one."""
    bins, room = [0] * len(sizes), []
    n = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, bins[i] = room.pop(at)
        else:
            left, bins[i], n = target, n, n + 1
        insort(room, (left - sizes[i], bins[i]))
    return bins


def file_plan(files: DataFrame, target: int) -> DataFrame:
    """The files to rewrite, of a listing with path, uri, folder and length, and their bin in the folder.

    Only small files take part; the files of one folder are planned together, as rows of numbers.
    """
    small = files.filter(F.col("length") < int(target * KEPT_FROM)).select("path", "uri", "folder", "length")

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("path")
        frame["bin"] = packed(frame["length"].tolist(), target)
        return frame[frame.groupby("bin")["bin"].transform("size") > 1]

    return small.groupBy("folder").applyInPandas(plan, PLAN)


def _batches(plan: list) -> list[list]:
    """Whole bins, about so many files at once; ``plan`` is sorted by folder and bin."""
    batches, last = [[]], None
    for row in plan:
        bin_ = (row["folder"], row["bin"])
        if len(batches[-1]) >= FILES_AT_ONCE and bin_ != last:
            batches.append([])
        batches[-1].append(row)
        last = bin_
    return [b for b in batches if b]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring rows of one file as one compressed value each, with the place of their first row."""
    for batch in batches:
        places = {c: batch.column(c).to_numpy() for c in ("_bin", "_file", "_row")}
        file, row = places["_file"], places["_row"]
        edges = np.flatnonzero((file[1:] != file[:-1]) | (row[1:] != row[:-1] + 1)) + 1
        starts = np.concatenate([[0], edges]) if len(row) else edges
        rows = batch.select([c for c in batch.schema.names if c not in places])
        held = []
        for first, end in zip(starts, [*starts[1:], len(row)], strict=False):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(rows.slice(first, end - first))
            held.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_pydict({c: v[starts] for c, v in places.items()} | {"_packed": pa.array(held, pa.binary())})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed_rows in batch.column("_packed"):
            yield from pa.ipc.open_stream(packed_rows.as_buffer())


def _rewrite(spark: SparkSession, folder: Folder, rows: list) -> None:
    """Write one file per bin and the list of replacements, then replace."""
    work = f"{folder.path}/{WORK}{uuid.uuid4().hex}"
    number: dict[tuple[str, int], int] = {}
    for r in rows:
        number.setdefault((r["folder"], r["bin"]), len(number))
    parts = [
        (r["path"], r["uri"], r["folder"], number[r["folder"], r["bin"]], i)
        for i, r in enumerate(sorted(rows, key=lambda r: r["uri"]))
    ]
    files = spark.createDataFrame(parts, "path string, uri string, folder string, _bin int, _file int")
    paths = [r["path"] for r in rows]
    # Partition columns stay in the names of the folders.
    data = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*paths)
    placed = data.select(
        "*", F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.row_index").alias("_row")
    ).join(F.broadcast(files.select(F.col("uri").alias("_uri"), "_bin", "_file")), "_uri")
    # The partition of a bin has its number, and so has the file it writes.
    (
        placed.drop("_uri")
        .mapInArrow(_pack, CHUNKS)
        .repartitionById(len(number), "_bin")
        .sortWithinPartitions("_file", "_row")
        .mapInArrow(_unpack, data.schema)
        .write.option("maxRecordsPerFile", 0)
        .parquet(f"{work}/new")
    )
    files.select("path", "folder", "_bin").coalesce(1).write.parquet(f"{work}/replaced")
    _replace(spark, folder, work)


def _replace(spark: SparkSession, folder: Folder, work: str) -> None:
    """Put the new files in place of the old ones. Every step may be repeated after one that was cut off."""
    replaced = spark.read.parquet(f"{work}/replaced").collect()
    home = {r["_bin"]: r["folder"] for r in replaced}
    new: dict[int, list[str]] = {b: [] for b in home}
    for name in folder.names(f"{work}/new"):
        if name.endswith(".parquet"):
            new[int(name.split("-")[1])].append(name)
        elif name.startswith("_bin="):  # written by an earlier version, in a folder for each bin
            inside = [n for n in folder.names(f"{work}/new/{name}") if n.endswith(".parquet")]
            new[int(name.removeprefix("_bin="))] += [f"{name}/{n}" for n in inside]
    kept = set()
    for r in sorted(replaced, key=lambda r: r["path"]):
        if not new[r["_bin"]] and r["_bin"] not in kept:  # of files without rows one stays
            kept.add(r["_bin"])
        else:
            folder.delete(r["path"])
    for bin_, names in sorted(new.items()):
        for name in names:
            folder.move(f"{work}/new/{name}", f"{home[bin_]}/bin-{bin_}-{name.rsplit('/', 1)[-1]}")
    folder.delete(work)


def recover(spark: SparkSession, path: str) -> None:
    """Complete or undo what a run that was cut off has left."""
    folder = Folder(spark, path)
    for name in folder.names(folder.path):
        if name.startswith(WORK):
            work = f"{folder.path}/{name}"
            if folder.exists(f"{work}/replaced/_SUCCESS"):
                _replace(spark, folder, work)
            else:
                folder.delete(work)


def _folders(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    return (
        listed(spark, path, "*.parquet")
        .groupBy("folder")
        .agg(F.count("*").alias(f"files_{suffix}"), F.sum("length").alias(f"bytes_{suffix}"))
    )


def compact_folder(spark: SparkSession, path: str, target: int = TARGET_BYTES) -> DataFrame:
    """Compact in place; per folder its files and bytes before and after, and how many files were rewritten."""
    folder = Folder(spark, path)
    recover(spark, path)
    before = {r["folder"]: (r["files_before"], r["bytes_before"]) for r in _folders(spark, path, "before").collect()}
    rewritten: dict[str, int] = dict.fromkeys(before, 0)
    while plan := file_plan(listed(spark, path, "*.parquet"), target).collect():
        for rows in _batches(sorted(plan, key=lambda r: (r["folder"], r["bin"], r["path"]))):
            _rewrite(spark, folder, rows)
            for r in rows:
                rewritten[r["folder"]] += 1
    after = {r["folder"]: (r["files_after"], r["bytes_after"]) for r in _folders(spark, path, "after").collect()}
    rows = [(f, *before[f], *after[f], rewritten[f]) for f in sorted(before)]
    schema = "folder string, files_before long, bytes_before long, files_after long, bytes_after long, rewritten long"
    return spark.createDataFrame(rows, schema)
