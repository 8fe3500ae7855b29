"""Tab-separated ping files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.columns import blank_to_null
from tripweave.operators.cleaning import PING_COLUMNS
from tripweave.sources.files import listed

# The columns of a headerless file that are not used.
UNUSED_POSITIONS = ["_c0", "_c1", "_c5", "_c6", "_c7", "_c8"]


def read_pings_tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headered files, a folder or a glob, as text columns picked by name.

    All days are one scan. The schema comes from a header and is checked against the header of every
    other file, since Spark fills CSV columns by position.
    """
    raw = spark.read.csv(paths, sep="\t", header=True, inferSchema=False, enforceSchema=False)
    return raw.select(*[blank_to_null(F.col(c)).alias(c) for c in PING_COLUMNS])


def first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The first line of each file, as ``header`` next to the file's ``uri``."""
    if not paths:
        return spark.createDataFrame([], "uri string, header string")
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(paths)
        .select("value", F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"))
        .filter(F.col("block") == 0)
        .withColumn("at", F.monotonically_increasing_id())
    )
    return lines.groupBy("uri").agg(F.min_by("value", "at").alias("header"))


def file_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files at folders, globs or paths as ``listed`` gives them, with their first lines as ``header``.

    Files without a byte are passed over, as by every scan.
    """
    return listed(spark, paths).join(first_lines(spark, paths), "uri", "left")


def header_names(header: str | None) -> tuple[str, ...]:
    """The column names of a header line, without quotes and byte order mark."""
    return tuple(name.strip().strip('"') for name in (header or "").lstrip("\ufeff").split("\t"))


def read_unlike_tsv(spark: SparkSession, files: DataFrame, uri: bool = False) -> tuple[DataFrame, DataFrame]:
    """Files with headers of their own, as ``file_headers`` gives them: the rows, and the files that can't be read.

    Files with equal headers are one scan, whose schema has a column for every name of the header; the needed columns
    are picked by where their names stand, and the scans are put together. A file whose header lacks a needed column
    is given back with the names it lacks. ``uri`` adds the file each row is from.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    rejected = []
    for r in files.select("path", "header").collect():
        names = header_names(r["header"])
        missing = [c for c in PING_COLUMNS if c not in names]
        if missing:
            rejected.append((r["path"], r["header"], missing))
        else:
            groups.setdefault(names, []).append(r["path"])
    own = [F.col("_metadata.file_path").alias("uri")] if uri else []
    scans = []
    for names, paths in sorted(groups.items()):
        schema = ", ".join(f"_c{i} string" for i in range(len(names)))
        rows = spark.read.schema(schema).csv(sorted(paths), sep="\t", header=True)
        picked = [blank_to_null(F.col(f"_c{names.index(c)}")).alias(c) for c in PING_COLUMNS]
        scans.append(rows.select(*picked, *own))
    if not scans:
        schema = ", ".join(f"{c} string" for c in [*PING_COLUMNS, *(["uri"] if uri else [])])
        scans.append(spark.createDataFrame([], schema))
    rejects = spark.createDataFrame(rejected, "path string, header string, missing array<string>")
    return reduce(DataFrame.unionByName, scans), rejects


def read_headerless_tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headerless files as ``_cN`` text columns without the unused ones."""
    return spark.read.csv(paths, sep="\t", header=False).drop(*UNUSED_POSITIONS)


def read_headerless(spark: SparkSession, paths: str | list[str], names: list[str]) -> DataFrame:
    """Headerless files whose columns are named here, in their order, as text columns picked by name."""
    raw = spark.read.csv(paths, sep="\t", header=False).toDF(*names)
    return raw.select(*[blank_to_null(F.col(c)).alias(c) for c in PING_COLUMNS])


def write_pings_tsv(pings: DataFrame, path: str) -> None:
    """Pings as headered text, one folder per day."""
    (
        pings.withColumn("service_date", F.to_date("time_received"))
        .withColumn("time_received", F.col("time_received").cast("string"))
        .hint("rebalance", "service_date")
        .write.partitionBy("service_date")
        .csv(path, sep="\t", header=True)
    )
