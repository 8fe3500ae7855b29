"""Files as a table, and the few file system calls that jobs make between Spark writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """Path, folder, bytes and time of change of the files at folders or globs; contents are not read.

    ``uri`` is the path as ``_metadata.file_path`` of other scans gives it.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
        .select(
            "path",
            F.col("_metadata.file_path").alias("uri"),
            F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


class Folder:
    """Calls on the file system a folder lies in; paths are given in full."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._new(path))

    def names(self, path: str) -> list[str]:
        """The names inside a folder; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._new(path)))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._new(source), self._new(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._new(path), True)
