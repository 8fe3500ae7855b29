"""Dense ids: stops and vehicles numbered 1..N by ascending id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.ordinal import placed, position
from tripweave.sources.files import Folder

STOP_COLUMNS = ["exit_stop", "target_stop", "first_stop"]


def number_ids(ids: DataFrame) -> DataFrame:
    """Distinct whole-number ``id`` rows to (id, code), code = 1..N, however far apart the ids lie."""
    table, parts = placed(ids.filter(F.col("id").isNotNull()), ["id"], "_place", "ids")
    return table.select("id", (position("_place", parts) + 1).cast("int").alias("code"))


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("bigint").alias("id")).distinct()


def all_stops(df: DataFrame) -> DataFrame:
    """Stops that are left or reached, from one scan."""
    return df.select(F.explode(F.array("exit_stop", "target_stop").cast("array<bigint>")).alias("id")).distinct()


def stop_dictionary(df: DataFrame) -> DataFrame:
    return number_ids(all_stops(df))


def vehicle_dictionary(df: DataFrame) -> DataFrame:
    return number_ids(distinct_ids(df, "vehicle_id"))


class StableDictionary:
    """Codes that outlive new ids: a stored dictionary that only grows.

    Each merge numbers the ids it does not know yet, by ascending id, from where the codes end, and stores them as a
    version of their own. What is stored never changes, so encoded tables and fitted models stay valid.
    """

    SCHEMA = "id long, code int, version int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def versions(self) -> list[int]:
        """The complete versions; one that was cut off is written anew."""
        names = self.folder.names(self.folder.path)
        found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
        return sorted(v for v in found if self.folder.exists(f"{self._path(v)}/_SUCCESS"))

    def _path(self, version: int) -> str:
        return f"{self.folder.path}/version={version}"

    def codes(self, version: int | None = None) -> DataFrame:
        """(id, code, version), as it was after a version if one is given."""
        paths = [self._path(v) for v in self.versions() if version is None or v <= version]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema("id long, code int, version int").option("basePath", self.folder.path)
        return rows.parquet(*paths)

    def merge(self, ids: DataFrame) -> DataFrame:
        """Take in rows with an ``id``; the whole dictionary. Without a new id no version is written."""
        known, versions = self.codes(), self.versions()
        new = ids.select(F.col("id").cast("bigint")).distinct().join(known, "id", "left_anti")
        numbered = number_ids(new)
        most = known.agg(F.coalesce(F.max("code"), F.lit(0))).first()[0]
        if not numbered.isEmpty():
            rows = numbered.select("id", (F.col("code") + most).cast("int").alias("code"))
            rows.write.mode("overwrite").parquet(self._path(1 + max(versions, default=0)))
        return self.codes()


def encode_column(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Replace ids by their codes; an id the dictionary lacks becomes null."""
    codes = dictionary.select(F.col("id").alias("_id"), F.col("code").alias("_code"))
    return (
        df.join(codes, df[column].cast("bigint") == codes["_id"], "left")
        .withColumn(column, F.col("_code"))
        .drop("_id", "_code")
    )


def encode_ids(df: DataFrame, stops: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Encode the three stop columns and the vehicle.

    The dictionaries are meant to be stored tables: the planner then knows their size and broadcasts
    them below its threshold only.
    """
    for column in STOP_COLUMNS:
        df = encode_column(df, column, stops)
    return encode_column(df, "vehicle_id", vehicles)


def encode_rejects(encoded: DataFrame) -> DataFrame:
    """Rows with an id that no dictionary knows."""
    unknown = F.col("vehicle_id").isNull()
    for column in STOP_COLUMNS:
        unknown = unknown | F.col(column).isNull()
    return encoded.filter(unknown)
