"""Min-max and z-score scaling. Fitting is one aggregation; applying is a projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.columns import SECONDS_PER_DAY


@dataclass(frozen=True)
class Bounds:
    """Range of a min-max scale."""

    low: float
    high: float

    def scale(self, x: Column) -> Column:
        return F.try_divide(x - F.lit(self.low), F.lit(self.high) - F.lit(self.low))

    def unscale(self, x: Column) -> Column:
        return x * (F.lit(self.high) - F.lit(self.low)) + F.lit(self.low)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.low, self.high)], "low double, high double").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Bounds:
        row = spark.read.parquet(path).first()
        return Bounds(row["low"], row["high"])


# Metres and seconds.
DEFAULT_DISTANCE_BOUNDS = Bounds(100.0, 41260.0)
DAY_BOUNDS = Bounds(0.0, float(SECONDS_PER_DAY))

DISTANCES = ["total_distance", "distance"]
TIMES = ["first_time", "exit_time", "label"]


def scale_bounds(df: DataFrame) -> DataFrame:
    """The range of ``total_distance``, which scales both distance columns."""
    return df.agg(F.min("total_distance").alias("low"), F.max("total_distance").alias("high"))


def fit_bounds(df: DataFrame) -> Bounds:
    row = scale_bounds(df).first()
    return Bounds(row["low"], row["high"])


def minmax_scale(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Scale both distances and name the arrival time ``label``."""
    return df.withColumns({c: bounds.scale(F.col(c)) for c in DISTANCES}).withColumnRenamed("arrive_time", "label")


def unscale(df: DataFrame, distance_bounds: Bounds = DEFAULT_DISTANCE_BOUNDS) -> DataFrame:
    """Distances back to metres and times to seconds, as whole numbers; nulls stay null."""
    bounds = {c: distance_bounds for c in DISTANCES} | {c: DAY_BOUNDS for c in TIMES}
    others = [c for c in df.columns if c not in bounds]
    return df.select(*others, *[F.round(b.unscale(F.col(c))).cast("int").alias(c) for c, b in bounds.items()])


@dataclass(frozen=True)
class ZScore:
    """Mean 0 and population deviation 1 per column; constant columns are only centred."""

    mean: dict[str, float]
    deviation: dict[str, float]

    @staticmethod
    def fit(df: DataFrame, columns: list[str]) -> ZScore:
        row = df.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
        ).first()
        return ZScore({c: row[f"mean_{c}"] for c in columns}, {c: row[f"std_{c}"] or 1.0 for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(self.deviation[c]) for c, m in self.mean.items()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c) * F.lit(self.deviation[c]) + F.lit(m) for c, m in self.mean.items()})

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(c, m, self.deviation[c]) for c, m in self.mean.items()]
        spark.createDataFrame(rows, "feature string, mean double, deviation double").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ZScore:
        rows = spark.read.parquet(path).collect()  # one row per feature
        return ZScore({r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["deviation"] for r in rows})
