"""Dataset reports: profile, preview, calendar coverage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published days.
FIRST_DAY = date(2014, 8, 1)
LAST_DAY = date(2014, 10, 31)


def column_types(df: DataFrame) -> DataFrame:
    """Name, type and place of every column; nothing is read."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(rows, "place int, column string, type string")


def profile(df: DataFrame) -> DataFrame:
    """One row: the row count, and per column its type, nulls, minimum and maximum. One scan."""
    measures = [F.count("*").alias("row_count")]
    for c, kind in df.dtypes:
        measures += [
            F.first(F.lit(kind)).alias(f"{c}_type"),
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.agg(*measures)


# Sketches: registers of the distinct counts (2 to this power), and the size of the quantile sketches. Fixed values:
# the standard error of a distinct count, and the rank error of a quantile at 99 % confidence, that follow from them.
DISTINCT_REGISTERS, QUANTILE_SIZE = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.0163, 0.0133


def day_profiles(df: DataFrame, columns: list[str], day: str = "service_date") -> DataFrame:
    """One row per day and column: exact counts and range, and sketches of its distinct values and quantiles, that can
    be merged over any days without the rows."""
    states = [
        F.struct(
            F.lit(c).alias("column"),
            F.count("*").alias("row_count"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.min(F.col(c).cast("double")).alias("low"),
            F.max(F.col(c).cast("double")).alias("high"),
            F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_REGISTERS).alias("distinct"),
            F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(QUANTILE_SIZE)).alias("quantiles"),
        )
        for c in columns
    ]
    return df.groupBy(day).agg(F.array(*states).alias("states")).select(day, F.inline("states"))


def merged_profile(profiles: DataFrame) -> DataFrame:
    """One row per column over all given days: exact counts and range, about how many values, and the quartiles."""
    merged = profiles.groupBy("column").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_about"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    quartiles = [F.kll_sketch_get_quantile_double("quantiles", F.lit(q)).alias(f"q{int(100 * q)}") for q in (0.25, 0.5, 0.75)]
    known = F.col("row_count") > F.col("nulls")
    return merged.select(
        "column", "row_count", "nulls", "low", "high", "distinct_about", *[F.when(known, q).alias(n) for q, n in zip(quartiles, ("q25", "q50", "q75"), strict=True)]
    )


def preview(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    return df.orderBy(*order).limit(n)


def calendar_gaps(df: DataFrame, day: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Days from ``first`` to ``last`` (by default of the data's own range) on which ``df`` has no row."""
    present = df.select(F.to_date(day).alias("day")).distinct()
    if first and last:
        span = df.sparkSession.range(1).select(F.lit(first).alias("a"), F.lit(last).alias("b"))
    else:
        start = F.lit(first) if first else F.min("day")
        end = F.lit(last) if last else F.max("day")
        span = present.agg(start.alias("a"), end.alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    return calendar.join(present, "day", "left_anti")
