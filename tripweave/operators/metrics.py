"""Regression metrics, each set in one aggregation over (label, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import abs_error

# Seconds.
THRESHOLDS = [600, 300, 60, 30]


def squared_error() -> Column:
    return F.pow(F.col("label") - F.col("prediction"), 2)


def with_abs_error(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("abs_diff", abs_error(F.col("label"), F.col("prediction")))


def share_within(seconds: int) -> Column:
    """Percentage of rows whose absolute error is at most ``seconds``."""
    inside = F.when(abs_error(F.col("label"), F.col("prediction")) <= seconds, 1).otherwise(0)
    return 100 * F.avg(inside)


def rmse() -> Column:
    return F.sqrt(F.avg(squared_error()))


def r2() -> Column:
    return 1 - F.try_divide(F.avg(squared_error()), F.var_pop("label"))


def within_thresholds(predictions: DataFrame) -> DataFrame:
    return predictions.agg(*[share_within(s).alias(f"within_{s}") for s in THRESHOLDS])


def evaluate(predictions: DataFrame) -> DataFrame:
    """All metrics as (metric, value) rows, from one pass."""
    measures = {f"within_{s}": share_within(s) for s in THRESHOLDS} | {"rmse": rmse(), "r2": r2()}
    wide = predictions.agg(*[c.alias(n) for n, c in measures.items()], F.count("*").cast("double").alias("rows"))
    return wide.unpivot([], [*measures, "rows"], "metric", "value")
