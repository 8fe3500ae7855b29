"""Scalar expressions. All are built-in column arithmetic, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SECONDS_PER_DAY = 86400
MICROS_PER_SECOND = 1_000_000
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
STOP_PATTERN = r"MTA_(\d+)$"
# Tokens a tabular text reader takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def blank_to_null(text: Column) -> Column:
    return F.when(~text.isin(NULL_TOKENS), text)


def parse_whole(text: Column) -> Column:
    """Whole number from text, also from a decimal form such as ``512.0``; null if it is neither."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a zone-less timestamp; null if malformed."""
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def parse_stop(stop_id: Column) -> Column:
    """The number in a stop id; null if there is none."""
    return F.regexp_extract(stop_id, STOP_PATTERN, 1).try_cast("bigint")


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def crossing_micros(second: Column, seconds_later: Column) -> Column:
    """Microseconds since midnight; the fractional delay is rounded half-even to the microsecond."""
    delay = F.rint(seconds_later * MICROS_PER_SECOND).cast("bigint")
    return second.cast("bigint") * MICROS_PER_SECOND + delay


def day_fraction(micros: Column) -> Column:
    """Microseconds since midnight, cut to the whole second, as a fraction of the day."""
    return F.floor(micros / MICROS_PER_SECOND) / F.lit(SECONDS_PER_DAY)


def nearest_ten(x: Column) -> Column:
    """Half-even rounding to tens (``round(x, -1)`` would round halves up)."""
    return F.rint(x / 10) * 10


def abs_error(label: Column, prediction: Column) -> Column:
    return F.abs(label - prediction)
