"""Scalar building blocks: epochs, bar alignment, lenient casts. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values above are microseconds, others milliseconds.
MICROS_FROM = 10**15
#: 2017-01-01 and 2030-01-01 in milliseconds.
EARLIEST_MS, LATEST_MS = 1483228800000, 1893456000000


def epoch_ms(text: Column) -> Column:
    """Milliseconds of an epoch in text form, decided value by value; null where it isn't a number."""
    x = text.try_cast("bigint")
    return F.when(x > MICROS_FROM, (x - x % 1000) / 1000).otherwise(x).cast("bigint")


def from_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def in_epoch_range(ms: Column) -> Column:
    return ms.between(EARLIEST_MS, LATEST_MS)


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_ceil(ts: Column) -> Column:
    return hour_floor(ts + F.expr("interval 1 hour") - F.expr("interval 1 microsecond"))


def closes_at(ts: Column, interval: str = "1 hour") -> Column:
    """The instant at which a bar's value is known: its end."""
    return ts + F.expr(f"interval {interval}")


def opens_at(snapshot: Column, interval: str = "1 hour") -> Column:
    return snapshot - F.expr(f"interval {interval}")


def number(text: Column) -> Column:
    """Double, or null where the text isn't a finite number."""
    x = text.try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)  # NaN is above all numbers


def strict_number(text: Column) -> Column:
    """Double; a text that isn't a number is an error when the column is computed."""
    return text.cast("double")


def strict_count(text: Column) -> Column:
    """Integer by way of double, since archives write counts as ``12.0`` as well; null stays null, other text is an error."""
    return text.cast("double").cast("int")


def without_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def timestamp_or_null(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def run_id(now: Column) -> Column:
    return F.date_format(now, "yyyyMMdd'_'HHmmss'Z'")
