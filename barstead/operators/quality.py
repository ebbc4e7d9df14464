"""Continuity, duplicates, close-time sanity, profile and cleaning of bar series.

Windows over a series are cut by day and stitched at the day bounds, so that one long series
isn't one task; per-day bounds are one row per series and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

KEYS = ("symbol",)


def with_previous(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts", name: str = "prev_ts") -> DataFrame:
    """Add the time of the row before in each series (null at its start)."""
    day = F.to_date(ts).alias("_day")
    rows = df.withColumn("_day", day)
    own = F.lag(ts).over(Window.partitionBy(*keys, "_day").orderBy(ts))
    days = df.groupBy(*keys, day).agg(F.max(ts).alias("_last"))
    days = days.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_day").alias("_d"), F.lag("_last").over(Window.partitionBy(*keys).orderBy("_day")).alias("_before"))
    # null-safe: rows without a time or key are rows of their own series and day
    match = F.col("_day").eqNullSafe(F.col("_d"))
    for k in keys:
        match &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = rows.withColumn("_own", own).join(days, match)
    return joined.withColumn(name, F.coalesce("_own", "_before")).drop("_own", "_before", "_day", "_d", *(f"_k_{k}" for k in keys))


def seconds_between(a: str, b: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(a), F.col(b))


def gap_rows(df: DataFrame, keys=KEYS, ts: str = "bar_ts", step: int | Column = 3600) -> DataFrame:
    """Rows whose distance to the row before isn't ``step`` seconds; repeated times are distance 0. A step column holds intervals apart."""
    diff = with_previous(df, keys, ts).withColumn("diff_s", seconds_between("prev_ts", ts))
    return diff.filter((F.col("diff_s") != step) & F.col("prev_ts").isNotNull())


def gap_count(df: DataFrame, keys=KEYS, ts: str = "bar_ts", step: int | Column = 3600) -> DataFrame:
    """Gaps and rows per series, rows without a time included."""
    diff = with_previous(df, keys, ts).withColumn("diff_s", seconds_between("prev_ts", ts))
    return diff.groupBy(*keys).agg(F.count_if(F.col("diff_s") != step).alias("gaps"), F.count("*").alias("n_rows"))


def duplicate_count(df: DataFrame, keys=KEYS, ts: str = "bar_ts") -> DataFrame:
    """Repeats after the first, per series: times are pre-counted, so no distinct set is held."""
    per = df.groupBy(*keys, ts).agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("duplicates"))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("file", "line_no")) -> DataFrame:
    """One row per key, the smallest in ``order``: a partial aggregate, not a sort."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*(F.col(k) if k in keys else F.col(f"_r.{k}") for k in df.columns))


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("file", "line_no")) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*(F.col(k) if k in keys else F.col(f"_r.{k}") for k in df.columns))


def close_time_ok(open_ts: str = "bar_ts", close_ts: str = "close_time") -> Column:
    return seconds_between(open_ts, close_ts).between(3599, 3600)


def close_time_sanity(df: DataFrame, keys=KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(close_time_ok()).alias("n_ok"), F.count_if(~close_time_ok()).alias("n_bad"))


def profile(df: DataFrame, keys=KEYS, ts: str = "bar_ts") -> DataFrame:
    """Per series of raw rows: count, first and last time in file order, duplicates, gaps, close-time verdict."""
    order = F.struct("file", "line_no", ts)
    base = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.min_by(ts, order).alias("first_ts"), F.max_by(ts, order).alias("last_ts"), F.bool_and(close_time_ok(ts)).alias("close_time_ok"))
    gaps = gap_count(df.select(*keys, ts), keys, ts).drop("n_rows")
    return base.join(duplicate_count(df, keys, ts), list(keys)).join(gaps, list(keys))


def clean(df: DataFrame, start: str | None = None, end: str | None = None, keys=KEYS, ts: str = "bar_ts", value: str = "close_text") -> DataFrame:
    """Numbers parsed, incomplete rows dropped, first of repeated times kept, range applied (both ends included)."""
    rows = df.withColumn("close", S.number(F.col(value))).drop(value).dropna(subset=[ts, "open", "close"])
    rows = dedupe_first(rows, [*keys, ts])
    if start:
        rows = rows.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        rows = rows.filter(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return rows


def clean_counters(df: DataFrame, keys=KEYS, ts: str = "bar_ts", value: str = "close_text") -> DataFrame:
    """Per series: rows, rows dropped as incomplete, rows dropped as repeated."""
    rows = df.withColumn("_ok", S.number(F.col(value)).isNotNull() & F.col("open").isNotNull() & F.col(ts).isNotNull())
    per = rows.groupBy(*keys, ts).agg(F.count("*").alias("n"), F.count_if("_ok").alias("good"))
    return per.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - F.col("good")).alias("dropped_incomplete"), F.sum(F.greatest(F.col("good") - 1, F.lit(0))).alias("dropped_duplicate"))


def gap_gate(df: DataFrame, keys=KEYS, ts: str = "bar_ts") -> DataFrame:
    """Per series: gaps and whether it may be written."""
    return gap_count(df, keys, ts).withColumn("may_write", F.col("gaps") == 0)


def stop_on_gap(df: DataFrame, keys=KEYS, ts: str = "bar_ts") -> DataFrame:
    """``df``, or an error before anything is written if a series has gaps; one small job."""
    if bad := gap_gate(df, keys, ts).filter("not may_write").orderBy(*keys).limit(5).collect():
        raise ValueError(f"gaps in {[tuple(r)[: len(keys)] for r in bad]}")
    return df
