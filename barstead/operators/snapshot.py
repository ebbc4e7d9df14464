"""Five-minute metrics to hourly snapshots with a bounded fallback.

The as-of lookup "last row in [s - 1h, s)" is a pre-aggregate per hour joined on the shifted
hour: two hash aggregates and two equi-joins, no range join and no scan per hour.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from . import store
from .kept import KeptStore
from .shared import written

KEYS = ("symbol",)
# Value columns of the five-minute metrics files.
METRICS = (
    "sum_open_interest", "sum_open_interest_value", "count_long_short_ratio",
    "count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio", "sum_taker_long_short_vol_ratio",
)


def calendar(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Every hour of each series from the floor of its first to the ceiling of its last time."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    hours = F.sequence(S.hour_floor(F.col("_lo")), S.hour_ceil(F.col("_hi")), F.expr("interval 1 hour"))
    return span.select(*keys, F.explode(hours).alias("snapshot_time"))


def last_of_previous_hour(df: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """For each hour s the last row in [s - 1h, s): keys, snapshot_time, asof_ts, values."""
    hour = (S.hour_floor(F.col(ts)) + F.expr("interval 1 hour")).alias("snapshot_time")
    best = df.groupBy(*keys, hour).agg(F.max_by(F.struct(F.col(ts).alias("asof_ts"), *values), ts).alias("_r"))
    return best.select(*keys, "snapshot_time", "_r.*")


def exact_rows(df: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS, ts: str = "ts", order: Sequence[str] | None = None) -> DataFrame:
    """Rows on the hour; of several, the first in ``order``, such as file and line. Without an order the smallest values count as first."""
    on = df.filter(F.col(ts) == S.hour_floor(F.col(ts)))
    row = F.struct(*values)
    best = on.groupBy(*keys, F.col(ts).alias("snapshot_time")).agg((F.min_by(row, F.struct(*order)) if order else F.min(row)).alias("_r"))
    return best.select(*keys, "snapshot_time", F.lit(True).alias("_exact"), "_r.*")


def hourly_snapshot(df: DataFrame, values: Sequence[str] = METRICS, keys: Sequence[str] = KEYS, ts: str = "ts", order: Sequence[str] | None = None, hours: DataFrame | None = None) -> DataFrame:
    """Per series and hour: the exact row, else the last row of the hour before, else nulls. A value column that is absent is null.

    ``hours`` (keys, snapshot_time) names the hours, else they are the calendar of ``df``.
    """
    df = df.withColumns({v: F.lit(None).cast("double") for v in values if v not in df.columns})
    exact = exact_rows(df, values, keys, ts, order).withColumnsRenamed({v: f"_e_{v}" for v in values})
    asof = last_of_previous_hour(df, values, keys, ts).withColumnsRenamed({v: f"_a_{v}" for v in values})
    on = [*keys, "snapshot_time"]
    joined = (calendar(df, keys, ts) if hours is None else hours).join(exact, on, "left").join(asof, on, "left")
    provenance = F.when(F.col("_exact"), "exact").when(F.col("asof_ts").isNotNull(), "fallback").otherwise("missing")
    picked = [F.when(F.col("_exact"), F.col(f"_e_{v}")).otherwise(F.col(f"_a_{v}")).alias(v) for v in values]
    return joined.select(*keys, "snapshot_time", S.opens_at(F.col("snapshot_time")).alias("timestamp"), F.col("_exact").isNull().alias("is_fallback"), provenance.alias("provenance"), *picked)


def affected_hours(rows: DataFrame, before: DataFrame, after: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Hours (keys, snapshot_time) whose snapshot new rows may change.

    A row counts for the hour that follows it and, if it lies on the hour, for that one. Where rows lengthen a
    series (coverage ``before`` and ``after``: first_ts, last_ts), the calendar's new hours count too.
    """
    on, hour = list(keys), F.expr("interval 1 hour")
    floor = S.hour_floor(F.col(ts))
    own = rows.select(*on, F.explode(F.array(floor + hour, F.when(F.col(ts) == floor, floor))).alias("snapshot_time")).filter("snapshot_time is not null")
    old = before.select(*on, S.hour_floor(F.col("first_ts")).alias("_first"), S.hour_ceil(F.col("last_ts")).alias("_last"))
    ends = after.join(rows.select(*on).distinct(), on, "left_semi").join(old, on, "left")
    lo, hi = S.hour_floor(F.col("first_ts")), S.hour_ceil(F.col("last_ts"))
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b, hour)).otherwise(F.array().cast("array<timestamp_ntz>"))
    new = F.when(F.col("_first").isNull(), upto(lo, hi)).otherwise(F.concat(upto(lo, F.col("_first") - hour), upto(F.col("_last") + hour, hi)))
    both = own.union(ends.select(*on, F.explode(new).alias("snapshot_time")))
    # the hour after the last row of a series isn't in its calendar
    return both.join(ends.select(*on, hi.alias("_hi")), on).filter(F.col("snapshot_time") <= F.col("_hi")).select(*on, "snapshot_time").distinct()


def refresh_snapshot(raw: KeptStore, batch: DataFrame, path: str, values: Sequence[str] = METRICS, name: str | None = None) -> list[date]:
    """Append ``batch`` to the kept raw rows and bring the hourly snapshot at ``path`` up to date; the days that were rewritten come back.

    Only affected hours are computed, from the raw rows of their days and the days before, and only the
    folders of their days are replaced. Under a ``name`` it can be repeated after a failure.
    """
    spark, on = raw.spark, list(raw.keys)
    name = name or uuid.uuid4().hex
    fresh = raw.append(batch, name=name)
    hours = written(affected_hours(fresh, raw.coverage(without=name), raw.coverage(), on, raw.ts), "hours")
    days = sorted(x.day for x in hours.select(F.to_date("snapshot_time").alias("day")).distinct().collect())
    if not days:
        return []
    rows = raw.read(sorted({*days, *(d - timedelta(days=1) for d in days)}))
    new = hourly_snapshot(rows, values, on, raw.ts, hours=hours)
    if store.exists(spark, path):
        old = read_snapshot(spark, path, new.schema, days)
        new = old.join(hours, [*on, "snapshot_time"], "left_anti").unionByName(new)
    out = written(new.withColumn("day", F.to_date("snapshot_time")), "snapshot")  # else the folders would be read while they are replaced
    out.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return days


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None) -> DataFrame:
    held = spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)
    return (held if days is None else held.filter(F.col("day").isin(list(days)))).drop("day")


def provenance_counts(snapshot: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return snapshot.groupBy(*keys, "provenance").agg(F.count("*").alias("n"))
