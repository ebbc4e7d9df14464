"""As-of join for any tolerance, in buckets of time.

Both sides are united and sorted inside (series, bucket), where the last right row before each left row is
a running value; what a bucket inherits is the last right row of an earlier one, from a table of one row
per series and bucket. So a long series isn't one task, and nothing is joined by range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("symbol",)


def asof_join(left: DataFrame, right: DataFrame, values: Sequence[str], tolerance: int | None = None, keys: Sequence[str] = KEYS, ts: str = "ts", bucket: int = 86_400, strict: bool = False) -> DataFrame:
    """The columns of ``left``, ``asof_ts`` and ``values`` of the last right row of the series at or before its time (before it, if ``strict``).

    No further back than ``tolerance`` seconds, both ends included; else nulls. Of right rows with one time, the one with the largest
    values counts. Left rows without a time or key find none. A bucket is ``bucket`` seconds and changes the plan, not the result.
    """
    on = list(keys)
    at = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (bucket * 1_000_000)).alias("_bucket")
    own = [c for c in left.columns if c not in (*on, ts)]
    found = F.struct(F.col(ts).alias("asof_ts"), *values)
    kind = right.select(found.alias("r")).schema["r"].dataType
    a = left.select(*on, ts, at, F.lit(1).alias("_left"), F.struct(*own, F.lit(0).alias("_")).alias("_own"), F.lit(None).cast(kind).alias("_r"))
    b = right.dropna(subset=[*on, ts]).select(*on, ts, at, F.lit(0).alias("_left"), F.lit(None).cast(a.schema["_own"].dataType).alias("_own"), found.alias("_r"))
    side = F.col("_left").desc() if strict else F.col("_left")
    inside = Window.partitionBy(*on, "_bucket").orderBy(ts, side, "_r").rowsBetween(Window.unboundedPreceding, 0)
    rows = a.unionByName(b).withColumn("_near", F.last("_r", ignorenulls=True).over(inside)).filter("_left = 1")
    buckets = a.select(*on, "_bucket").unionByName(b.select(*on, "_bucket")).distinct()
    ends = b.groupBy(*on, "_bucket").agg(F.max("_r").alias("_end"))
    earlier = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.join(ends, [*on, "_bucket"], "left").withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    # null-safe on neither side: rows without key or time inherit nothing
    joined = rows.join(carried, [*on, "_bucket"], "left").withColumn("_f", F.coalesce("_near", "_before"))
    near = F.col("_f").isNotNull() & F.col(ts).isNotNull()
    for k in on:
        near &= F.col(k).isNotNull()
    if tolerance is not None:
        near &= (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_f.asof_ts").cast("timestamp"))) <= tolerance * 1_000_000
    order = [c if c in (*on, ts) else f"_own.{c}" for c in left.columns]
    return joined.select(*order, *(F.when(near, F.col(f"_f.{c}")).alias(c) for c in ("asof_ts", *values)))
