"""Comparison of two sources, and validation of a batch against the store with ordered reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import quality
from .shared import written

KEYS = ("symbol",)
VALUES = ("open", "high", "low", "close", "volume")
TOLERANCE = 1e-8


def difference(a: Column, b: Column) -> Column:
    """Absolute difference, null where either side is null or NaN."""
    return S.without_nan(F.abs(a - b))


def both_sides(left: DataFrame, right: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    """One full outer join: keys, time, in_left, in_right and each value as l_ and r_."""
    on = [*keys, ts]
    a = left.select(*on, F.lit(True).alias("_l"), *(F.col(v).alias(f"l_{v}") for v in values))
    b = right.select(*on, F.lit(True).alias("_r"), *(F.col(v).alias(f"r_{v}") for v in values))
    joined = a.join(b, on, "full_outer")
    return joined.withColumn("in_left", F.col("_l").isNotNull()).withColumn("in_right", F.col("_r").isNotNull()).drop("_l", "_r")


def reconcile(archive: DataFrame, feed: DataFrame, columns: Sequence[tuple[str, float]], keys: Sequence[str] = KEYS, ts: str = "bar_ts", per: Sequence[str] | None = None) -> DataFrame:
    """Per series (or per ``per``): compared, matched, mismatched, archive_only, feed_only, max_diff, ok.

    A row mismatches if any column's difference exceeds its tolerance; NaN differences match. ``max_diff`` is of the first column.
    """
    sides = both_sides(archive, feed, [c for c, _ in columns], keys, ts)
    common = F.col("in_left") & F.col("in_right")
    bad = F.lit(False)
    for c, tol in columns:
        bad |= F.coalesce(difference(F.col(f"l_{c}"), F.col(f"r_{c}")) > tol, F.lit(False))
    first = columns[0][0]
    out = sides.groupBy(*(keys if per is None else per)).agg(
        F.count_if(common).alias("compared"),
        F.count_if(common & ~bad).alias("matched"),
        F.count_if(common & bad).alias("mismatched"),
        F.count_if(~F.col("in_right")).alias("archive_only"),
        F.count_if(~F.col("in_left")).alias("feed_only"),
        F.round(F.coalesce(F.max(difference(F.col(f"l_{first}"), F.col(f"r_{first}"))), F.lit(0.0)), 10).alias("max_diff"),
    )
    return out.withColumn("ok", (F.col("compared") > 0) & (F.col("mismatched") == 0))


def day_digests(rows: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    """Per series and day: rows and an order-free digest of times and values. Small enough to keep beside a table."""
    parts = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), F.col(ts), *values)
        parts += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))]
    return rows.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"), F.concat_ws("-", *(p.cast("string") for p in parts)).alias("digest"))


def reconcile_by_digest(
    archive: DataFrame, feed: DataFrame, columns: Sequence[tuple[str, float]], keys: Sequence[str] = KEYS, ts: str = "bar_ts", archive_digests: DataFrame | None = None, feed_digests: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The report of ``reconcile`` per series, and the (keys, day) that were compared row by row.

    Days on which both sides have equal digests agree without a join of their rows; kept digests spare
    reading them at all. Only rows of the other days meet. A bar is unique on each side (see ``dedupe_first``).
    """
    on, values = list(keys), [c for c, _ in columns]
    a = (day_digests(archive, values, keys, ts) if archive_digests is None else archive_digests).withColumnsRenamed({"n": "_an", "digest": "_ad"})
    b = (day_digests(feed, values, keys, ts) if feed_digests is None else feed_digests).withColumnsRenamed({"n": "_bn", "digest": "_bd"})
    days = written(a.join(b, [*on, "day"], "full_outer").withColumn("same", (F.col("_an") == F.col("_bn")) & F.col("_ad").eqNullSafe(F.col("_bd"))), "days")
    apart = days.filter("same is not true").select(*on, "day")
    rows = lambda side: side.withColumn("day", F.to_date(ts)).join(apart, [*on, "day"], "left_semi").drop("day")
    detailed = reconcile(rows(archive), rows(feed), columns, keys, ts).drop("ok")
    n = F.sum("_an").cast("long")
    zero = F.lit(0).cast("long")
    agreed = days.filter("same").groupBy(*on).agg(n.alias("compared"), n.alias("matched")).select("*", zero.alias("mismatched"), zero.alias("archive_only"), zero.alias("feed_only"), F.lit(0.0).alias("max_diff"))
    counts = ["compared", "matched", "mismatched", "archive_only", "feed_only"]
    out = detailed.unionByName(agreed).groupBy(*on).agg(*(F.sum(c).alias(c) for c in counts), F.max("max_diff").alias("max_diff"))
    return out.withColumn("ok", (F.col("compared") > 0) & (F.col("mismatched") == 0)), apart


def mismatch_sample(archive: DataFrame, feed: DataFrame, value: str, tolerance: float, n: int = 5, keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    """The first ``n`` mismatches in time order."""
    sides = both_sides(archive, feed, [value], keys, ts)
    diff = sides.withColumn("diff", F.round(difference(F.col(f"l_{value}"), F.col(f"r_{value}")), 10)).filter(F.col("diff") > tolerance)
    return diff.select(*keys, ts, f"l_{value}", f"r_{value}", "diff").orderBy(ts, *keys).limit(n)


def last_stored(store: DataFrame, ends: DataFrame, end: str, counts: str, most: int, keys: Sequence[str], ts: str, strict: bool) -> DataFrame:
    """The last stored rows of each series up to its ``end``, as many as ``counts`` says, ``most`` at most.

    The bound on the rank is a constant, so each task keeps ``most`` rows of a series before any row moves.
    """
    back = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    before = F.col(ts) < F.col(end) if strict else F.col(ts) <= F.col(end)
    ranked = store.join(ends, list(keys)).filter(before).withColumn("_r", F.row_number().over(back))
    return ranked.filter(F.col("_r") <= most).filter(F.col("_r") <= F.col(counts)).drop("_r")


def validate_window(
    batch: DataFrame,
    store: DataFrame,
    targets: DataFrame,
    values: Sequence[str] = VALUES,
    tolerance: float = TOLERANCE,
    ts: str = "bar_ts",
    keys: Sequence[str] = KEYS,
    step: int | Column = 3600,
    most: int | None = None,
) -> DataFrame:
    """Per row of ``targets`` (keys, target): ok, reason, validated.

    The batch without its last row is aligned with as many last store rows before the target. The
    first reason that applies, in this order: no batch, last row isn't the target, no history
    (which is fine), not hourly (``step`` seconds), store too short, times differ, a column with NaN
    differences only, a column off by more than the tolerance. ``most`` bounds the rows of a
    series in the batch; if it isn't given, one small job counts them.
    """
    on = list(keys)
    b = batch.join(targets, on).select(*on, ts, "target", *values)
    size = b.groupBy(*on).agg(F.count("*").alias("n"), F.max(ts).alias("last"))
    if most is None:
        most = size.agg(F.max("n")).first()[0] or 1
    gaps = quality.gap_count(b.select(*on, ts), keys, ts, step).select(*on, "gaps")
    history = b.join(size, on).filter(F.col(ts) < F.col("last"))
    ends = targets.join(size.select(*on, (F.col("n") - 1).alias("_n")), on)
    tail = last_stored(store, ends, "target", "_n", max(most - 1, 1), keys, ts, strict=True)
    sides = both_sides(history, tail, values, keys, ts)
    facts = [F.count_if("in_right").alias("stored"), F.count_if(F.col("in_left") != F.col("in_right")).alias("apart")]
    facts += [F.max(difference(F.col(f"l_{v}"), F.col(f"r_{v}"))).alias(f"d_{v}") for v in values]
    per = sides.groupBy(*on).agg(*facts)
    x = targets.join(size, on, "left").join(gaps, on, "left").join(per, on, "left")
    history_size = F.col("n") - 1
    reason = (
        F.when(F.col("n").isNull(), "empty batch")
        .when(F.col("last") != F.col("target"), "last row is not the target")
        .when(history_size == 0, "no history")
        .when(F.col("gaps") > 0, "not hourly")
        .when(F.coalesce("stored", F.lit(0)) < history_size, "store too short")
        .when(F.col("apart") > 0, "times differ")
    )
    for v in values:
        reason = reason.when(F.col(f"d_{v}").isNull(), f"NaN in {v}").when(F.col(f"d_{v}") > tolerance, f"mismatch in {v}")
    x = x.withColumn("reason", reason.otherwise("validated"))
    ok = F.col("reason").isin("validated", "no history")
    return x.select(*on, ok.alias("ok"), "reason", F.when(F.col("reason") == "validated", history_size).otherwise(0).cast("long").alias("validated"))


def validate_overlap(
    batch: DataFrame,
    store: DataFrame,
    tail_rows: int = 72,
    values: Sequence[str] = VALUES,
    tolerance: float = TOLERANCE,
    ts: str = "bar_ts",
    keys: Sequence[str] = KEYS,
    step: int | Column = 3600,
    held: DataFrame | None = None,
) -> DataFrame:
    """Per series of the batch: its times that are in the last stored rows, validated at the last of them.

    On top of ``validate_window`` the values at that time are compared. A series that the store
    doesn't hold is fine; one of which it holds later rows only has no overlap. ``held`` (keys of the
    stored series) spares a scan, where a summary has them. The store's tail is read once: it holds
    all rows that the window can be compared with, so it is written to the shared folder and serves
    each of its uses.
    """
    on = list(keys)
    last = batch.groupBy(*on).agg(F.max(ts).alias("last"))
    tail = written(last_stored(store, last.withColumn("_n", F.lit(tail_rows)), "last", "_n", tail_rows, keys, ts, strict=False).select(*on, ts, *values), "tail")
    held = (store if held is None else held).join(last.select(*on), on, "left_semi").select(*on).distinct().withColumn("held", F.lit(True))
    common = batch.join(tail.select(*on, ts), [*on, ts], "left_semi")
    targets = common.groupBy(*on).agg(F.max(ts).alias("target"))
    verdict = validate_window(common, tail, targets, values, tolerance, ts, keys, step, most=tail_rows)
    at = both_sides(common.join(targets, on).filter(F.col(ts) == F.col("target")), tail, values, keys, ts).filter("in_left and in_right")
    off = F.lit(False)
    for v in values:
        off |= F.coalesce(difference(F.col(f"l_{v}"), F.col(f"r_{v}")) > tolerance, F.lit(False))
    at = at.select(*on, off.alias("off"))
    x = last.select(*on).join(held, on, "left").join(verdict, on, "left").join(at, on, "left")
    reason = F.when(F.col("held").isNull(), "empty store").when(F.col("reason").isNull(), "no overlap").when(F.col("ok") & F.col("off"), "mismatch at target").otherwise(F.col("reason"))
    x = x.withColumn("reason", reason)
    ok = F.col("reason").isin("validated", "no history", "empty store")
    validated = F.when(F.col("reason") == "validated", F.col("validated")).otherwise(F.lit(0)).cast("long")
    return x.select(*on, ok.alias("ok"), "reason", validated.alias("validated"))


def target_check(batch: DataFrame, target: Column, ts: str = "bar_ts", keys: Sequence[str] = KEYS) -> DataFrame:
    """Per series: its last closed bar and whether it is the target hour."""
    return batch.groupBy(*keys).agg(F.max(ts).alias("last_closed")).withColumn("at_target", F.col("last_closed") == target)
