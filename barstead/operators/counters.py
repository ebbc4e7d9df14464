"""Counters that come out of the pass that writes, instead of a second scan.

What is counted is observed after the last exchange of the job, where each written partition counts once: map
tasks that run again after a lost executor, and speculative ones, don't count twice. Rows that aren't
written therefore travel up to there as counts of their key, not as rows.

Totals of a write are one row. Counters per series of an append stand in the kept store's summary (``KeptStore.appended``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import store as st

KEYS = ("symbol",)


def counted(rows: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """``rows``, and what will hold the counters once an action over them has succeeded."""
    seen = Observation()
    return rows.observe(seen, *(c.alias(n) for n, c in counters.items())), seen


def unique_with_counts(rows: DataFrame, own: Sequence[str], complete: Column, order: Sequence[str]) -> DataFrame:
    """One row per key: the first complete one in ``order`` (nulls where there is none), ``_n`` rows of the key, ``_good`` complete ones among them."""
    rest = [c for c in rows.columns if c not in own]
    first = F.min_by(F.struct(*rest), F.when(complete, F.struct(*order))).alias("_r")
    per = rows.groupBy(*own).agg(F.count("*").alias("_n"), F.count_if(complete).alias("_good"), first)
    return per.select(*(F.col(c) if c in own else F.col(f"_r.{c}") for c in rows.columns), "_n", "_good")


def write_clean(rows: DataFrame, path: str, required: Sequence[str], keys: Sequence[str] = KEYS, ts: str = "bar_ts", order: Sequence[str] = ("file", "line_no")) -> dict:
    """Append the first complete row of each key to a store by day, and count in the same pass.

    Gives n_rows, dropped_incomplete (a key, time or required column is null), dropped_duplicate, inserted, first_ts and last_ts;
    counts are 0 and times None for no rows.
    """
    own = [*keys, ts]
    complete = F.lit(True)
    for c in [*own, *required]:
        complete &= F.col(c).isNotNull()
    good = F.col("_good")
    with_day = st.by_day(unique_with_counts(rows, own, complete, order), ts)
    seen_rows, seen = counted(
        with_day,
        n_rows=F.sum("_n"),
        dropped_incomplete=F.sum(F.col("_n") - good),
        dropped_duplicate=F.sum(F.greatest(good - 1, F.lit(0))),
        inserted=F.count_if(good > 0),
        first_ts=F.min(F.when(good > 0, F.col(ts))),
        last_ts=F.max(F.when(good > 0, F.col(ts))),
    )
    seen_rows.filter("_good > 0").drop("_n", "_good").write.mode("append").partitionBy("day").parquet(path)
    got = seen.get
    return {c: got.get(c) or 0 for c in ("n_rows", "dropped_incomplete", "dropped_duplicate", "inserted")} | {c: got.get(c) for c in ("first_ts", "last_ts")}
