"""Append-only store: absent keys, newer keys, insert-or-ignore, last N, coverage, audit.

All return the rows to append; writing is ``write_append``. Callers pass ``bounds`` of the batch
so that only the matching slice of the store is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import schemas
from .quality import dedupe_first

KEYS = ("symbol",)


def batch_bounds(batch: DataFrame, ts: str = "bar_ts") -> tuple | None:
    """Smallest and largest time of a batch: one row to the driver."""
    row = batch.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    return None if row is None or row.lo is None else (row.lo, row.hi)


def _slice(store: DataFrame, ts: str, bounds: tuple | None) -> DataFrame:
    return store if bounds is None else store.filter(F.col(ts).between(F.lit(bounds[0]).cast("timestamp_ntz"), F.lit(bounds[1]).cast("timestamp_ntz")))


def unique_rows(batch: DataFrame, own: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per complete key, the first in ``order``; without one, the smallest in its other columns. Rows without a time or key go."""
    rest = [c for c in batch.columns if c not in own]
    return dedupe_first(batch.dropna(subset=list(own)), own, order or rest) if rest else batch.dropna(subset=list(own)).distinct()


def append_absent(batch: DataFrame, store: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts", order: Sequence[str] | None = None, bounds: tuple | None = None) -> DataFrame:
    """Rows whose key isn't stored, interior holes included, each key once (see ``unique_rows``)."""
    own = [*keys, ts]
    # rows without a time or key are never found in the store, and don't enter it
    return unique_rows(batch, own, order).join(_slice(store, ts, bounds).select(*own), own, "left_anti")


def append_newer(batch: DataFrame, store: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts", order: Sequence[str] | None = None, last: DataFrame | None = None) -> DataFrame:
    """Rows later than the series' last stored time, each key once; all of a series that isn't stored. Interior holes stay.

    ``last`` (keys, last_ts), as a kept summary has it, spares the scan of the store.
    """
    if last is None:
        last = store.groupBy(*keys).agg(F.max(ts).alias("last_ts"))
    rows = unique_rows(batch, [*keys, ts], order)
    return rows.join(last.select(*keys, F.col("last_ts").alias("_last")), list(keys), "left").filter(F.col("_last").isNull() | (F.col(ts) > F.col("_last"))).drop("_last")


def insert_or_ignore(
    batch: DataFrame,
    store: DataFrame,
    required: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = "bar_ts",
    order: Sequence[str] = ("file", "line_no"),
    bounds: tuple | None = None,
) -> DataFrame:
    """First writer wins, also within the batch; a row with null or NaN in a required column is ignored."""
    if not order:
        raise ValueError("the first writer needs an order")
    return append_absent(batch.dropna(subset=list(required)), store, keys, ts, order, bounds)


def write_append(rows: DataFrame, path: str, dataset: str | None = None, ts: str = "timestamp") -> None:
    """Append to a store that is partitioned by day; with ``dataset`` in that store's columns and types, rows without a required value left out.

    A day's rows are split over as many writers as their size asks for, and lie sorted by the columns before the time, so that a reader skips
    row groups of other series.
    """
    if dataset:
        rows = schemas.as_store(rows, dataset).dropna(subset=schemas.REQUIRED.get(dataset, []))
    if folders(rows.sparkSession, rewrite_mark(path)):
        raise ValueError(f"{path} is being rewritten: finish that first")
    by_day(rows, ts).write.mode("append").partitionBy("day").parquet(path)


def by_day(rows: DataFrame, ts: str) -> DataFrame:
    """Rows with their day, dealt to writers by size of the day, sorted by the columns before the time."""
    dealt = rows.withColumn("day", F.to_date(ts)).hint("rebalance", "day")
    return dealt.sortWithinPartitions("day", *rows.columns[: rows.columns.index(ts) + 1])


def rewrite_mark(path: str) -> str:
    """Holds a folder for an unfinished rewrite of the store."""
    return f"{path}.rewrite/unfinished"


def _at(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    fs, at = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory()) if fs.exists(at) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.mkdirs(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def read_store(spark: SparkSession, path: str, schema: T.StructType, bounds: tuple | None = None, ts: str = "timestamp") -> DataFrame:
    """The rows of such a store, or no rows before the first append; with ``bounds`` only the days between are listed and read."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    held = spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)
    if bounds:
        held = _slice(held.filter(F.col("day").between(F.lit(bounds[0]).cast("date"), F.lit(bounds[1]).cast("date"))), ts, bounds)
    return held.drop("day")


def last_n(store: DataFrame, n: int, keys: Sequence[str] = KEYS, ts: str = "bar_ts", before: str | None = None) -> DataFrame:
    """The last ``n`` rows of each series, strictly before ``before`` if given. Only n rows per task and series move."""
    rows = store if before is None else store.filter(F.col(ts) < F.lit(before).cast("timestamp_ntz"))
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def latest_row(store: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    rest = [c for c in store.columns if c not in keys]
    return store.groupBy(*keys).agg(F.max_by(F.struct(*rest), ts).alias("_r")).select(*keys, "_r.*")


def coverage(store: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    return store.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("n_rows"))


def unique_key_audit(store: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    """Keys stored more than once."""
    return store.groupBy(*keys, ts).agg(F.count("*").alias("copies")).filter("copies > 1")


def migrate_snapshot(store: DataFrame, ts: str = "bar_ts", interval: str = "1 hour") -> DataFrame:
    """Fill ``snapshot_time`` where it is null or the column is missing."""
    end = F.col(ts) + F.expr(f"interval {interval}")
    return store.withColumn("snapshot_time", F.coalesce("snapshot_time", end) if "snapshot_time" in store.columns else end)


def append_summary(delta: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bar_ts") -> DataFrame:
    """Per series what an append inserts: count and range."""
    return delta.groupBy(*keys).agg(F.count("*").alias("inserted"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
