"""A store by day whose days are bucketed and sorted by series, so that what joins or groups it by series moves no stored row.

The files lie under a path; the table that tells their layout is declared in the session's catalog, where it isn't yet.
A day of a bucket is one file of an append, or several where its size asks for more writers, so neither a whole
day nor a series passes through one writer. Buckets are few and fixed: choose their number by the cores that read.

A task reads a bucket of all days asked for. The layout suits stores whose series are alike in size, as bars of one
interval are; a store in which one series holds a third of all rows belongs in a ``KeptStore``, which splits it by day.

Joins by (series, time) use the layout only if the session lets a side be parted by some of the join's keys:
``by_series`` sets that (``spark.sql.requireAllClusterKeysForCoPartition``). It changes plans, never results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store as st

BUCKETS = 16


def by_series(spark: SparkSession) -> None:
    """Let joins by (series, time) use a layout by series."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


@dataclass(frozen=True)
class BucketedStore:
    """``schema`` has the store's columns without ``day``; a series is its ``keys``. The number of buckets never changes for a path."""

    spark: SparkSession
    table: str
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ("symbol",)
    ts: str = "bar_ts"
    buckets: int = BUCKETS

    @property
    def _own(self) -> list[str]:
        return [*self.keys, self.ts]

    def declare(self) -> None:
        """The table over the path, and the days that lie there already, in this session's catalog."""
        if self.spark.catalog.tableExists(self.table):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        series, order = (", ".join(f"`{c}`" for c in cs) for cs in (self.keys, self._own))
        self.spark.sql(f"create table {self.table} ({columns}, day date) using parquet partitioned by (day) clustered by ({series}) sorted by ({order}) into {self.buckets} buckets location '{self.path}'")
        if st.folders(self.spark, self.path):
            self.spark.catalog.recoverPartitions(self.table)

    def read(self, days: Sequence[date] | None = None) -> DataFrame:
        """The stored rows; with ``days`` only their folders are listed and read."""
        self.declare()
        held = self.spark.table(self.table)
        return (held if days is None else held.filter(F.col("day").isin(list(days)))).drop("day")

    def delta(self, batch: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
        """Rows whose key isn't stored, each key once; only the days of the batch are looked into."""
        # dealt like the buckets: the one exchange of an append, which its dedupe and the join share
        rows = st.unique_rows(batch.dropna(subset=self._own).repartition(self.buckets, *self.keys), self._own, order)
        days = [x.day for x in batch.select(F.to_date(self.ts).alias("day")).distinct().filter("day is not null").collect()]
        return rows.join(self.read(days).select(*self._own), self._own, "left_anti")

    def append(self, batch: DataFrame, order: Sequence[str] | None = None) -> None:
        """Append absent keys; a repeated append adds nothing."""
        self.declare()
        rows = self.delta(batch, order).select(*self.schema.names, F.to_date(self.ts).alias("day"))
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        dealt = rows.withColumn("_bucket", bucket).hint("rebalance", "day", "_bucket").drop("_bucket")
        dealt.write.insertInto(self.table)
