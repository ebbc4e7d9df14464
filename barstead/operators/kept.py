"""A day-partitioned store with a kept summary: first time, last time and rows of each series and day.

The summary lies beside the store, one entry per append, and is small: a row per series and day.
Appends and validations take their bounds from it, so they read the days that they need and never the
store's history: the last stored time (append newer), the days that hold the last n rows of a series
(window and overlap validation, catch-up), whether anything is stored before a time (append target),
and coverage.

An append has a name. Its rows are first written beside the store, then appended, then summed up; each of
these can be repeated under the same name after a failure: what is stored already isn't appended
again, and the summary's entry is replaced, not added.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import reconcile as r
from . import store as st


def summed(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Per series and day: first_ts, last_ts, n_rows."""
    return rows.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("n_rows"))


@dataclass(frozen=True)
class KeptStore:
    """``schema`` has the store's columns without ``day``; a series is its ``keys``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ("symbol",)
    ts: str = "bar_ts"

    @property
    def _own(self) -> list[str]:
        return [*self.keys, self.ts]

    # ------------------------------------------------------------ summary

    def summary(self, without: str | None = None) -> DataFrame:
        """Per series and day: first_ts, last_ts, n_rows, over all appends but the one named. A store without one gets it from its rows."""
        path = f"{self.path}.summary"
        if not st.exists(self.spark, path):
            if not st.exists(self.spark, self.path):
                return summed(self.spark.createDataFrame([], self.schema), self.keys, self.ts)
            self.rebuild()
        fields = [self.schema[k] for k in self.keys] + [T.StructField("day", T.DateType())]
        fields += [T.StructField(c, self.schema[self.ts].dataType) for c in ("first_ts", "last_ts")] + [T.StructField("n_rows", T.LongType())]
        log = self.spark.read.schema(T.StructType([*fields, T.StructField("append", T.StringType())])).parquet(path)
        if without is not None:
            log = log.filter(F.col("append") != without)
        return log.groupBy(*self.keys, "day").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_rows").alias("n_rows"))

    def coverage(self, without: str | None = None) -> DataFrame:
        """Per series: first_ts, last_ts, n_rows, without reading the store."""
        return self.summary(without).groupBy(*self.keys).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_rows").alias("n_rows"))

    def appended(self, name: str) -> DataFrame:
        """Per series what the append of that name put in, from its entry: inserted, first_ts, last_ts. Neither the rows nor the store are read."""
        log = self.spark.read.parquet(f"{self.path}.summary").filter(F.col("append") == name)
        return log.groupBy(*self.keys).agg(F.sum("n_rows").alias("inserted"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def rebuild(self) -> None:
        """The summary anew, as one entry, from the rows of the store. Earlier entries go."""
        rows = summed(self.read(), self.keys, self.ts)
        rows.withColumn("append", F.lit("rebuilt")).write.mode("overwrite").partitionBy("append").parquet(f"{self.path}.summary")

    def compact(self) -> None:
        """All entries of the summary as one."""
        new = f"{self.path}.delta/summary-{uuid.uuid4().hex}"
        self.summary().write.parquet(new)
        again = self.spark.read.parquet(new).withColumn("append", F.lit("compacted"))
        again.write.mode("overwrite").partitionBy("append").parquet(f"{self.path}.summary")

    def unequal_days(self) -> DataFrame:
        """Series and days of which the summary and the store tell different things: none unless someone wrote past this class."""
        both = self.summary().withColumn("_s", F.lit(1)).unionByName(summed(self.read(), self.keys, self.ts).withColumn("_s", F.lit(-1)))
        per = both.groupBy(*self.keys, "day", "first_ts", "last_ts", "n_rows").agg(F.sum("_s").alias("_s"))
        return per.filter("_s <> 0").select(*self.keys, "day").distinct()

    # ------------------------------------------------------------ reading

    def read(self, days: Sequence[date] | None = None) -> DataFrame:
        """The stored rows; with ``days`` only their folders are listed and read."""
        if not st.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        held = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("day", T.DateType())])).parquet(self.path)
        return (held if days is None else held.filter(F.col("day").isin(list(days)))).drop("day")

    def days_of_tails(self, ends: DataFrame, end: str, n: int) -> list[date]:
        """The days that hold the last ``n`` rows of each series up to its ``end``; at most the days of the calendar go to the driver.

        A row of ``ends`` is a series. The end's own day counts for nothing, since its rows may lie after the end.
        """
        back = Window.partitionBy(*self.keys).orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, -1)
        last = F.to_date(end)
        own = self.summary().join(ends.select(*self.keys, end), list(self.keys)).filter(F.col("day") <= last)
        later = F.coalesce(F.sum(F.when(F.col("day") < last, F.col("n_rows")).otherwise(0)).over(back), F.lit(0))
        return sorted(x.day for x in own.withColumn("_later", later).filter(F.col("_later") < n).select("day").distinct().collect())

    def tails(self, ends: DataFrame, end: str, n: int) -> DataFrame:
        """Rows among which are the last ``n`` of each series up to its ``end``."""
        return self.read(self.days_of_tails(ends, end, n))

    # ------------------------------------------------------------ appending

    def append(self, batch: DataFrame, policy: str = "absent", order: Sequence[str] | None = None, name: str | None = None) -> DataFrame:
        """Append what the policy lets in, ``absent`` or ``newer``, each key once; the appended rows come back.

        Under a ``name`` that was used before, the rows decided then are appended, whatever ``batch`` now holds.
        """
        delta = f"{self.path}.delta/{name or uuid.uuid4().hex}"
        if not st.exists(self.spark, f"{delta}/_SUCCESS"):
            fresh = self.delta(batch, policy, order)
            fresh.select(*self.schema.names).write.mode("overwrite").parquet(delta)
        rows = self.spark.read.schema(self.schema).parquet(delta)
        days = [x.day for x in rows.select(F.to_date(self.ts).alias("day")).distinct().collect()]
        st.write_append(rows.join(self.read(days).select(*self._own), self._own, "left_anti"), self.path, ts=self.ts)
        entry = summed(rows, self.keys, self.ts)
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}.summary/append={delta.rsplit('/', 1)[1]}")
        return rows

    def delta(self, batch: DataFrame, policy: str = "absent", order: Sequence[str] | None = None) -> DataFrame:
        """What ``append`` would insert; nothing is written."""
        if policy == "newer":
            return st.append_newer(batch, batch, self.keys, self.ts, order, last=self.coverage())
        if policy != "absent":
            raise ValueError(f"no such policy: {policy}")
        rows = st.unique_rows(batch, self._own, order)
        # only days that the summary knows are looked into
        days = rows.select(*self.keys, F.to_date(self.ts).alias("day")).join(self.summary().select(*self.keys, "day"), [*self.keys, "day"], "left_semi")
        held = self.read([x.day for x in days.select("day").distinct().collect()])
        return rows.join(held.select(*self._own), self._own, "left_anti")

    # ------------------------------------------------------------ validating

    def validate_window(self, batch: DataFrame, targets: DataFrame, values: Sequence[str] = r.VALUES, tolerance: float = r.TOLERANCE, step: int | Column = 3600, most: int | None = None) -> DataFrame:
        """``reconcile.validate_window`` against this store; ``most`` rows of a series in the batch, or one small job counts them."""
        if most is None:
            most = batch.join(targets, list(self.keys)).groupBy(*self.keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
        return r.validate_window(batch, self.tails(targets, "target", most), targets, values, tolerance, self.ts, self.keys, step, most)

    def validate_overlap(self, batch: DataFrame, tail_rows: int = 72, values: Sequence[str] = r.VALUES, tolerance: float = r.TOLERANCE, step: int | Column = 3600) -> DataFrame:
        last = batch.groupBy(*self.keys).agg(F.max(self.ts).alias("last"))
        return r.validate_overlap(batch, self.tails(last, "last", tail_rows), tail_rows, values, tolerance, self.ts, self.keys, step, held=self.coverage())
