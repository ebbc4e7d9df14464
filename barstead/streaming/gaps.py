"""Gap monitor: continuity of series on a stream, whatever the order of delivery.

State of a series is bounded by the delay: the times that have arrived and are later than the watermark, and
the last time before it. Each batch tells what changed (a gap opened, a gap closed by a late row);
once the watermark passes a time, its distance to the one before is final, and final gaps are those that
a batch computation over all rows finds. A timer tells a series that has gone silent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State of a series: last final time (microseconds), later times, whether its silence is told.
STATE = "last bigint, times array<bigint>, silent boolean"
OPENED, CLOSED, GAP, SILENT = "opened", "closed", "gap", "silent"


def holes(last: int | None, times: Sequence[int], step: int) -> list[tuple[int, int]]:
    """Neighbouring times that aren't ``step`` apart; repeated times are 0 apart."""
    return [(a, b) for a, b in pairwise([*([] if last is None else [last]), *times]) if b - a != step]


class GapMonitor(StatefulProcessor):
    def __init__(self, keys: Sequence[str], step: int, patience: int | None):
        self.keys, self.step, self.patience = list(keys), step, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, times, _ = self._held()
        before = holes(last, times, self.step)
        times = sorted([*times, *(int(x) for part in rows for x in part["us"])])
        after = holes(last, times, self.step)
        told = [(OPENED, h) for h in after if h not in before] + [(CLOSED, h) for h in before if h not in after]
        yield from self._settle(key, last, times, False, timerValues, told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, *self._held(), timerValues, [])

    def _held(self) -> tuple[int | None, list[int], bool]:
        if not self.state.exists():
            return None, [], False
        last, times, silent = self.state.get()
        return last, list(times), silent

    def _settle(self, key, last, times, silent, timerValues, told):
        """Times that the watermark has passed become final; timers for the next one and for silence."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        final = [t for t in times if t <= passed]
        told += [(GAP, h) for h in holes(last, final, self.step)]
        times = times[len(final) :]
        last = final[-1] if final else last
        newest = times[-1] if times else last
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if times:
            self.handle.registerTimer(-(-times[0] // 1000))
        if self.patience is not None and newest is not None and not silent:
            if newest + self.patience <= passed:
                silent = True
                told.append((SILENT, (newest, None)))
            else:
                self.handle.registerTimer(-(-(newest + self.patience) // 1000))
        self.state.update((last, times, silent))
        if told:
            out = pd.DataFrame({k: [v] * len(told) for k, v in zip(self.keys, key, strict=True)})
            yield out.assign(kind=[k for k, _ in told], prev_us=pd.array([h[0] for _, h in told], "Int64"), us=pd.array([h[1] for _, h in told], "Int64"))

    def close(self) -> None:
        pass


def watch(stream: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "bar_ts", step: int = 3600, delay: str = "1 day", patience: int | None = None) -> DataFrame:
    """Stream of keys, kind, prev_ts, ts, diff_s: gaps opened, closed and final, and series without a row for ``patience`` seconds.

    ``step`` in seconds. Rows later than ``delay`` behind the newest time are dropped, as is a row without time or key.
    """
    names = list(keys)
    rows = stream.dropna(subset=[*names, ts]).select(*names, F.col(ts).cast("timestamp").alias("_t")).withWatermark("_t", delay)
    rows = rows.withColumn("us", F.unix_micros("_t"))
    out = T.StructType([*(rows.schema[k] for k in names), T.StructField("kind", T.StringType()), T.StructField("prev_us", T.LongType()), T.StructField("us", T.LongType())])
    monitor = GapMonitor(names, step * 1_000_000, None if patience is None else patience * 1_000_000)
    told = rows.groupBy(*names).transformWithStateInPandas(monitor, out, "Append", "EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return told.select(*names, "kind", at("prev_us").alias("prev_ts"), at("us").alias("ts"), F.expr("(us - prev_us) div 1000000").alias("diff_s"))


#: Timers and state of this kind need this store.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def watch_to_end(spark: SparkSession, watched: DataFrame, out: str, work: str) -> DataFrame:
    """Take up all that has landed, add what is told to the table at ``out`` and return it. State carries over to the next run."""
    held = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        watched.writeStream.format("parquet").option("path", out).option("checkpointLocation", work).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(PROVIDER[0]) if held is None else spark.conf.set(PROVIDER[0], held)
    return spark.read.schema(watched.schema).parquet(out)
