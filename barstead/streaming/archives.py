"""Archives as a stream, and validated ingest with quarantine.

The progress of the stream is the ledger of taken archives: a later run unzips what landed since and
nothing else. Each batch is unzipped once, to a table of its lines' rows beside the progress, which then
serves the append and the report on archives.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import schemas
from ..operators import store as st
from ..operators.kept import KeptStore
from ..sources import archives

BINARY = "path string, modificationTime timestamp, length long, content binary"


def landed_archives(spark: SparkSession, path: str, glob: str = "*.zip", files_per_batch: int | None = None) -> DataFrame:
    """A stream of (file, content) of the archives that land under a path."""
    source = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", glob)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return source.load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def bars_of(lines: DataFrame) -> DataFrame:
    """Klines under the names and types of the stores, with the series of the archive's name."""
    rows = schemas.canonical(archives.klines_of(lines))
    ms = S.epoch_ms(F.col("open_time").cast("string"))
    return archives.parse_names(rows).withColumns({"interval": F.col("kind"), "bar_ts": S.from_ms(ms)})


def run_to_end(stream: DataFrame, batch: Callable[[DataFrame, int], None], work: str) -> None:
    """Take up all that has landed, then stop; ``work`` keeps the progress."""
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{work}/progress").trigger(availableNow=True).start().awaitTermination()


def ingest_archives(stream: DataFrame, store: KeptStore, work: str, shape: Callable[[DataFrame], DataFrame] = bars_of, policy: str = "absent") -> DataFrame:
    """Append the rows of newly landed archives (file, content), the first of repeated bars by (file, line_no); the store comes back.

    ``shape`` makes rows of lines and keeps ``file`` and ``line_no``.
    """
    spark, name = store.spark, f"{zlib.crc32(work.encode()):08x}"

    def batch(taken: DataFrame, number: int) -> None:
        at = f"{work}/lines/{number}"
        if not st.exists(spark, f"{at}/_SUCCESS"):
            archives.zip_lines(taken, tell_empty=True).write.mode("overwrite").parquet(at)
        lines = spark.read.schema("file string, line_no long, line string").parquet(at)
        told = F.max(F.when(F.col("line_no") >= 0, "taken").when(F.col("line_no") == -1, "damaged").otherwise("no CSV member"))
        lines.groupBy("file").agg(told.alias("state"), F.count_if(F.col("line_no") >= 0).alias("lines")).write.mode("overwrite").parquet(f"{work}/taken/batch={number}")
        store.append(shape(lines), policy, ("file", "line_no"), name=f"{name}-{number}")

    run_to_end(stream, batch, work)
    return store.read()


def taken_archives(spark: SparkSession, work: str) -> DataFrame:
    """(file, state, lines, batch) of all archives taken so far; state is ``taken``, ``damaged`` or ``no CSV member``."""
    return spark.read.schema("file string, state string, lines long, batch long").parquet(f"{work}/taken")


def ingest_validated(stream: DataFrame, store: KeptStore, work: str, tail_rows: int = 72, step: int | Column = 3600, order: tuple[str, ...] | None = None) -> DataFrame:
    """Append the newer rows of series whose overlap with the store is sound; rows of the others land in quarantine with the reason. The store comes back.

    Both sinks go by the batch's number: one that comes again replaces its quarantine and repeats its append.
    """
    spark, name = store.spark, f"{zlib.crc32(work.encode()):08x}"
    on = list(store.keys)

    def batch(rows: DataFrame, number: int) -> None:
        at = f"{work}/rows/{number}"
        if not st.exists(spark, f"{at}/_SUCCESS"):
            own = st.unique_rows(rows, [*on, store.ts], order)
            verdict = store.validate_overlap(own, tail_rows, step=step).select(*on, "ok", "reason")
            own.join(verdict, on).write.mode("overwrite").parquet(at)
        judged = spark.read.parquet(at)
        judged.filter("not ok").drop("ok").write.mode("overwrite").parquet(f"{work}/quarantine/batch={number}")
        store.append(judged.filter("ok"), "newer", order, name=f"{name}-{number}")

    run_to_end(stream, batch, work)
    return store.read()


def quarantined(store: KeptStore, work: str) -> DataFrame:
    """The rows held back so far: the store's columns, reason, batch."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in store.schema.fields)
    return store.spark.read.schema(f"{kinds}, reason string, batch long").parquet(f"{work}/quarantine")
