"""Structured Streaming jobs: incremental ingest of landed files into the append-only store.

Re-delivery is harmless: each batch is deduplicated and anti-joined with the store's slice of its
days, so the store itself is the state and late rows fill interior holes. The first writer wins, by
the time at which a file landed, its name and the row's place in it. A batch is an append of a kept
store, named after stream and batch, so a batch that comes again after a failure appends what it decided
the first time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.kept import KeptStore

#: Where a row came from, beside the columns of the schema.
ORIGIN = {"_landed": "_metadata.file_modification_time", "_file": "_metadata.file_name", "_row": "_metadata.row_index"}


def ingest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    store_path: str,
    work: str,
    keys: Sequence[str] = ("symbol",),
    ts: str = "bar_ts",
    policy: str = "absent",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Read new Parquet files of ``landing`` until none is left, append their rows, return the store.

    ``policy``: ``absent`` appends each key that isn't stored, ``newer`` only what is later than
    the series' last stored time. ``transform`` runs on each batch first (closed bars, shapes) and
    keeps the columns that tell where a row came from. The store is partitioned by day.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    store = KeptStore(spark, store_path, schema, tuple(keys), ts)
    # appends of one stream have names of their own, the same when a batch comes again
    stream = f"{zlib.crc32(work.encode()):08x}"

    def batch(rows: DataFrame, number: int) -> None:
        rows = transform(rows) if transform else rows
        if not rows.isEmpty():
            store.append(rows, policy, list(ORIGIN), name=f"{stream}-{number}")

    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = source.parquet(landing).select("*", *(F.col(c).alias(n) for n, c in ORIGIN.items()))
    query = rows.writeStream.foreachBatch(batch).option("checkpointLocation", f"{work}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return store.read()


def dedupe_within(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Bounded-state variant: repeats within ``delay`` are dropped, and so are rows later than that."""
    timed = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    return timed.dropDuplicatesWithinWatermark([*keys, ts]).drop("_t")
