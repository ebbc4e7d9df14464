"""Shared pieces: table access, shared-folder materialisation, vectorised word splitting and hashing.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of a text. The numpy helpers work on the byte
buffer of an Arrow string column, so one call handles all texts of a batch.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text whose words are held in arrays at a time.
CHUNK_BYTES = 2_000_000

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RNG = np.random.default_rng(20240117)
_TABLE = _RNG.integers(0, 2**64, size=(32 * 256,), dtype=np.uint64)
_FAR = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Folders that ``materialise`` has written in this process.
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where it is unset, a fresh one on this machine, which only a local master may use."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("spark.barstead.scratch", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.barstead.scratch", found)
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there, a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows that go to a Python worker at a time. With Spark's 64 MB, a batch of texts, its copies in the JVM and in Python and the sets of its words took most of what an executor's heap leaves.
BATCH_BYTES = 4_000_000


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of ``BATCH_BYTES``; the session keeps that setting, since the plan runs later."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


@contextmanager
def passing(spark: SparkSession):
    """Folders that ``materialise`` writes inside go when the block ends: only what doesn't read them may leave it."""
    began = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[began:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _WRITTEN[began:]


def row_key(docs: DataFrame) -> dict[str, Column]:
    """``doc_key`` (null ids last) and ``text_key``, a hash of id and text.

    Rows that share a doc_id but not a text have different keys; fully repeated rows share one and get one result.
    """
    return {"doc_key": F.coalesce(docs["doc_id"].cast("long"), F.lit(2**63 - 1)), "text_key": F.xxhash64(docs["doc_id"], docs["text"])}


def with_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", *(e.alias(n) for n, e in row_key(docs).items()))


#: Row keys that a join may broadcast (about 10 MB); beyond, the same join shuffles.
BROADCAST_KEYS = 100_000


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose row key isn't in ``gone`` (doc_key, text_key)."""
    gone = materialise(gone.select("doc_key", "text_key").distinct(), "gone")
    few = gone.count() <= BROADCAST_KEYS
    keyed = docs.select("*", *(e.alias(f"_{n}") for n, e in row_key(docs).items()))
    match = (keyed["_doc_key"] == gone["doc_key"]) & (keyed["_text_key"] == gone["text_key"])
    return keyed.join(F.broadcast(gone) if few else gone, match, "left_anti").select(*docs.columns)


# ---------------------------------------------------------------- words in byte buffers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Ranges [i, j) of texts with about ``most`` bytes together, one text at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = j


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the n + 1 positions in these arrays at which the texts begin."""
    solid = ~_SPACES[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    first[inner] = solid[inner]
    last = np.zeros(len(raw) + 1, dtype=bool)
    last[1:] = solid
    last[1:-1] &= ~solid[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, segment: int = 4_000_000) -> np.ndarray:
    """64-bit hash of each word: sum of random table entries by (place in word, byte)."""
    out, i = np.empty(len(starts), dtype=np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + segment, side="right")))
        lo, hi = starts[i], ends[j - 1]
        begin = starts[i:j] - lo
        place = np.arange(hi - lo, dtype=np.int64) - np.repeat(begin, np.diff(np.append(begin, hi - lo)))
        part = _TABLE[((place & 31) << 8) | raw[lo:hi]]
        if (far := place > 31).any():
            part[far] *= mix((place[far] >> 5).astype(np.uint64) * _FAR) | np.uint64(1)
        part[_SPACES[raw[lo:hi]]] = 0
        out[i:j] = np.add.reduceat(part, begin) + (ends[i:j] - starts[i:j]).astype(np.uint64) * _FAR
        i = j
    return mix(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words, regardless of text bounds; len(words) - k + 1 of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total *= np.uint64(0x9FB21C651E98DF25)
        total += words[j : j + n]
    return mix(total)


def within(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Of n runs of k words, those that lie in one text."""
    ok = np.ones(n, dtype=bool)
    for back in range(1, k):
        at = bounds[1:-1] - back
        ok[at[(at >= 0) & (at < n)]] = False
    return ok
