"""Operator 6: exact dedup by content-defined chunk recipes.

Texts are normalised (each run of white space becomes one space) and cut where a hash of eight
neighbouring bytes hits a mask, so equal passages give equal chunks wherever they stand. Each
distinct chunk travels once, keyed by a 64-bit identifier; identifiers under which two different
contents arrive are found by comparing contents and replaced by a longer digest of these chunks
alone. A text is then its ordered list of verified identifiers, and only the lists are compared.

Skew: chunks are reduced in each batch and in each task before they move; the group table has
one row per list, so a text that holds a third of all rows is a number in each task's partial
aggregate, and the join back to the rows is one that Spark can split.

Defined results: a null text is the empty text. Null ids come last; a group of null ids alone
keeps its null-id rows. Rows that repeat both id and text share one verdict, ``keep_first`` lets one
of them stay. A very long text is cut into many chunks in one task. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MASK_BITS = 11
MAX_CHUNK = 16_384


def normalised(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets after each run of white space is one space."""
    blank = C._SPACES[raw]
    again = np.zeros(len(raw), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    again[inner] = False
    keep = ~again
    out = np.where(blank, np.uint8(0x20), raw)[keep]
    return out, np.append(0, np.cumsum(keep))[offsets]


def cuts(raw: np.ndarray, offsets: np.ndarray, mask_bits: int = MASK_BITS, max_chunk: int = MAX_CHUNK) -> np.ndarray:
    """Sorted ends of chunks, each text's end among them; bytes of neighbouring texts never decide."""
    n = len(raw)
    found = np.zeros(n + 1, dtype=bool)
    if n >= 8:
        b = raw.astype(np.uint32)
        four = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
        roll = four[:-4] * np.uint32(0x9E3779B1) + four[4:] * np.uint32(0x85EBCA77)
        roll = (roll ^ (roll >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        hit = np.flatnonzero(roll >> np.uint32(32 - mask_bits) == 0) + 8
        begin = offsets[np.searchsorted(offsets, hit - 1, side="right") - 1]
        found[hit[hit - begin >= 8]] = True
    found[offsets[1:]] = True
    found[0] = False
    ends = np.flatnonzero(found)
    starts = np.append(0, ends[:-1])
    long = np.flatnonzero(ends - starts > max_chunk)
    extra = [np.arange(starts[i] + max_chunk, ends[i], max_chunk) for i in long]
    return np.sort(np.concatenate([ends, *extra])) if extra else ends


def pieces(column: pa.Array):
    """(index of the text, its normalised bytes, its chunks) for each text of a batch."""
    raw_all, offsets_all = C.text_buffer(column)
    for i, j in C.chunks(offsets_all):
        raw, offsets = normalised(raw_all[offsets_all[i] : offsets_all[j]], offsets_all[i : j + 1] - offsets_all[i])
        ends = cuts(raw, offsets)
        data, at, ends = raw.tobytes(), np.searchsorted(ends, offsets, side="right"), ends.tolist()
        offsets = offsets.tolist()
        for d in range(j - i):
            begin, own = offsets[d], []
            for e in ends[at[d] : at[d + 1]]:
                own.append(data[begin:e])
                begin = e
            yield i + d, data[offsets[d] : offsets[d + 1]], own


def chunk_id(chunk: bytes) -> int:
    return xxhash.xxh3_64_intdigest(chunk) - 2**63


def ambiguous_ids(docs: DataFrame) -> list[int]:
    """Identifiers shared by different contents: about (chunks / 2**32)**2 / 2 of them, so a list even for 10**11 chunks."""

    def run(batches):
        for batch in batches:
            seen = {}
            for _, _, own in pieces(batch.column("text")):
                for c in own:
                    seen[c] = None
            if seen:
                yield pa.RecordBatch.from_pydict({"id": pa.array([chunk_id(c) for c in seen], pa.int64()), "content": pa.array(list(seen), pa.binary())})

    contents = C.map_arrow(docs.select("text"), run, "id long, content binary").groupBy("id", "content").agg(F.lit(1).alias("one"))
    return [r.id for r in contents.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id").collect()]


def recipes(docs: DataFrame, ambiguous: list[int]) -> DataFrame:
    """doc_id, text_key, recipe (ordered identifiers, eight bytes each; 32 for ambiguous ones) and text_sha256."""
    doubtful = frozenset(ambiguous)

    def name(chunk: bytes) -> bytes:
        x = chunk_id(chunk)
        return hashlib.sha256(chunk).digest() if x in doubtful else x.to_bytes(8, "big", signed=True)

    def run(batches):
        for batch in batches:
            lists, digests = [], []
            for _, text, own in pieces(batch.column("text")):
                lists.append(b"".join(map(name, own)))
                digests.append(hashlib.sha256(text).hexdigest())
            if lists:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "recipe": pa.array(lists, pa.binary()), "text_sha256": pa.array(digests)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", C.row_key(docs)["text_key"].alias("text_key"))
    return C.map_arrow(rows, run, "doc_id long, text_key long, recipe binary, text_sha256 string")


def keyed_groups(docs: DataFrame) -> DataFrame:
    rows = C.materialise(recipes(docs, ambiguous_ids(docs)), "recipes")
    groups = C.materialise(rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    return rows.join(groups, "recipe").select("doc_id", "text_key", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    return keyed_groups(docs).drop("text_key")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one per group of equal texts even where rows repeat."""
    verdicts = C.materialise(keyed_groups(docs), "verdicts")
    kept = C.without(docs, verdicts.filter("not kept").select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_key"), "text_key"))
    again = verdicts.filter("kept and group_size > 1").groupBy("text_sha256").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    return kept if again else kept.withColumn("_norm", F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), C.SPACE, " "), 256)).dropDuplicates(["doc_id", "_norm"]).drop("_norm")


def op6_exact_dedup(spark, sf_dir):
    return exact_groups(C.documents(spark, sf_dir))


OP6_SQL = """
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as n from documents),
  g as (select n, min(doc_id) as keep_id, count(*) as group_size from t group by n)
select t.doc_id, g.keep_id, g.group_size::bigint as group_size, t.doc_id = g.keep_id as kept, sha256(t.n) as text_sha256
from t join g using (n)
"""
