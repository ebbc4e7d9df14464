"""Operator 8: variable-capacity best-fit packing of token ids.

Texts are tokenised by a public vocabulary; texts longer than the largest capacity are cut into
pieces of that length and a rest. Pieces go in decreasing length to the open bin with the least
room that holds them. Where none does, a bin is opened in the permitted capacity whose cost per
token filled is least: cost is ``capacity * (1 + capacity / attention) + overhead`` and the expected
filling is the piece plus the smaller pieces that still fit beside it, so all capacities compete at
each opening. At the end each bin shrinks to the smallest permitted capacity that holds its contents.

Packing a subset of pieces is as good as packing all once it holds some thousands. So texts are
dealt by a hash of id and text to groups of about ``group_bytes``, as many as the bytes of the
corpus need (one number to the driver), and each group is packed as a whole: one shuffle, memory
of one group, and a result that depends on the rows alone, not on how files split them. Rows that
repeat in full more than ``MANY`` times are dealt by their number, so no group gets much more than
its share; fewer share a group.

A row is a bin: its token ids, and for each piece in order the document, the piece's number, its
first token in the document and its length.

Defined results: a null, empty or otherwise tokenless text gets one row without a bin, with no
tokens. Of pieces of one length, the one with the smaller id, then text hash, goes first; null ids
last. Repeated rows and ids are packed as separate pieces. A very long text is many pieces of one
group, which then holds it beside its own bytes. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .tokens import VOCABULARY, encoded, encoding_of, shared_vocabulary

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 64
ATTENTION = 16_384
GROUP_BYTES = 4_000_000
#: Rows that repeat in full up to so many times share a group.
MANY = 64
#: Texts that are tokenised at a time.
AT_ONCE = 200


def best_fit(lengths: np.ndarray, capacities=CAPACITIES, overhead: float = OVERHEAD, attention: float = ATTENTION) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin and bin capacity of each piece; lengths are from 1 to the largest capacity."""
    capacities = sorted(capacities)
    cost = {c: c * (1 + c / attention) + overhead for c in capacities}
    upto = np.cumsum(np.bincount(lengths, minlength=capacities[-1] + 1) * np.arange(max(capacities[-1], int(lengths.max(initial=0))) + 1)).tolist()
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[int] = []  # distinct rooms of open bins, sorted
    waiting: dict[int, list[int]] = {}
    used: list[int] = []
    capacity: list[int] = []

    def put(b: int) -> None:
        room = capacity[b] - used[b]
        if room:
            if room not in waiting:
                insort(rooms, room)
                waiting[room] = []
            waiting[room].append(b)

    for i in np.argsort(-lengths, kind="stable").tolist():
        x = int(lengths[i])
        at = bisect_left(rooms, x)
        if at < len(rooms):
            b = waiting[rooms[at]].pop()
            if not waiting[rooms[at]]:
                del waiting[rooms.pop(at)]
        else:
            fill = lambda c: x + min(c - x, upto[min(c - x, x - 1)])  # noqa: B023, E731
            c = min((c for c in capacities if c >= x), key=lambda c: (cost[c] / fill(c), c))
            b = len(used)
            used.append(0)
            capacity.append(c)
        bins[i], offsets[i] = b, used[b]
        used[b] += x
        put(b)
    final = np.array([capacities[bisect_left(capacities, u)] for u in used], dtype=np.int64)
    return bins, offsets, final[bins] if len(bins) else bins


def dealt_rows(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, doc_key, text_key, text and ``group``; rows that repeat in full more than MANY times differ in the group."""
    keyed = C.with_key(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, round(size / group_bytes))
    of = lambda *more: F.pmod(F.xxhash64("doc_key", "text_key", *more), F.lit(groups)).alias("group")
    key = ["doc_key", "text_key"]
    again = C.materialise(keyed.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > MANY), "again")
    columns = ["doc_id", *key, "text"]
    if again.isEmpty():
        return keyed.select(*columns, of())
    copies = keyed.join(again, key).dropDuplicates(key).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return keyed.join(again, key, "left_anti").select(*columns, of()).unionByName(copies.select(*columns, of("copy")))


def pack(docs: DataFrame, capacities=CAPACITIES, group_bytes: int = GROUP_BYTES, overhead: float = OVERHEAD, attention: float = ATTENTION, vocabulary: str = VOCABULARY) -> DataFrame:
    """bin_id, capacity, n_tokens, doc_ids, pieces, starts (tokens), lengths, token_ids."""
    largest = max(capacities)
    shared = shared_vocabulary(docs.sparkSession, vocabulary)
    names = ["bin_id", "capacity", "n_tokens", "doc_ids", "pieces", "starts", "lengths", "token_ids"]

    def packed(group, ids, sizes, tokens):
        """All bins of a group: ``ids`` and ``sizes`` of its texts, whose token ids follow each other in ``tokens``."""
        sizes, begin = np.array(sizes, dtype=np.int64), np.append(0, np.cumsum(sizes)).astype(np.int64)
        pieces = np.maximum(1, -(-sizes // largest))
        row = np.repeat(np.arange(len(ids)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * largest
        n = np.minimum(sizes[row] - start, largest)
        full = np.flatnonzero(n > 0)
        bins, offsets, capacity = best_fit(n[full], capacities, overhead, attention)
        order = full[np.lexsort((offsets, bins))]
        owners = np.sort(bins)
        first = np.flatnonzero(np.append(True, owners[1:] != owners[:-1])) if len(bins) else np.zeros(0, np.int64)
        size_of = np.zeros(len(first), np.int64)
        size_of[bins] = capacity
        # tokenless texts come last, a row each
        empty = np.flatnonzero(n <= 0)
        order, cut = np.append(order, empty), np.append(first, np.arange(len(full), len(full) + len(empty) + 1))
        source = np.repeat(begin[row[order]] + start[order], n[order]) + np.arange(n.sum()) - np.repeat(np.cumsum(n[order]) - n[order], n[order])
        ends = np.append(0, np.cumsum(n[order]))[cut]
        lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x, pa.int64())) for x in ([ids[r] for r in row[order]], piece[order], start[order], n[order])]
        for lo in range(0, len(cut) - 1, 1000):
            hi = min(lo + 1000, len(cut) - 1)
            called = [f"{group}-{b}" if b < len(first) else None for b in range(lo, hi)]
            room = [int(size_of[b]) if b < len(first) else None for b in range(lo, hi)]
            own = [x.slice(lo, hi - lo) for x in lists]
            words = pa.ListArray.from_arrays(pa.array(ends[lo : hi + 1] - ends[lo], pa.int32()), pa.array(tokens[source[ends[lo] : ends[hi]]], pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(called, pa.string()), pa.array(room, pa.int64()), pa.array(np.diff(ends[lo : hi + 1]), pa.int64()), *own, words], names)

    def run(batches):
        encoding, _ = encoding_of(shared.value)
        name, ids, sizes, tokens = None, [], [], []
        for batch in batches:
            for lo in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(lo, AT_ONCE)
                flat, own_sizes = encoded(encoding, part.column("text"))
                bounds = np.append(0, np.cumsum(own_sizes)).astype(np.int64)
                groups, own = part.column("group").to_pylist(), part.column("doc_id").to_pylist()
                i = 0
                while i < len(groups):
                    j = i
                    while j < len(groups) and groups[j] == groups[i]:
                        j += 1
                    if groups[i] != name:
                        if ids:
                            yield from packed(name, ids, sizes, np.concatenate(tokens))
                        name, ids, sizes, tokens = groups[i], [], [], []
                    ids += own[i:j]
                    sizes += own_sizes[i:j]
                    tokens.append(flat[bounds[i] : bounds[j]])
                    i = j
        if ids:
            yield from packed(name, ids, sizes, np.concatenate(tokens))

    rows = dealt_rows(docs, group_bytes).repartition("group").sortWithinPartitions("group", "doc_key", "text_key").select("group", "doc_id", "text")
    return C.map_arrow(rows, run, "bin_id string, capacity long, n_tokens long, doc_ids array<long>, pieces array<long>, starts array<long>, lengths array<long>, token_ids array<int>")


def op8_best_fit_packing(spark, sf_dir):
    return pack(C.documents(spark, sf_dir))
