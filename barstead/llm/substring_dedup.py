"""Operator 5: substring dedup by super-k-mer partitioning.

A window is ``width`` consecutive words of one text. Its minimiser is the smallest hash among its
``gram``-word runs (leftmost on ties). Consecutive windows with one minimiser form a super-k-mer.

1. Each super-k-mer is announced by its minimiser alone (a few numbers, no text). Minimisers are
   counted with partial aggregation; one that occurs once holds no repeated window.
2. Super-k-mers of recurring minimisers travel as one packed string to the bucket of their
   minimiser. Sorting the windows of a bucket finds each window's first place in the corpus.
3. Ranges of first places return to their documents. A window of a recurring minimiser that is
   not a first place repeats an earlier one, and its words go.

Skew: a minimiser with more than ``hot`` super-k-mers is split: its windows travel singly to
buckets keyed by the window itself. Equal packed strings are reduced to the earliest place in each
task before they travel, and arrive sorted, so that a bucket passes over repeats one by one and
holds distinct strings only, ``hot`` of them at most. No window is left out.

Minimisers may collide, which costs time only: windows are compared as strings.

Defined results: null, empty and blank texts have no words and keep the empty string. Very long
texts are processed whole, as long as one fits a task's memory. Null ids count as larger than all
others. Rows with one id and different texts are ordered by a hash of the text; rows that repeat
id and text share one result. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WIDTH = 20
GRAM = 6
HOT = 4000
#: Windows of a super-k-mer at most; longer ones continue in a next one.
MOST = 48
#: Distinct packed strings that a task holds before it hands them on.
HELD = 20_000
KEY = ["doc_key", "text_key"]


def super_kmers(words: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """(minimiser, index of the text, start in the text, windows) of each super-k-mer, as arrays."""
    n = len(words) - width + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grams = C.gram_hashes(words, gram)
    reach = width - gram + 1
    low, have = grams, 1
    while have < reach:
        step = min(have, reach - have)
        low, have = np.minimum(low[: len(low) - step], low[step:]), have + step
    place = np.empty(n, dtype=np.int64)
    at = np.arange(n)
    for t in range(reach - 1, -1, -1):
        same = grams[t : t + n] == low
        place[same] = at[same] + t
    ok = np.flatnonzero(C.within(bounds, width, n))
    if not len(ok):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    fresh = np.append(True, (np.diff(ok) != 1) | (np.diff(place[ok]) != 0))
    opened = np.maximum.accumulate(np.where(fresh, np.arange(len(ok)), 0))
    fresh |= (np.arange(len(ok)) - opened) % MOST == 0
    first = np.flatnonzero(fresh)
    start = ok[first]
    text = np.searchsorted(bounds, start, side="right") - 1
    return low[start].view(np.int64), text, start - bounds[text], np.diff(np.append(first, len(ok)))


def announce(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """A row per super-k-mer: minimiser, row key and ``at`` = start * 64 + windows."""

    def run(batches):
        for batch in batches:
            raw_all, offsets_all = C.text_buffer(batch.column("text"))
            keys = [np.asarray(batch.column(k)) for k in KEY]
            for i, j in C.chunks(offsets_all):
                raw, offsets = raw_all[offsets_all[i] : offsets_all[j]], offsets_all[i : j + 1] - offsets_all[i]
                starts, ends, bounds = C.word_bounds(raw, offsets)
                low, text, start, n = super_kmers(C.word_hashes(raw, starts, ends), bounds, width, gram)
                if len(low):
                    yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(keys[0][i:j][text]), pa.array(keys[1][i:j][text]), pa.array(start * 64 + n)], ["minimiser", *KEY, "at"])

    return docs.mapInArrow(run, "minimiser long, doc_key long, text_key long, at long")


def _lists(column: pa.Array, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets and flat fields of a list<struct> column; null lists are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    flat = column.flatten()
    return np.append(0, np.cumsum(sizes)), [np.asarray(flat.field(f)) for f in fields]


def pack(located: DataFrame, width: int, held: int = HELD) -> DataFrame:
    """Packed strings with their bucket; of equal ones in a task, ``held`` distinct at a time, only the earliest place goes on."""

    def batch_of(least):
        names, places = (list(zip(*x, strict=True)) for x in (least, least.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array(names[0], pa.int64()), pa.array(names[1], pa.binary()), *(pa.array(x, pa.int64()) for x in places)],
            ["bucket", "packed", "doc_key", "text_key", "start"],
        )

    def run(batches):
        least: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        for batch in batches:
            offsets, (low, at, hot) = _lists(batch.column("runs"), "minimiser", "at", "hot")
            doc_key, text_key = batch.column("doc_key").to_pylist(), batch.column("text_key").to_pylist()
            for d, text in enumerate(batch.column("text")):
                words = text.as_buffer().to_pybytes().split()
                for r in range(offsets[d], offsets[d + 1]):
                    start, n, bucket = int(at[r]) >> 6, int(at[r]) & 63, int(low[r])
                    if hot[r]:
                        found = [(start + o, b" ".join(words[start + o : start + o + width])) for o in range(n)]
                        found = [(s, int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "big", signed=True), p) for s, p in found]
                    else:
                        found = [(start, bucket, b" ".join(words[start : start + n + width - 1]))]
                    for s, b, p in found:
                        place = (doc_key[d], text_key[d], s)
                        if least.setdefault((b, p), place) > place:
                            least[b, p] = place
                if len(least) >= held:
                    yield batch_of(least)
                    least = {}
        if least:
            yield batch_of(least)

    return located.mapInArrow(run, "bucket long, packed binary, doc_key long, text_key long, start long")


def first_places(packed: DataFrame, width: int) -> DataFrame:
    """Ranges of windows that are the first of their word sequence: row key, ``start``, ``n``.

    Buckets arrive one after another, in each the packed strings in order, the earliest of equal ones first.
    """

    def bucket(rows, out):
        windows = []
        for p, doc, text, start in rows:
            words = p.split()
            windows += [(b" ".join(words[o : o + width]), doc, text, start + o) for o in range(len(words) - width + 1)]
        windows.sort()
        firsts = sorted(w[1:] for i, w in enumerate(windows) if not i or windows[i - 1][0] != w[0])
        for doc, text, at in firsts:
            if out and out[-1][0] == doc and out[-1][1] == text and out[-1][2] + out[-1][3] == at:
                out[-1][3] += 1
            else:
                out.append([doc, text, at, 1])

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], [*KEY, "start", "n"])

    def run(batches):
        name, rows, out = None, [], []
        for batch in batches:
            for b, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "packed", "doc_key", "text_key", "start")), strict=True):
                if b != name:
                    bucket(rows, out)
                    name, rows = b, []
                    if len(out) >= 20_000:
                        yield batch_of(out)
                        out = []
                if not rows or rows[-1][0] != row[0]:
                    rows.append(row)
        bucket(rows, out)
        if out:
            yield batch_of(out)

    ordered = packed.repartition("bucket").sortWithinPartitions("bucket", "packed", *KEY, "start")
    return ordered.mapInArrow(run, "doc_key long, text_key long, start long, n long")


def strip_repeats(joined: DataFrame, width: int, with_text: bool) -> DataFrame:
    """Remove the words of the windows in ``runs`` that aren't in ``firsts``."""

    def spread(starts, ns, size):
        edge = np.bincount(starts, minlength=size + 1)[: size + 1] - np.bincount(starts + ns, minlength=size + 1)[: size + 1]
        return np.cumsum(edge)[:size] > 0

    def run(batches):
        for batch in batches:
            at_runs, (at,) = _lists(batch.column("runs"), "at")
            at_firsts, (start, n) = _lists(batch.column("firsts"), "start", "n")
            counts, removed, digests, texts = [], [], [], []
            for d, text in enumerate(batch.column("text")):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                size = len(words)
                counts.append(size)
                if at_runs[d] < at_runs[d + 1]:
                    mine = at[at_runs[d] : at_runs[d + 1]]
                    repeated = spread(mine >> 6, mine & 63, size)
                    own = slice(at_firsts[d], at_firsts[d + 1])
                    repeated &= ~spread(start[own], n[own], size)
                    places = np.flatnonzero(repeated)
                    gone = spread(places, np.full(len(places), width), size)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                removed.append(size - len(words))
                kept = b" ".join(words)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept if with_text else None)
            key = batch.column("doc_key").to_pylist()
            cols = [pa.array([None if k == 2**63 - 1 else k for k in key], pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols, names = [*cols, pa.array(texts, pa.binary()).cast(pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def substring_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``, kept_text."""
    keyed = C.with_key(docs).select(*KEY, "text")
    rows = announce(keyed, width, gram)
    # written, so that both sides of the next join are plain exchanges, which Spark can split by skew
    recurring = C.materialise(rows.groupBy("minimiser").agg(F.count("*").alias("times")).filter("times > 1"), "recurring")
    runs = rows.join(recurring, "minimiser").groupBy(*KEY).agg(F.collect_set(F.struct("minimiser", "at", (F.col("times") > hot).alias("hot"))).alias("runs"))
    located = keyed.join(runs, KEY)
    firsts = first_places(pack(located, width), width).groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("firsts"))
    joined = keyed.join(runs, KEY, "left").join(firsts, KEY, "left")
    return strip_repeats(joined, width, with_text)


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup(C.documents(spark, sf_dir))


OP5_SQL = f"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
  w as (select doc_id, p, array_to_string(list_slice(words, p, p + {WIDTH - 1}), ' ') as seq
        from (select doc_id, words, unnest(range(1, len(words) - {WIDTH} + 2)) as p from t)),
  later as (select doc_id, p from (select doc_id, p, row_number() over (partition by seq order by doc_id, p) as r from w) where r > 1),
  gone as (select distinct doc_id, p + o as p from later, (select unnest(range(0, {WIDTH})) as o)),
  each as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from t),
  kept as (select e.doc_id, string_agg(word, ' ' order by e.p) as txt, count(*) as n from each e anti join gone g on e.doc_id = g.doc_id and e.p = g.p group by e.doc_id)
select t.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(kept.txt, '')) as kept_sha256
from t left join kept using (doc_id)
"""
