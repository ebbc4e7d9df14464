"""Operator 12: byte-pair encoding and decoding by a public vocabulary.

A text is cut at special tokens, then into pieces by the vocabulary's pattern. The bytes of a piece are a
doubly linked list of symbols; a priority queue holds (rank, place) of each neighbouring pair that
has a merge. The least rank, leftmost first, is taken out and its pair joined, which queues the new
pairs to its left and right. Entries are never removed: one whose left symbol is gone, or whose pair
now has another rank, is stale and skipped. So a piece of n bytes takes n log n steps, whatever it
holds. Pieces recur, and so do the stretches from one blank before a word to the next, at which every
text may be cut: each worker keeps what short ones became, up to ``HELD`` of either.

Decoding joins the vocabulary's byte strings of the ids and reads them as UTF-8.

Each text is encoded where it lies: nothing is shuffled. The vocabulary's file (about 1.5 MB) is read on the
driver and broadcast; its path is a parameter.

Defined results: a null text is empty and has no tokens; an id that the vocabulary lacks, or a null
one, decodes to nothing; bytes that aren't UTF-8 decode to U+FFFD; a null list decodes to the empty
text. Each row is encoded by itself, so repeated rows and ids give repeated rows. A very long text is
one task's, with some ten numbers per byte of its longest piece. An empty table gives no rows. Other
columns of the input are ignored by ``encode`` and kept by ``decode``.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Pieces and stretches whose ids a worker keeps, and the longest of them in characters.
HELD, SHORT = 600_000, 40
#: Bytes of text that are encoded, and ids that are decoded, at a time.
AT_ONCE = 2_000_000

# Letters and numbers of Unicode 17 and later, which the vocabulary's library (Unicode 16) counts as neither.
LATER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D\U000107BB-\U000107BF"
    r"\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1"
    r"\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF"
    r"\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168"
    r"\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2"
    r"\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    r"\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
#: How the vocabulary splits text before any merge; for texts of ASCII alone, and for all.
PLAIN = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]++| ?[0-9]++| ?[^\sA-Za-z0-9]++|\s+(?!\S)|\s++"
SPLIT = rf"(?V1)'(?:[stmd]|re|ve|ll)| ?[\p{{L}}--[{LATER}]]++| ?[\p{{N}}--[{LATER}]]++| ?[[^\s\p{{L}}\p{{N}}]||[{LATER}]]++|\s+(?!\S)|\s++"


def byte_letters() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself if it prints, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class BytePairs:
    """A byte-level vocabulary with its merges; built once in each worker."""

    _made: dict[bytes, BytePairs] = {}

    def __init__(self, source: bytes):
        import regex

        file = json.loads(source)
        vocabulary = file["model"]["vocab"]
        letters = byte_letters()
        value = {c: b for b, c in enumerate(letters)}
        self.strings = {i: bytes(map(value.__getitem__, t)) for t, i in vocabulary.items()}
        self.letter_ids = [vocabulary[c] for c in letters]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in file["model"]["merges"]]
        none: dict[int, int] = {}
        #: By left symbol, the rank of each right symbol that it may be joined with.
        self.ranks = [none] * (max(vocabulary.values()) + 1)
        for rank, (a, b) in enumerate(pairs):
            left = vocabulary[a]
            if self.ranks[left] is none:
                self.ranks[left] = {}
            self.ranks[left][vocabulary[b]] = rank
        self.joined = [vocabulary[a + b] for a, b in pairs]
        special = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        self.strings |= {i: t.encode() for t, i in special.items()}
        self.special = {t: array("I", [i]).tobytes() for t, i in special.items()}
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True))) if special else None
        self.plain, self.split = regex.compile(PLAIN), regex.compile(SPLIT)
        self.word, self.run = regex.compile(r" (?=\S)"), regex.compile(r" (?:\s|$)")
        self.known, self.spaced = Known(self.of_piece), Known(self.of_stretch)

    @classmethod
    def of(cls, shared) -> BytePairs:
        if shared.value not in cls._made:
            cls._made[shared.value] = cls(shared.value)
        return cls._made[shared.value]

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece. An entry of the queue is a pair's rank and, in the lowest bits, the place of its left symbol."""
        ranks, joined, n = self.ranks, self.joined, len(piece)
        symbols = [*map(self.letter_ids.__getitem__, piece)]
        if n == 1:
            return symbols
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        bits = n.bit_length()
        low = (1 << bits) - 1
        queue = [rank << bits | i for i, (a, b) in enumerate(pairwise(symbols)) if (rank := ranks[a].get(b)) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, rank = entry & low, entry >> bits
            a, j = symbols[i], after[i]
            if a < 0 or j == n or ranks[a].get(symbols[j]) != rank:
                continue
            symbols[i] = a = joined[rank]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks[a].get(symbols[k])) is not None:
                    heappush(queue, rank << bits | i)
            h = before[i]
            if h >= 0 and (rank := ranks[symbols[h]].get(a)) is not None:
                heappush(queue, rank << bits | h)
        return [s for s in symbols if s >= 0]

    def packed(self, text: str) -> bytes:
        """Ids of a text, four bytes each in the machine's order."""
        parts, at = [], 0
        for hit in self.cut.finditer(text) if self.cut else ():
            parts += [self.ordinary(text[at : hit.start()]), self.special[hit.group()]]
            at = hit.end()
        return b"".join([*parts, self.ordinary(text[at:])]) if parts else self.ordinary(text)

    def of_piece(self, piece: str) -> bytes:
        return array("I", self.merged(piece.encode())).tobytes()

    def of_stretch(self, rest: str) -> bytes:
        return self.of_pieces(f" {rest}")

    def of_pieces(self, text: str) -> bytes:
        pieces = (self.plain if text.isascii() else self.split).findall(text)
        return b"".join(map(self.known.__getitem__, pieces))

    def ordinary(self, text: str) -> bytes:
        # a blank before something else than white space always begins a piece
        first, *rest = self.word.split(text) if self.run.search(text) else text.split(" ")
        return b"".join([self.of_pieces(first), *map(self.spaced.__getitem__, rest)])

    def text(self, ids: list[int]) -> str:
        found = self.strings.get
        return b"".join([found(i, b"") for i in ids]).decode(errors="replace")


class Known(dict):
    """Packed ids by string, made when first asked for; starts anew when full."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, text: str) -> bytes:
        ids = self.make(text)
        if len(text) <= SHORT:
            if len(self) >= HELD:
                self.clear()
            self[text] = ids
        return ids


def shared_pairs(spark, vocabulary: str = VOCABULARY):
    with open(vocabulary, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, shared=None) -> DataFrame:
    """Per row: doc_id, token_ids (array of int)."""
    shared = shared or shared_pairs(docs.sparkSession, vocabulary)

    def run(batches):
        pairs = BytePairs.of(shared)
        for batch in batches:
            _, offsets = C.text_buffer(batch.column("text"))
            for i, j in C.chunks(offsets, AT_ONCE):
                part = batch.slice(i, j - i)
                packed = [pairs.packed(t) for t in part.column("text").fill_null("").to_pylist()]
                at = np.append(0, np.cumsum([len(p) // 4 for p in packed]))
                ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "token_ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, token_ids array<int>")


def decoded(pairs: BytePairs, batch: pa.RecordBatch):
    """Slices of a batch with token_ids, each with its texts."""
    sizes = pc.list_value_length(batch.column("token_ids")).fill_null(0).to_numpy(zero_copy_only=False)
    for i, j in C.chunks(np.append(0, np.cumsum(sizes)).astype(np.int64), AT_ONCE):
        part = batch.slice(i, j - i)
        yield part, pa.array([pairs.text(ids or ()) for ids in part.column("token_ids").to_pylist()], pa.string())


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY, shared=None) -> DataFrame:
    """The rows with ``text`` as their last column, put together from token_ids."""
    shared = shared or shared_pairs(tokens.sparkSession, vocabulary)
    rows = tokens.select(*(c for c in tokens.columns if c != "text"))

    def run(batches):
        pairs = BytePairs.of(shared)
        for batch in batches:
            for part, texts in decoded(pairs, batch):
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))


def ids_digest(token_ids: pa.Array) -> pa.Array:
    """Hex digest of each list as little-endian 32-bit integers."""

    def digest(i: int) -> str:
        ids = np.asarray(flat[at[i] : at[i + 1]], dtype="<u4")
        return hashlib.sha256(ids.tobytes()).hexdigest()

    at, flat = token_ids.offsets.to_numpy(), token_ids.values.to_numpy()
    return pa.array([digest(i) for i in range(len(token_ids))], pa.string())


def digests(tokens: DataFrame, vocabulary: str = VOCABULARY, shared=None) -> DataFrame:
    """Per row of (doc_id, token_ids): doc_id, n_tokens, ids_sha256, and decoded_sha256 of the text that ``decode`` gives."""
    shared = shared or shared_pairs(tokens.sparkSession, vocabulary)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        pairs = BytePairs.of(shared)
        for batch in batches:
            for part, texts in decoded(pairs, batch):
                ids = part.column("token_ids")
                of_text = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pc.list_value_length(ids).cast(pa.int64()), ids_digest(ids), of_text], names)

    rows = tokens.select("doc_id", F.coalesce("token_ids", F.array().cast("array<int>")).alias("token_ids"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_bpe_round_trip(spark, sf_dir):
    shared = shared_pairs(spark)
    return digests(encode(C.documents(spark, sf_dir), shared=shared), shared=shared)
