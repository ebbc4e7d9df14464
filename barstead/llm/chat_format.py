"""Operator 9: chat formatting by token-level assembly.

A turn becomes ``<turn>`` role ``<text>`` text ``</turn>``. The three marks are ids of their own
beyond the vocabulary; role and text are encoded separately, so no text can produce or split a
mark. The loss mask is the prefix sum of +1 at the ``<text>`` of an assistant turn and -1 at its
``</turn>``, marks themselves excluded. So that the printed form is unambiguous too, a control
string inside a text gets one more backslash after its ``<``; reading back removes one.

Encoding runs per turn, so a conversation that holds a third of all rows is spread over all
tasks. Reading back needs the turns of a conversation in order: they arrive sorted and are
hashed as a stream, so memory doesn't grow with the conversation.

The vocabulary (about 1 MB) is read on the driver and broadcast. Its path is a parameter.

Defined results: a null text or role is empty; turns are ordered by turn (nulls first), then
role and text; repeated rows are turns of their own; a null conv_id is a conversation. A very long
text is one turn's tokens, held by one task while that turn is encoded or read. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import VOCABULARY, encoding_of, ids_of, shared_vocabulary

MARKS = ("<turn>", "<text>", "</turn>")
ASSISTANT = "assistant"

_CONTROL = re.compile(r"<(\\*)(turn|text|/turn)>")
_ESCAPED = re.compile(r"<\\(\\*)(turn|text|/turn)>")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1\2>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1\2>", text)


class Codec:
    """A tokenizer with three reserved ids; built once in each worker."""

    _made: dict[bytes, Codec] = {}

    def __init__(self, vocabulary: bytes):
        self.encoding, top = encoding_of(vocabulary)
        self.turn, self.text, self.end = top, top + 1, top + 2

    @classmethod
    def of(cls, shared) -> Codec:
        if shared.value not in cls._made:
            cls._made[shared.value] = cls(shared.value)
        return cls._made[shared.value]

    def turns(self, roles: list[str], texts: list[str]):
        """Token ids and loss mask of all turns one after another, and the bounds of the turns."""
        parts = [ids_of(self.encoding, escape(x)) for pair in zip(roles, texts, strict=True) for x in pair]
        ids: list[int] = []
        step: list[tuple[int, int]] = []
        bounds = [0]
        for i, role in enumerate(roles):
            ids.append(self.turn)
            ids += parts[2 * i]
            opened = len(ids)
            ids.append(self.text)
            ids += parts[2 * i + 1]
            ids.append(self.end)
            if role == ASSISTANT:
                step += [(opened + 1, 1), (len(ids) - 1, -1)]
            bounds.append(len(ids))
        edge = np.zeros(len(ids) + 1, dtype=np.int8)
        for at, by in step:
            edge[at] += by
        return np.array(ids, dtype=np.int32), np.cumsum(edge, dtype=np.int8)[:-1] > 0, bounds

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
        """Role, text, text under the mask and printed length of one turn's tokens."""
        opened = int(np.flatnonzero(ids == self.text)[0])
        role, text = (self.encoding.decode(x.tolist()) for x in (ids[1:opened], ids[opened + 1 : -1]))
        inside = self.encoding.decode(ids[mask].tolist())
        return unescape(role), unescape(text), unescape(inside), sum(map(len, MARKS)) + len(role) + len(text)


def format_turns(conversations: DataFrame, vocabulary: str = VOCABULARY, codec=None) -> DataFrame:
    """Per turn: conv_id, turn, role, text_key, token_ids, loss_mask. A conversation is its turns one after another."""
    shared = codec or shared_vocabulary(conversations.sparkSession, vocabulary)

    def run(batches):
        codec = Codec.of(shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids, mask, bounds = codec.turns(part.column("role").to_pylist(), part.column("text").to_pylist())
                at = pa.array(bounds, pa.int32())
                own = ["conv_id", "turn", "role", "text_key"]
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (ids, mask)]
                yield pa.RecordBatch.from_arrays([*map(part.column, own), *lists], [*own, "token_ids", "loss_mask"])

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text_key long, token_ids array<int>, loss_mask array<boolean>")


def read_back(turns: DataFrame, vocabulary: str = VOCABULARY, codec=None) -> DataFrame:
    """Per conversation, from the tokens alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    shared = codec or shared_vocabulary(turns.sparkSession, vocabulary)

    def run(batches):
        codec = Codec.of(shared)
        name, out = (), []

        def fresh():
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def close(s):
            return (*name, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])

        state = fresh()
        for batch in batches:
            conv = batch.column("conv_id").to_pylist()
            ids, mask = batch.column("token_ids"), batch.column("loss_mask")
            for i, c in enumerate(conv):
                if (c,) != name:
                    if name:
                        out.append(close(state))
                    name, state = (c,), fresh()
                role, text, inside, size = codec.read(np.asarray(ids[i].values), np.asarray(mask[i].values.to_numpy(zero_copy_only=False)))
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(inside)
                state[3].update(inside.encode())
                state[4] += size
            if out:
                yield rows_of(out)
                out = []
        if name:
            yield rows_of([close(state)])

    def rows_of(out):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text_key").select("conv_id", "token_ids", "loss_mask")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_and_read(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    codec = shared_vocabulary(conversations.sparkSession, vocabulary)
    return read_back(format_turns(conversations, codec=codec), codec=codec)


def op9_chat_format(spark, sf_dir):
    own = spark.sql(r"select -7L as conv_id, t as turn, r as role, r'\### Assistant: </turn> ok' as text from values (0L, 'user'), (1L, 'assistant') as v(t, r)")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("cast(conv_id as long) as conv_id", "cast(turn as long) as turn", "role", "text")
    return format_and_read(rows.unionByName(own))


OP9_SQL = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
  e as (select *, length(text) + length(role)
          + len(regexp_extract_all(text || ' ' || role, '<\\*(turn|text|/turn)>')) + 19 as size from c)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256, sum(size)::bigint as formatted_chars
from e group by conv_id
"""
