"""Byte-pair tokens by a public vocabulary, whose path is a parameter; it is read on the driver (about 1 MB) and broadcast."""

from __future__ import annotations

import base64
from itertools import pairwise

import numpy as np
import pyarrow as pa

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits text before byte-pair encoding, as the vocabulary expects.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

#: Runs of white space of this length are parted from what follows before the pattern sees them: it backtracks over a run, on a stack of bounded size.
LONG_RUN = 10_000

_MADE: dict[bytes, tuple] = {}


def shared_vocabulary(spark, path: str = VOCABULARY):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoding_of(vocabulary: bytes):
    """The tokenizer, and the first id that it leaves free; made once in each worker."""
    import tiktoken

    if vocabulary not in _MADE:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        _MADE[vocabulary] = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1
    return _MADE[vocabulary]


def parts_of(text: str) -> list[str]:
    """The text cut where the pattern cuts it after a long run of white space: before the run's last character, unless the text ends there."""
    if len(text) < LONG_RUN:
        return [text]
    import regex

    cuts = [0, *(m.end() - 1 for m in regex.finditer(rf"\s{{{LONG_RUN},}}+", text) if m.end() < len(text)), len(text)]
    return [text[a:b] for a, b in pairwise(cuts)]


def ids_of(encoding, text: str) -> list[int]:
    parts = parts_of(text)
    return encoding.encode_ordinary(text) if len(parts) == 1 else [i for p in parts for i in encoding.encode_ordinary(p)]


def encoded(encoding, texts: pa.Array) -> tuple[np.ndarray, list[int]]:
    """Token ids of all texts one after another, and how many each has; a null is an empty text."""
    flat: list[int] = []
    sizes: list[int] = []
    for text in texts.fill_null("").to_pylist():
        ids = ids_of(encoding, text)
        flat += ids
        sizes.append(len(ids))
    return np.array(flat, dtype=np.int32), sizes
