"""Very long runs of white space: same tokens as shorter runs' rule gives, no crash, exact round trips."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barstead.llm import chat_format, packing, tokens

KINDS = {"blanks": " ", "line ends": "\n", "tabs": "\t", "mixed": " \n\t \r"}


@pytest.fixture(scope="module")
def encoding():
    with open(tokens.VOCABULARY, "rb") as file:
        return tokens.encoding_of(file.read())[0]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize(("before", "after"), [("one", "two"), ("", "'ll"), ("x ", " 7"), ("a", ""), ("", "é!")])
def test_cut_texts_have_the_same_tokens(encoding, monkeypatch, kind, before, after):
    run = (KINDS[kind] * 40)[:37]
    text = before + run + after + run + run + "end" + run
    whole = encoding.encode_ordinary(text)
    monkeypatch.setattr(tokens, "LONG_RUN", 5)
    assert len(tokens.parts_of(text)) > 1 and "".join(tokens.parts_of(text)) == text
    assert tokens.ids_of(encoding, text) == whole


@pytest.mark.parametrize("kind", KINDS)
def test_two_million(encoding, kind):
    text = "a" + (KINDS[kind] * 2_000_000)[:2_000_000] + "word"
    ids = tokens.ids_of(encoding, text)
    assert encoding.decode(ids) == text
    # the run without its last character is one piece, that character goes with or before the word
    assert ids[-len(tail) :] == tail if (tail := encoding.encode_ordinary(text[-5:])) else False


def test_packing_and_chat_take_them(spark):
    texts = [f"start{c * 2_000_000}end" for c in " \n\t"] + [" " * 1_200_000, "plain words"]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    with open(tokens.VOCABULARY, "rb") as file:
        codec = tokens.encoding_of(file.read())[0]
    pieces = {}
    for r in packing.pack(df).collect():
        at = 0
        for d, start, n in zip(r.doc_ids, r.starts, r.lengths):
            pieces.setdefault(d, {})[start] = r.token_ids[at : at + n]
            at += n
    for i, t in enumerate(texts):
        ids = np.concatenate([pieces[i][k] for k in sorted(pieces[i])]).tolist()
        assert codec.decode(ids) == t
    turns = df.select(F.lit(1).alias("conv_id"), F.col("doc_id").alias("turn"), F.lit("assistant").alias("role"), "text")
    got = chat_format.format_and_read(turns).first()
    assert (got.n_turns, got.loss_chars) == (len(texts), sum(map(len, texts)))
    assert got.loss_sha256 == hashlib.sha256("".join(texts).encode()).hexdigest()
