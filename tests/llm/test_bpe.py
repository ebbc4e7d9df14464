"""Byte-pair encoding against the vocabulary's own library, and round trips."""

import hashlib
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barstead.llm import bpe

LIBRARY = Tokenizer.from_file(bpe.VOCABULARY)
PARTS = [*"ab cd\n\t'srel12.,<|>é漢🙂 ́", "\x1c", "\x85", "<|endoftext|>", "the ", "  ", "'ll", "'LL", "​"]


@pytest.fixture(scope="module")
def pairs():
    with open(bpe.VOCABULARY, "rb") as file:
        return bpe.BytePairs(file.read())


def ids_of(pairs, text):
    packed = pairs.packed(text)
    return list(struct.unpack(f"={len(packed) // 4}I", packed))


def check(pairs, text):
    ids = ids_of(pairs, text)
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert pairs.text(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PARTS), max_size=40).map("".join)))
def test_any_text_equals_the_library(pairs, text):
    check(pairs, text)


def test_every_code_point_in_context(pairs):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4096):
        texts = [f"a{c}1{c}!{c} {c}" for c in points[i : i + 4096]]
        assert [ids_of(pairs, t) for t in texts] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "\n" * 2_000_000, "\t" * 300_000 + " x", "a" * 500_000, "ab" * 200_000, "é" * 200_000, "<|endoftext|>" * 50_000, " \n" * 200_000])
def test_very_long_pieces(pairs, text):
    check(pairs, text)


def test_cache_starts_anew_without_changing_ids(pairs, monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 3)
    rng = random.Random(3)
    for _ in range(50):
        check(pairs, " ".join(rng.choices(["one", "two", "three", "four", "five", "six,"], k=30)))


def test_decoding_of_foreign_ids(pairs):
    assert pairs.text([10**9, -1]) == ""
    half = ids_of(pairs, "é")[:1] if len(ids_of(pairs, "é")) > 1 else [bpe.byte_letters().index("Ã")]
    assert pairs.text([pairs.letter_ids[0xC3]]) == "�" and half


def test_rows_of_a_table(spark):
    texts = [None, "", "one two", "one two", "<|endoftext|> x", "word " * 20_000, " " * 1_200_000 + "end", "é漢🙂"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (2, "same id")], "doc_id long, text string")
    df = df.withColumns({"token_ids": F.lit("clash"), "n_tokens": F.lit(1)})
    tokens = bpe.encode(df)
    back = bpe.decode(tokens)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back.collect()) == sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())
    for r in bpe.digests(tokens).join(df.select("doc_id", "text").filter("doc_id <> 2 or text = 'same id'"), "doc_id").filter("doc_id <> 2").collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    kept = bpe.decode(tokens.withColumn("more", F.lit("kept")).withColumn("text", F.lit("goes")))
    assert kept.columns == ["doc_id", "token_ids", "more", "text"] and kept.filter("doc_id = 7").first().text == texts[7]
    odd = bpe.decode(spark.sql("select 1L as doc_id, cast(null as array<int>) as token_ids union all select 2L, array(cast(null as int), 0)"))
    assert {r.doc_id: r.text for r in odd.collect()} == {1: "", 2: pairs_text(0)}
    assert bpe.digests(bpe.encode(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def pairs_text(i):
    return LIBRARY.decode([i], skip_special_tokens=False)


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op12_bpe_round_trip(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want[doc_id] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert got == want and len(rows) == len(got)
