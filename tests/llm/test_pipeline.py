import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as p
from barstead.llm import common, mixing, tokens
from test_llm_operators import brute_near, docs, odd_texts, prose, words

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = common.documents(spark, SF)
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    told = common.materialise(p.identify_language(spark, docs, SF), "told")
    assert told.columns == columns and told.count() >= 0.99 * len(texts)
    once = common.materialise(p.drop_exact(spark, told, SF), "once")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for r in sorted(told.collect(), key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert {r.doc_id for r in once.collect()} == set(first.values())
    unlike = common.materialise(p.drop_near(spark, once, SF), "unlike")
    ids = sorted(first.values())
    groups = brute_near([texts[i] for i in ids])
    assert {r.doc_id for r in unlike.collect()} == {ids[i] for i, (_, root) in groups.items() if root == i}
    mixed = common.materialise(p.mix_sources(spark, unlike, SF), "mixed")
    assert mixed.columns == columns
    taken = {r.doc_id: r.taken for r in mixing.mix(unlike).collect() if r.taken}
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
    assert got == taken
    packed = p.pack(spark, mixed, SF).collect()
    encoding = tokens.encoding_of(open(tokens.VOCABULARY, "rb").read())[0]
    assert sum(r.n_tokens for r in packed) == sum(len(encoding.encode_ordinary(r.text)) for r in mixed.collect())


def test_empty_documents(spark):
    docs = common.documents(spark, SF).limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_stages_on_odd_rows(spark):
    """Null columns, empty and very long texts, repeated rows and ids, ties and columns with names that stages use themselves."""
    texts = odd_texts() + [prose(20_000)]
    more = [(3, texts[3], "en", "s3", 3), (3, texts[3], "en", "s3", 3), (3, "another text", None, None, None), (None, texts[5], None, None, None), (None, None, None, None, None)]
    df = docs(spark, texts, more).withColumn("_a", F.lit(1)).withColumn("lang_pred", F.lit("x")).withColumn("group", F.lit(2)).withColumn("_shard", F.lit(3))
    rows = [(i, t) for i, t in enumerate(texts)] + [(m[0], m[1]) for m in more]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    last = lambda i: (i is None, i or 0)

    told = common.materialise(p.identify_language(spark, df, SF), "told")
    assert told.columns == df.columns
    lettered = [r for r in rows if re.search("[a-zA-Z]", r[1] or "")]
    assert sorted(((r.doc_id, r.text) for r in told.collect()), key=repr) == sorted(lettered, key=repr)
    assert {r.lang for r in told.collect()} == {"en"}

    once = common.materialise(p.drop_exact(spark, told, SF), "once")
    first = {}
    for i, t in sorted(lettered, key=lambda r: last(r[0])):
        first.setdefault(norm(t), (i, t))
    assert once.columns == df.columns and sorted(((r.doc_id, norm(r.text)) for r in once.collect()), key=repr) == sorted(((i, n) for n, (i, _) in first.items()), key=repr)

    unlike = common.materialise(p.drop_near(spark, once, SF), "unlike")
    own = sorted(((r.doc_id, r.text) for r in once.collect()), key=lambda r: last(r[0]))
    groups = brute_near([t for _, t in own])
    assert unlike.columns == df.columns and sorted(((r.doc_id, r.text) for r in unlike.collect()), key=repr) == sorted((own[i] for i, (_, root) in groups.items() if root == i), key=repr)

    mixed = common.materialise(p.mix_sources(spark, unlike, SF), "mixed")
    taken, got = Counter(), Counter()
    for r in mixing.mix(unlike).collect():
        taken[r.doc_id] += r.taken
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
    assert mixed.columns == df.columns and got == +taken

    encoding = tokens.encoding_of(open(tokens.VOCABULARY, "rb").read())[0]
    packed = p.pack(spark, mixed, SF).collect()
    assert sum(r.n_tokens for r in packed) == sum(len(encoding.encode_ordinary(r.text)) for r in mixed.collect())
    for _, stage in p.STAGES:  # rows that no earlier stage has cleaned
        assert stage(spark, df, SF).count() > 0


def test_run_equals_its_stages(spark):
    docs = common.documents(spark, SF)
    for _, stage in p.STAGES:
        docs = common.materialise(stage(spark, docs, SF), "stage")
    row = lambda r: (r.bin_id or "", r.capacity or 0, tuple(r.doc_ids), tuple(r.token_ids))
    assert sorted(map(row, docs.collect())) == sorted(map(row, p.run(spark, SF).collect()))


def test_stages_send_texts_in_small_batches(spark):
    """What a Python worker gets at a time is bounded in bytes, since batches of long texts add up beside an executor's heap."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["bytes"])

    df = docs(spark, [prose(20_000)] * 200).repartition(1)
    for _, stage in p.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, df, SF)
        if stage is not p.mix_sources:  # no Python
            assert max(r.bytes for r in df.select("text").mapInArrow(sizes, "bytes long").collect()) < 5_000_000
