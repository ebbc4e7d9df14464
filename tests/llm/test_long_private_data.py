"""Personal data in very long texts, repeated rows and repeated ids: values, not only ids."""

import re

from barstead.llm import private_data as p


def texts():
    words = [f"w{i} mail a{i}@b.com" if i % 10 == 0 else f"x{i}" for i in range(3000)]
    return [" ".join(words), " ".join(words[:20]), "call a1@b.com x7@c.de,a2@b.com", None, "ab1@c.d" * 300, "1 2 3 " * 2000 + "end@x.yz"]


def test_free_spans_are_those_that_overlap_no_base_span(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    got = {r.doc_id: r for r in p.extract(df).collect()}
    for i, t in enumerate(texts()):
        base = [(b.start, b.stop) for b in got[i].base]
        found = [(e.start, e.stop) for e in got[i].seen if e.kind is None]
        words = [m.span() for m in re.finditer(p.CANDIDATE, t or "")]
        assert found == [w for w in words if not any(a < w[1] and w[0] < b for a, b in base)]


def test_repeated_rows_and_ids_have_equal_values(spark):
    long = texts()[0]
    rows = [(1, long), (1, long), (1, "other a@b.cd"), (None, long), (2, "a@b.cd 1.2.3.4")]
    got = p.private_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip) for r in got) == [(0, 300, 0), (1, 1, 0), (1, 300, 0), (1, 300, 0), (2, 1, 1)]
    assert len({r.base_sha256 for r in got if r.n_email == 300}) == 1
