"""Filter interaction audit against plain counting, on odd rows and on random masks."""

import random
import re
from itertools import permutations

import pytest

from barstead.llm import filter_audit as f

SCHEMA = "doc_id long, text string, lang string, part string, mask string, n int, digest string, good string"


def failures(rows):
    """Failing letters of each (doc_id, text, lang) by the contract's words."""
    out = []
    for doc_id, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        copy = doc_id is not None and any(i is not None and i < doc_id and (u or "") == t for i, u, _ in rows)
        out.append(fails + "E" * copy)
    return out


def plain(rows, labels):
    out = []
    fails = failures(rows)
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    for part in {lang or "" for *_, lang in rows}:
        own = [(i, x) for (i, _, lang), x in zip(rows, fails, strict=True) if (lang or "") == part]
        got = {}
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone, kept = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                all_fail = [r for r in own if x in r[1]]
                got["".join(order), step] = [len(kept), len(gone), len(all_fail) - len(gone), sum(r[1] == x for r in own), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), x]
                left = kept
        total = {x: sum(v[1] for v in got.values() if v[6] == x) for x in "ABCDE"}
        out += [(part, o, s, *v[:6], total[v[6]]) for (o, s), v in got.items()]
    return sorted(out)


def odd_rows():
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", " \n\t", "one", "ONE", "a|b", long, long, long + " #", "ab " * 300, "AB " * 300 + "$", "é" * 40, long.upper(), long, "x y " * 40_000]
    rows = [(i, t, ["en", None, "de", ""][i % 4]) for i, t in enumerate(texts)]
    # repeated rows, a repeated id with another text, ids that are null
    return rows + [(7, long, "de"), (7, long, ""), (3, "another", None), (None, long, "en"), (None, None, "en"), (None, "only here", "zz"), (99, long, "en"), (99, long, "en")]


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", "x", 1, "x", "x") for r in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


LABELS = [(0, 1, 0), (1, 1, 1), (3, 0, 1), (3, 1, None), (6, 1, 0), (7, 1, 1), (9, None, None), (10, 0, 0), (99, 1, 0), (None, 1, 1), (13, 0, 1)]


def test_audit_equals_plain_counting(spark):
    rows = odd_rows()
    docs, labels = frames(spark, rows, LABELS)
    got = sorted(tuple(r) for r in f.audit(f.document_masks(docs, labels)).collect())
    assert got == plain(rows, LABELS)


def test_empty_tables(spark):
    docs, labels = frames(spark, [], [])
    assert f.audit(f.document_masks(docs, labels)).collect() == []
    docs, labels = frames(spark, [(1, "a", "en")], [])
    assert f.audit(f.document_masks(docs, labels)).count() == 600


def test_hot_copies(spark):
    """A third of all rows share one text."""
    rows = [(i, "same text" if i % 3 else f"text {i}", "en") for i in range(3000)]
    docs, labels = frames(spark, rows, [(i, 1, 0) for i in range(0, 3000, 5)])
    got = {(r.filter_order, r.step): r for r in f.audit(f.document_masks(docs, labels)).collect()}
    first = got["EABCD", 1]
    assert (first.removed, first.kept, first.redundant) == (1999, 1001, 0)
    assert first.good_lost == sum(i % 3 > 0 for i in range(0, 3000, 5))
    assert got["AEBCD", 1].removed == 3000 and got["AEBCD", 2].removed == 0 and got["AEBCD", 2].redundant == 1999


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_swaps_visit_every_order_and_steps_count_masks(k):
    rng = random.Random(k)
    masks = {m: (rng.randint(1, 9), rng.randint(0, 3), rng.randint(0, 3)) for m in range(2**k) if rng.random() < 0.7} or {0: (1, 0, 0)}
    diagram, seen = f.Diagram(k, masks), set()
    for level in [None, *f.adjacent_swaps(k)]:
        if level is not None:
            diagram.swap(level)
        seen.add(tuple(diagram.order))
        left = dict(masks)
        for x, gone, kept in diagram.steps():
            fails = {m: c for m, c in left.items() if m >> x & 1}
            left = {m: c for m, c in left.items() if not m >> x & 1}
            for side, want in ((gone, fails), (kept, left)):
                assert side == tuple(map(sum, zip((0, 0, 0), *want.values())))
        assert diagram.failing() == [tuple(map(sum, zip((0, 0, 0), *(c for m, c in masks.items() if m >> x & 1)))) for x in range(k)]
    assert len(seen) == len(list(permutations(range(k))))


def test_equal_subtrees_are_shared():
    diagram = f.Diagram(5, {m: (1, 0, 0) for m in range(32)})
    reached, todo = set(), [diagram.root]
    while todo:
        node = todo.pop()
        if node not in reached:
            reached.add(node)
            todo += filter(None, diagram.branches(node) if diagram.below[node] else ())
    assert len(reached) == 6
