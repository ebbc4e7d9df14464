"""Hard negatives against plain search, on odd rows, ties, hot labels, and walks that end early."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barstead.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, key string, tie int, score int, shard int, vector string"


def plain(rows, every=100):
    """anchor, positive, rank, negative, scores of distinct rows (vec_id, label, vector) with ids that aren't null."""
    rows = [(i, x, [math.floor(256 * float(np.float32(v))) for v in e]) for i, x, e in rows]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    out = []
    for a in (r for r in rows if r[0] % every == 0):
        scored = sorted(((dot(a[2], r[2]), r) for r in rows if r is not a), key=lambda s: (-s[0], s[1][0]))
        for ps, p in [s for s in scored if s[1][1] == a[1]][:5]:
            near = [(s, r) for s, r in scored if r[1] != a[1] and 30 * ps <= 100 * s <= 90 * ps][:10]
            out += [(a[0], p[0], k, r[0], ps, s) for k, (s, r) in enumerate(near, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, x, "k", 1, 2, 3, "v") for i, x, e in rows], SCHEMA)


def got(df, **more):
    return sorted(tuple(r) for r in h.mine(h.usable(df), **more).collect())


def vectors(n, d, seed, spread=1.0, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    return (middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, d))).astype(np.float32).tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_search_over_shards(spark, seed):
    v = vectors(1200, 12, seed)
    # a third of all rows has one label; many equal scores, since components are coarse
    rows = [(i, 0 if i % 3 else i % 4, [round(x) / 4 for x in e]) for i, e in enumerate(v)]
    want = plain(rows)
    assert got(frame(spark, rows)) == want and len(want) > 200
    assert got(frame(spark, rows), shard=100) == want


def test_odd_rows(spark):
    v = vectors(400, 6, 3)
    rows = [(i, i % 3, e) for i, e in enumerate(v)]
    rows[7] = (7, 1, rows[7][2][:3])  # a shorter vector ends in zeros
    rows[8] = (8, 2, [])
    rows[9] = (9, 0, [0.0] * 6)
    rows[200] = (200, 2, [0.0] * 6)  # an anchor without direction
    rows[300] = (300, 9, rows[300][2])  # an anchor whose label is its own
    bad = [(500, None, v[0]), (600, 1, None), (700, 1, [1.0, None]), (800, 1, [1.0, float("nan")]), (900, 1, [float("inf")]), (1000, 1, [float("-inf"), 0.0])]
    padded = [(i, x, [*e, *[0.0] * (6 - len(e))]) for i, x, e in rows]
    want = plain(padded)
    assert got(frame(spark, rows + bad + rows[:50] * 3)) == want
    assert not {r[0] for r in want} & {300, 500, 600, 700, 800, 900, 1000}


def test_rows_that_share_an_id_or_have_none(spark):
    v = vectors(60, 4, 4)
    rows = [(i, i % 2, e) for i, e in enumerate(v)]
    more = [(0, 1, v[5]), (None, 1, v[6]), (None, 0, v[7])]
    found = h.mine(h.usable(frame(spark, rows + more))).collect()
    assert {r.anchor_id for r in found} == {0}
    assert None in {r.negative_id for r in found} | {r.positive_id for r in found}
    # both rows of id 0 are anchors, and each may be the other's negative
    per = {}
    for r in found:
        per.setdefault((r.positive_id, r.positive_score), []).append(r.negative_score)
    assert all(s == sorted(s, reverse=True) for s in per.values())


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (rng.integers(-(2**14), 2**14, 5) * 2.0**6).tolist()) for i in range(120)]
    assert got(frame(spark, rows)) == plain(rows)
    huge = [(i, x, [c * 2.0**60 for c in e]) for i, x, e in rows]
    assert all(-(2**63) < r[4] < 2**63 for r in got(frame(spark, huge)))


def test_empty_table(spark):
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, 0, [1.0])])) == []
    assert got(frame(spark, [(0, 0, [1.0])])) == []


def test_walks_end_early_and_certainly():
    """Where directions differ, most of the list is never scored; nothing is lost by that."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    unit = rng.normal(size=(20, 16))
    x = (unit[rng.integers(0, 20, 8000)] + 0.05 * rng.normal(size=(8000, 16))) * rng.uniform(0.5, 2, size=(8000, 1))
    part = pa.RecordBatch.from_pydict({"tie": np.arange(8000), "key": np.arange(8000), "label": np.ones(8000, np.int64), "vector": pa.array(x.tolist())})
    shard = h.Shard([part])
    members = shard.vectors[np.linalg.norm(x / np.linalg.norm(x, axis=1, keepdims=True) - unit[0] / np.linalg.norm(unit[0]), axis=1) < 0.3][:40]
    centre = h.fitted_centres(members, 1)[0]
    rows, bounds = shard.bounded(centre, h.angles(members, centre[None, :]).max(), 1, True)
    n = len(members)
    who, score, what, computed = h.walk(shard, rows, bounds, members, np.arange(n), np.full(n, -(2**63) + 1), np.full(n, 2**63 - 1), np.full(n, -1), 5)
    exact = members @ shard.vectors.T
    assert score.tolist() == [s for r in exact for s in np.sort(r)[::-1][:5].astype(int).tolist()]
    assert who.tolist() == np.repeat(np.arange(n), 5).tolist() and (exact[who, what] == score).all()
    assert computed < 0.5 * exact.size


def test_other_columns_are_ignored(spark):
    v = vectors(300, 4, 8)
    df = frame(spark, [(i, i % 2, e) for i, e in enumerate(v)])
    assert got(df) == got(df.select("vec_id", "embedding", "label")) == got(df.withColumn("embedding", F.col("embedding").cast("array<double>")))
