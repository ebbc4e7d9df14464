"""As-of joins of any tolerance against plain search, with skewed series and odd rows."""

import random
from datetime import datetime, timedelta

import pytest

from barstead.operators.asof import asof_join

DAY = datetime(2024, 1, 1)


def frames(spark, seed):
    rng = random.Random(seed)
    at = lambda: DAY + timedelta(seconds=rng.randrange(0, 6 * 86_400, 600))
    left = [(rng.choice("aaaab"), at(), i) for i in range(150)] + [("a", None, 900), (None, DAY, 901), ("z", DAY, 902)]
    right = [(rng.choice("aaaac"), at(), float(i)) for i in range(60)] + [("a", None, -1.0), (None, DAY, -2.0)]
    return left, right, spark.createDataFrame(left, "symbol string, ts timestamp_ntz, n int"), spark.createDataFrame(right, "symbol string, ts timestamp_ntz, v double")


def plain(left, right, tolerance, strict):
    out = []
    for s, t, n in left:
        ok = [(u, v) for k, u, v in right if s is not None and k == s and t is not None and u is not None and (u < t or (u == t and not strict)) and (tolerance is None or (t - u).total_seconds() <= tolerance)]
        out.append((s, t, n, *(max(ok) if ok else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("tolerance", "bucket", "strict"), [(600, 86_400, False), (3600, 7200, True), (200_000, 86_400, False), (None, 3600, False), (86_400, 86_400, True)])
def test_asof_equals_plain_search(spark, tolerance, bucket, strict):
    left, right, a, b = frames(spark, tolerance or 1)
    got = sorted(map(tuple, asof_join(a, b, ["v"], tolerance, bucket=bucket, strict=strict).collect()), key=repr)
    assert got == plain(left, right, tolerance, strict)


def test_empty_sides(spark):
    _, _, a, b = frames(spark, 1)
    assert asof_join(a, b.limit(0), ["v"]).filter("v is not null").isEmpty() and asof_join(a, b.limit(0), ["v"]).count() == 153
    assert asof_join(a.limit(0), b, ["v"]).isEmpty()
