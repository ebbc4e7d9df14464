"""Stores bucketed by series: same rows, no exchange of stored rows, several writers a day."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstead.operators import quality as q
from barstead.operators import reconcile as r
from barstead.operators import store as st
from barstead.operators.bucketed import BucketedStore, by_series

DAY = datetime(2024, 1, 1)
BAR = "symbol string, bar_ts timestamp_ntz, close double"


def bars(spark, hours, symbols=tuple("abcdefgh"), off=0.0):
    return spark.createDataFrame([(s, DAY + timedelta(hours=h), 1.0 * h + off) for s in symbols for h in hours], BAR)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def make(spark, tmp_path):
    made = []

    def store(name, **more):
        made.append(name)
        return BucketedStore(spark, name, f"file://{tmp_path}/{name}", T.StructType.fromDDL(BAR), buckets=4, **more)

    kept = {c: spark.conf.get(c) for c in ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold")}
    by_series(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield store
    for c, v in kept.items():
        spark.conf.set(c, v)
    for name in made:
        spark.sql(f"drop table if exists {name}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_appends_are_idempotent_and_outlive_the_catalog(spark, make):
    store = make("outlives")
    assert store.read().isEmpty()
    for _ in range(2):
        store.append(bars(spark, range(60)).union(bars(spark, range(5), off=9.0)))
        assert rows_of(store.read()) == rows_of(bars(spark, range(60)))
    null = spark.createDataFrame([("x", None, 1.0), (None, DAY, 1.0)], BAR)
    store.append(bars(spark, range(50, 80), off=3.0).union(null))
    want = rows_of(bars(spark, range(60)).union(bars(spark, range(60, 80), off=3.0)))
    assert rows_of(store.read()) == want
    spark.sql("drop table outlives")  # another session: the files alone are left
    assert rows_of(store.read()) == want
    store.append(bars(spark, range(79, 82)))
    assert store.read().count() == len(want) + 16
    assert st.unique_key_audit(store.read()).isEmpty()


def test_no_stored_row_moves(spark, make):
    one, two = make("moves_one"), make("moves_two")
    one.append(bars(spark, range(100)))
    two.append(bars(spark, range(10, 120), off=0.5))
    # grouped by series, joined by series and time: nothing is exchanged
    assert exchanges(st.coverage(one.read())) == 0
    assert exchanges(one.read().join(two.read(), ["symbol", "bar_ts"], "full")) == 0
    # reconciled: a full join has no layout of its own, so the partial counts of series move, and nothing below the join
    report = plan_of(r.reconcile(one.read(), two.read(), [("close", 0.01)]))
    assert report.count("Exchange") == 1 and "Exchange" not in report.split("SortMergeJoin")[1]
    # the plain reading of the same rows does exchange both sides
    plain = [spark.read.parquet(x.path).drop("day") for x in (one, two)]
    assert exchanges(r.reconcile(*plain, [("close", 0.01)])) >= 2
    assert rows_of(r.reconcile(one.read(), two.read(), [("close", 0.01)])) == rows_of(r.reconcile(*plain, [("close", 0.01)]))
    # an append exchanges its batch only
    batch = bars(spark, range(90, 130))
    stored = plan_of(one.delta(batch)).split("SortMergeJoin")[1].split("\n   +- ")[-1]
    assert "Bucketed: true" in stored and "Exchange" not in stored
    assert rows_of(one.delta(batch)) == rows_of(bars(spark, range(100, 130)))
    assert rows_of(q.gap_count(one.read())) == rows_of(q.gap_count(plain[0]))


def test_days_are_pruned_and_have_several_writers(spark, make):
    store = make("pruned")
    store.append(bars(spark, range(24 * 5), tuple(f"s{i}" for i in range(40))))
    day = store.read([(DAY + timedelta(days=2)).date()])
    assert day.count() == 40 * 24
    assert "PartitionFilters: [" in plan_of(day) and "day#" in plan_of(day).split("PartitionFilters: [")[1].split("]")[0]
    files = [x.f for x in day.select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) == 4  # a file per bucket
    per = day.withColumn("f", F.input_file_name()).groupBy("symbol").agg(F.count_distinct("f").alias("n"))
    assert per.filter("n > 1").isEmpty()
