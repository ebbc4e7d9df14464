"""Resumable rewrites of stored tables, and counters that come out of the writing pass."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstead.operators import quality as q
from barstead.operators import rewrite as rw
from barstead.operators import store as st
from barstead.operators.counters import write_clean
from barstead.operators.kept import KeptStore
from barstead.streaming.counters import run_counted

DAY = datetime(2024, 1, 1)
OLD = "symbol string, timestamp timestamp_ntz, close double, trades int, volume double"
TIMES = [T.StructField(c, T.TimestampNTZType()) for c in ("timestamp", "snapshot_time")]
VALUES = [T.StructField("close", T.DoubleType()), T.StructField("trades", T.LongType()), T.StructField("base_volume", T.DoubleType())]
NEW = T.StructType([T.StructField("symbol", T.StringType()), *TIMES, *VALUES])
RENAMED = {"volume": "base_volume"}


def old_rows(spark, hours, symbols=("x", "y")):
    return spark.createDataFrame([(s, DAY + timedelta(hours=h), 100.0 + h, h, 7.0 * h) for s in symbols for h in hours], OLD)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def want(hours, symbols=("x", "y")):
    return sorted([(s, t := DAY + timedelta(hours=h), t + timedelta(hours=1), 100.0 + h, h, 7.0 * h) for s in symbols for h in hours], key=repr)


def fill(rows):
    return st.migrate_snapshot(rows, "timestamp")


@pytest.fixture
def path(spark, tmp_path):
    at = f"file://{tmp_path}/store"
    st.write_append(old_rows(spark, range(24 * 9)), at)
    return at


def rewrite(spark, path, change=fill, **more):
    return rw.rewrite_store(spark, path, NEW, change, "snapshot", RENAMED, days_per_step=2, **more)


def now(spark, path):
    return rw.read_evolved(spark, path, NEW, RENAMED).drop("day")


def test_a_cut_off_run_is_resumed(spark, path):
    assert rewrite(spark, path, steps=2).count() == 2
    days = rw.stored_days(spark, path)
    done = [d for x in rewrite(spark, path, steps=0).collect() for d in x.days]
    assert 0 < len(done) < len(days) == 9
    # old and new days are read together: values under new names and types, filled where rewritten
    mixed = now(spark, path)
    assert mixed.count() == 2 * 24 * 9 and mixed.filter("base_volume is null or trades is null").isEmpty()
    filled = {x.d for x in mixed.filter("snapshot_time is not null").select(F.to_date("timestamp").alias("d")).distinct().collect()}
    assert filled == set(done)
    with pytest.raises(ValueError, match="being rewritten"):
        st.write_append(old_rows(spark, [500]), path)
    with pytest.raises(ValueError, match="being rewritten by snapshot"):
        rw.rewrite_store(spark, path, NEW, fill, "other", RENAMED)
    steps = rewrite(spark, path)
    assert sorted(d for x in steps.collect() for d in x.days) == days
    assert steps.agg(F.sum("n_rows")).first()[0] == 2 * 24 * 9
    assert rows_of(st.read_store(spark, path, NEW)) == want(range(24 * 9))
    st.write_append(now(spark, path).limit(0), path)  # appends are taken again


@pytest.mark.parametrize("lost", ["nothing", "a day", "all days"])
def test_a_swap_cut_off_is_made_up_from_the_staged_rows(spark, path, lost):
    steps = rewrite(spark, path, steps=1).collect()
    at = path.removeprefix("file://")
    shutil.rmtree(f"{at}.rewrite/snapshot/done/{steps[0].step}")
    for d in {"nothing": [], "a day": steps[0].days[:1], "all days": steps[0].days}[lost]:
        shutil.rmtree(f"{at}/day={d}")
    rewrite(spark, path)
    assert rows_of(st.read_store(spark, path, NEW)) == want(range(24 * 9))


def test_days_that_come_later_are_rewritten_by_a_later_run(spark, path):
    rewrite(spark, path)
    files = {x.f for x in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    assert rows_of(rewrite(spark, path)) == rows_of(rewrite(spark, path))
    assert files == {x.f for x in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    st.write_append(old_rows(spark, range(24 * 20, 24 * 21)), path)
    rewrite(spark, path)
    assert rows_of(st.read_store(spark, path, NEW)) == want([*range(24 * 9), *range(24 * 20, 24 * 21)])


@pytest.mark.parametrize("bad", [lambda rows: rows.filter("hour(timestamp) < 23"), lambda rows: rows.union(rows), lambda rows: rows.withColumn("timestamp", F.expr("timestamp + interval 2 hours"))])
def test_a_change_that_loses_or_moves_rows_leaves_the_store_as_it_was(spark, path, bad):
    before = rows_of(now(spark, path))
    with pytest.raises(ValueError, match="rewrite snapshot"):
        rewrite(spark, path, lambda rows: fill(bad(rows)))
    assert rows_of(now(spark, path)) == before
    st.write_append(old_rows(spark, []), path)  # and open
    rewrite(spark, path)
    assert rows_of(st.read_store(spark, path, NEW)) == want(range(24 * 9))


def test_no_store_is_no_step(spark, tmp_path):
    assert rewrite(spark, f"file://{tmp_path}/none").isEmpty()
    assert rw.read_evolved(spark, f"file://{tmp_path}/none", NEW).isEmpty()


# ---------------------------------------------------------------- counters

RAW = "symbol string, bar_ts timestamp_ntz, open double, close_text string, file string, line_no int"


def raw(spark):
    t = [DAY + timedelta(hours=h) for h in range(60)]
    rows = [("x", t[h], 1.0 * h, str(h), "a", h) for h in range(60)]
    rows += [("x", t[h], 9.0, "9", "b", h) for h in range(0, 60, 3)]
    rows += [("y", t[h], None if h % 7 == 0 else 2.0, "junk" if h % 5 == 0 else "3", f, h) for h in range(40) for f in "cd"]
    rows += [(None, t[0], 1.0, "1", "e", 0), ("x", None, 1.0, "1", "e", 1), ("x", t[5], 5.0, "5", "a", 5)]
    return spark.createDataFrame(rows, RAW)


def test_counters_of_the_write_equal_a_scan_of_their_own(spark, tmp_path):
    path, rows = f"file://{tmp_path}/clean", raw(spark)
    got = write_clean(rows.withColumn("close", F.expr("try_cast(close_text as double)")).drop("close_text"), path, ["open", "close"])
    per = q.clean_counters(rows.filter("symbol is not null")).agg(*(F.sum(c).alias(c) for c in ("n_rows", "dropped_incomplete", "dropped_duplicate"))).first()
    # a row without a key is one more incomplete row
    assert (got["n_rows"], got["dropped_incomplete"], got["dropped_duplicate"]) == (per.n_rows + 1, per.dropped_incomplete + 1, per.dropped_duplicate)
    held = spark.read.parquet(path)
    assert got["inserted"] == held.count() == q.clean(rows.filter("symbol is not null")).count() == got["n_rows"] - got["dropped_incomplete"] - got["dropped_duplicate"]
    assert (got["first_ts"], got["last_ts"]) == tuple(held.agg(F.min("bar_ts"), F.max("bar_ts")).first())
    assert {x.file for x in held.filter("symbol = 'x'").select("file").distinct().collect()} == {"a"}


def test_counters_of_no_rows(spark, tmp_path):
    rows = raw(spark).withColumn("close", F.lit(1.0))
    for i, none in enumerate((rows.limit(0), rows.filter("symbol is null"))):
        got = write_clean(none, f"file://{tmp_path}/none{i}", ["open", "close"])
        assert got == {"n_rows": i, "dropped_incomplete": i, "dropped_duplicate": 0, "inserted": 0, "first_ts": None, "last_ts": None}


def test_an_entry_of_the_summary_tells_what_its_append_put_in(spark, tmp_path):
    schema = "symbol string, bar_ts timestamp_ntz, close double"
    bars = lambda hours: spark.createDataFrame([(s, DAY + timedelta(hours=h), 1.0) for s in "xy" for h in hours], schema)
    store = KeptStore(spark, f"file://{tmp_path}/store", T.StructType.fromDDL(schema))
    store.append(bars(range(50)), name="a")
    for _ in range(2):  # a repeated append tells the same
        store.append(bars(range(40, 90)), name="b")
        assert rows_of(store.appended("b")) == [(s, 40, DAY + timedelta(hours=50), DAY + timedelta(hours=89)) for s in "xy"]
    store.append(bars(range(5)), name="c")
    assert store.appended("c").isEmpty() and store.appended("no such").isEmpty()


def test_counters_of_a_stream_are_told_per_batch(spark, tmp_path):
    landing, out, work = (f"file://{tmp_path}/{x}" for x in ("landing", "out", "work"))
    schema, told = "id long, even boolean", []
    for n in (10, 25, 0):
        if n:
            spark.range(n).select("id", (F.col("id") % 2 == 0).alias("even")).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        got = run_counted(stream, lambda w: w.format("parquet").option("path", out).option("checkpointLocation", work), n=F.count("*"), even=F.count_if("even"))
        told.append(got)
    assert told == [{0: {"n": 10, "even": 5}}, {1: {"n": 25, "even": 13}}, {}]
