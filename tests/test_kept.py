"""Stores with a summary, incremental snapshots, digests, archives as a stream, quarantine and the gap monitor."""

import io
import random
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstead.operators import quality as q
from barstead.operators import reconcile as r
from barstead.operators import snapshot as sn
from barstead.operators import store as st
from barstead.operators.kept import KeptStore
from barstead.plans import pipelines as p
from barstead.streaming import archives as sa
from barstead.streaming import gaps

DAY = datetime(2024, 1, 1)
BAR = "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double, volume double"


def bars(spark, hours, symbols=("x",), off=0.0):
    rows = [(s, DAY + timedelta(hours=h), 100.0 + h, 102.0 + h, 98.0 + h, 101.0 + h + off, 10.0 + h) for s in symbols for h in hours]
    return spark.createDataFrame(rows, BAR)


def kept(spark, path, schema=BAR, **more):
    return KeptStore(spark, f"file://{path}/store", T.StructType.fromDDL(schema), **more)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hours_of(df):
    return sorted(int((x.bar_ts - DAY).total_seconds() // 3600) for x in df.collect())


# ---------------------------------------------------------------- keys


def repeated(spark):
    null = spark.createDataFrame([("x", None, *[1.0] * 5), (None, DAY, *[1.0] * 5)], BAR)
    return bars(spark, [8, 9, 10]).union(bars(spark, [9, 10], off=5.0)).union(null)


@pytest.mark.parametrize("policy", ["absent", "newer"])
def test_no_policy_lets_a_key_in_twice_or_incomplete(spark, tmp_path, policy):
    append = st.append_absent if policy == "absent" else st.append_newer
    for batch in (repeated(spark), repeated(spark).union(repeated(spark))):
        got = append(batch, bars(spark, [7, 8]))
        assert hours_of(got) == [9, 10] and {x.close - x.open for x in got.collect()} == {1.0}
    store = kept(spark, tmp_path)
    store.append(bars(spark, [7, 8]))
    assert hours_of(store.append(repeated(spark), policy)) == [9, 10]
    assert hours_of(p.recent_delta(repeated(spark), store)) == [] and hours_of(store.read()) == [7, 8, 9, 10]


def test_first_writer_needs_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        st.insert_or_ignore(bars(spark, [1]), bars(spark, []), ["close"], order=())


# ---------------------------------------------------------------- kept summary


def test_out_of_order_appends_equal_the_full_scan(spark, tmp_path):
    store, rng = kept(spark, tmp_path), random.Random(2)
    hours = list(range(0, 400))
    rng.shuffle(hours)
    for i in range(4):
        store.append(bars(spark, hours[i * 90 : i * 90 + 100], ("x", "y") if i % 2 else ("x", "z")))
        assert rows_of(store.coverage()) == rows_of(st.coverage(store.read()))
        assert store.unequal_days().isEmpty()
    batch = bars(spark, range(300, 420), ("x", "y", "new"))
    assert rows_of(p.recent_delta(batch, store)) == rows_of(st.append_newer(batch, store.read()))
    before = rows_of(store.coverage())
    store.compact()
    assert rows_of(store.coverage()) == before
    store.rebuild()
    assert rows_of(store.coverage()) == before


def test_an_append_that_failed_is_repeated_under_its_name(spark, tmp_path):
    store = kept(spark, tmp_path)
    store.append(bars(spark, range(5)), name="a")
    # rows were appended, the summary wasn't
    delta = f"{store.path}.delta/b"
    bars(spark, range(5, 9)).write.parquet(delta)
    st.write_append(spark.read.schema(BAR).parquet(delta).filter("hour(bar_ts) < 7"), store.path, ts="bar_ts")
    assert not store.unequal_days().isEmpty()
    for _ in range(2):
        store.append(bars(spark, range(5, 9), off=3.0), name="b")
        assert hours_of(store.read()) == list(range(9)) and store.unequal_days().isEmpty()
        assert {x.close - x.open for x in store.read().collect()} == {1.0}


def test_a_store_without_summary_gets_one(spark, tmp_path):
    store = kept(spark, tmp_path)
    assert store.coverage().isEmpty() and store.read().isEmpty()
    st.write_append(bars(spark, range(30)), store.path, ts="bar_ts")
    assert store.coverage().first().n_rows == 30
    assert hours_of(store.append(bars(spark, range(28, 33)), "newer")) == [30, 31, 32]


@pytest.mark.parametrize(("held", "off"), [(range(0, 24 * 40), 0.0), ([*range(0, 700), *range(720, 950)], 0.0), (range(0, 24 * 40), 0.5)])
def test_validation_reads_the_days_of_the_tail(spark, tmp_path, held, off):
    store = kept(spark, tmp_path)
    store.append(bars(spark, held, ("x", "y")))
    batch = bars(spark, range(900, 960), ("x", "y", "new"), off)
    ends = batch.groupBy("symbol").agg(F.max("bar_ts").alias("target"))
    assert rows_of(store.validate_window(batch, ends)) == rows_of(r.validate_window(batch, store.read(), ends))
    assert rows_of(store.validate_overlap(batch)) == rows_of(r.validate_overlap(batch, store.read()))
    assert rows_of(p.catch_up(batch, store, 60)) == rows_of(p.catch_up(batch, store.read(), 60))
    assert rows_of(p.append_target(batch, store, ends)) == rows_of(p.append_target(batch, store.read(), ends))
    assert rows_of(p.recent_delta(batch, store, validate=True)) == rows_of(p.recent_delta(batch, store.read(), validate=True))


def test_tail_plan_is_pruned(spark, tmp_path):
    store = kept(spark, tmp_path)
    store.append(bars(spark, range(24 * 40)))
    ends = spark.createDataFrame([("x", DAY + timedelta(hours=24 * 40))], "symbol string, target timestamp_ntz")
    days = store.days_of_tails(ends, "target", 72)
    assert days[0] >= date(2024, 2, 5) and len(days) <= 4
    assert "PartitionFilters: [" in (plan := plan_of(store.read(days))) and "day#" in plan.split("PartitionFilters: [")[1]
    files = {x.f for x in store.read(days).select(F.input_file_name().alias("f")).distinct().collect()}
    assert 1 <= len(files) <= 4


def test_a_day_has_several_writers(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(200_000).select(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")).alias("symbol"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("bar_ts"), F.rand(1).alias("close"))
    spark.conf.set(key, "256k")
    try:
        st.write_append(rows, f"{tmp_path}/wide", ts="bar_ts")
    finally:
        spark.conf.unset(key)
    assert spark.read.parquet(f"{tmp_path}/wide").select(F.input_file_name().alias("f")).distinct().count() > 2
    assert spark.read.parquet(f"{tmp_path}/wide").count() == 200_000


# ---------------------------------------------------------------- incremental snapshot

FIVE = "symbol string, ts timestamp_ntz, v double"


def metrics(spark, minutes, symbol="x"):
    return spark.createDataFrame([(symbol, DAY + timedelta(minutes=m), float(m)) for m in minutes], FIVE)


@pytest.mark.parametrize("seed", range(2))
def test_refreshed_snapshot_equals_a_full_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    raw = kept(spark, tmp_path, FIVE, ts="ts")
    path = f"file://{tmp_path}/snap"
    minutes = [m for m in range(0, 3 * 1440, 5) if rng.random() < 0.2] + [3 * 1440 + 600]
    rng.shuffle(minutes)
    for i in range(3):
        batch = metrics(spark, minutes[i::3]).union(metrics(spark, minutes[i::3][:5], f"s{i}"))
        assert sn.refresh_snapshot(raw, batch, path, ["v"], name=f"n{i}")
        full = sn.hourly_snapshot(raw.read(), ["v"], ts="ts")
        assert rows_of(sn.read_snapshot(spark, path, full.schema)) == rows_of(full)
    # again under the same name: nothing changes
    sn.refresh_snapshot(raw, batch, path, ["v"], name="n2")
    assert rows_of(sn.read_snapshot(spark, path, full.schema)) == rows_of(full)


def test_untouched_days_keep_their_files(spark, tmp_path):
    raw, path = kept(spark, tmp_path, FIVE, ts="ts"), f"file://{tmp_path}/snap"
    sn.refresh_snapshot(raw, metrics(spark, range(0, 10 * 1440, 30)), path, ["v"])
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "snap").rglob("*.parquet")}
    before = files()
    assert sn.refresh_snapshot(raw, metrics(spark, [4 * 1440 + 1435]), path, ["v"]) == [date(2024, 1, 6)]
    changed = {f.split("day=")[1][:10] for f in set(before) ^ set(files())}
    assert changed == {"2024-01-06"}


# ---------------------------------------------------------------- digests


def test_digest_report_is_the_same_and_joins_less(spark):
    a = bars(spark, range(240), ("x", "y"))
    b = bars(spark, range(240), ("x",)).union(bars(spark, range(100, 300), ("y", "z")))
    b = b.withColumn("close", F.when((F.col("symbol") == "x") & (F.col("bar_ts") == DAY + timedelta(hours=50)), F.col("close") + 1).otherwise(F.col("close")))
    b = b.withColumn("close", F.when(F.hour("bar_ts") == 5, float("nan")).otherwise(F.col("close"))).withColumn("volume", F.lit(0.0))
    a = a.withColumn("close", F.when(F.hour("bar_ts") == 5, float("nan")).otherwise(F.col("close")))
    columns = [("close", 0.01)]
    got, apart = r.reconcile_by_digest(a, b.repartition(7), columns)
    assert rows_of(got) == rows_of(r.reconcile(a, b, columns))
    days = {(x.symbol, x.day.day) for x in apart.collect() if x.symbol == "x"}
    assert days == {("x", 3)}
    same, none = r.reconcile_by_digest(a, a, columns, archive_digests=r.day_digests(a, ["close"]))
    assert none.isEmpty() and rows_of(same) == rows_of(r.reconcile(a, a, columns))
    empty, _ = r.reconcile_by_digest(a.limit(0), a.limit(0), columns)
    assert empty.isEmpty()


# ---------------------------------------------------------------- archives as a stream


def land_zip(folder, name, hours, member="bars.csv", close=1.0):
    ms = lambda h: int((DAY + timedelta(hours=h) - datetime(1970, 1, 1)).total_seconds() * 1000)
    body = "\n".join(f"{ms(h)},1,2,0.5,{close},10,{ms(h) + 3599999},0,5,0,0,0" for h in hours)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(member, body)
    (folder / name).write_bytes(out.getvalue())


def test_archives_are_taken_once(spark, tmp_path, monkeypatch):
    landing = tmp_path / "zips"
    landing.mkdir()
    store = kept(spark, tmp_path, "symbol string, `interval` string, bar_ts timestamp_ntz, close double", keys=("symbol", "interval"))
    work = f"file://{tmp_path}/work"
    run = lambda: sa.ingest_archives(sa.landed_archives(spark, f"file://{landing}", files_per_batch=2), store, work)
    land_zip(landing, "AB-1h-2024-01-01.zip", range(0, 24))
    land_zip(landing, "AB-1h-2024-01-02.zip", range(20, 48), close=7.0)
    land_zip(landing, "CD-1h-2024-01-01.zip", range(0, 3), member="readme.txt")
    (landing / "EF-1h-2024-01-01.zip").write_bytes(b"no archive")
    assert hours_of(run()) == list(range(48))
    assert {x.file: (x.state, x.lines) for x in sa.taken_archives(spark, work).collect()} == {
        "AB-1h-2024-01-01.zip": ("taken", 24), "AB-1h-2024-01-02.zip": ("taken", 28), "CD-1h-2024-01-01.zip": ("no CSV member", 0), "EF-1h-2024-01-01.zip": ("damaged", 0),
    }
    batches = sa.taken_archives(spark, work).select("batch").distinct().count()
    monkeypatch.setattr(sa.archives, "zip_lines", lambda *_, **__: pytest.fail("unzipped again"))
    assert hours_of(run()) == list(range(48))
    monkeypatch.undo()
    land_zip(landing, "AB-1h-2024-01-03.zip", range(40, 50), close=9.0)
    assert hours_of(run()) == list(range(50))
    assert sa.taken_archives(spark, work).select("batch").distinct().count() == batches + 1
    assert [x.close for x in store.read().orderBy("bar_ts").collect()][48:] == [9.0, 9.0]


# ---------------------------------------------------------------- quarantine


def test_bad_series_land_in_quarantine_once(spark, tmp_path):
    store = kept(spark, tmp_path)
    store.append(bars(spark, range(100), ("good", "bad")))
    landing, work = f"file://{tmp_path}/landing", f"file://{tmp_path}/work"
    batch = bars(spark, range(80, 104), ("good", "new")).union(bars(spark, range(80, 104), ("bad",), off=1.0))
    batch.coalesce(1).write.parquet(landing)
    run = lambda: sa.ingest_validated(spark.readStream.schema(BAR).parquet(landing), store, work)
    got = run()
    assert {x.symbol: x.n for x in got.groupBy("symbol").agg(F.count("*").alias("n")).collect()} == {"good": 104, "bad": 100, "new": 24}
    held = sa.quarantined(store, work)
    assert {(x.symbol, x.reason) for x in held.collect()} == {("bad", "mismatch in close")} and held.count() == 24
    batch.coalesce(1).write.mode("append").parquet(landing)  # a second delivery of the same rows
    assert run().count() == 228
    assert sa.quarantined(store, work).select("batch").distinct().count() == 2


# ---------------------------------------------------------------- gap monitor


@pytest.mark.parametrize("seed", range(2))
def test_gap_monitor_equals_the_batch_form(spark, tmp_path, seed):
    rng = random.Random(seed)
    hours = [h for h in range(0, 120) if rng.random() < 0.85] + [50, 51]
    order = sorted(hours, key=lambda h: h + rng.uniform(0, 30))
    landing, out, work = (f"file://{tmp_path}/{x}" for x in ("landing", "out", "work"))
    (tmp_path / "landing").mkdir()
    stream = spark.readStream.schema(BAR).option("maxFilesPerTrigger", 1).parquet(landing)
    watched = gaps.watch(stream, delay="48 hours", patience=24 * 3600)
    parts = [bars(spark, order[i * 30 : i * 30 + 30], ("x", "y")) for i in range(5)]
    for part in [*parts, bars(spark, [1000], ("clock",)), bars(spark, [1001], ("clock",))]:
        part.coalesce(1).write.mode("append").parquet(landing)
        told = gaps.watch_to_end(spark, watched, out, work)
    want = q.gap_rows(bars(spark, hours, ("x", "y"))).select("symbol", "prev_ts", F.col("bar_ts").alias("ts"), "diff_s")
    assert rows_of(told.filter("kind = 'gap' and symbol <> 'clock'").drop("kind")) == rows_of(want)
    opened, closed, final = ({k: told.filter(F.col("kind") == k).filter("symbol = 'x'").count() for k in ("opened", "closed", "gap")}[k] for k in ("opened", "closed", "gap"))
    assert opened - closed == final and closed > 0
    assert {x.symbol for x in told.filter("kind = 'silent'").collect()} >= {"x", "y"}
