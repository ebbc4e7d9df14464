"""Hand-made rows: the small cases of FIXTURES.md and one case per quirk."""

import io
import time
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barstead.functions import scalars as S
from barstead.functions import schemas
from barstead.operators import quality as q
from barstead.operators import reconcile as r
from barstead.operators import snapshot as sn
from barstead.operators import store as st
from barstead.plans import pipelines as p
from barstead.sources import archives, payloads, text
from barstead.streaming import jobs

BAR = "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double, volume double"
DAY = datetime(2024, 1, 1)


def bars(spark, hours, symbol="x", off=0.0):
    rows = [(symbol, DAY + timedelta(hours=h), 100.0 + h, 102.0 + h, 98.0 + h, 101.0 + h + off, 10.0 + h) for h in hours]
    return spark.createDataFrame(rows, BAR)


def targets(spark, hour):
    return spark.createDataFrame([("x", DAY + timedelta(hours=hour))], "symbol string, target timestamp_ntz")


def hours_of(df):
    return sorted(int((x.bar_ts - DAY).total_seconds() // 3600) for x in df.collect())


def test_target_hour(spark):
    row = spark.range(1).select(S.hour_floor(F.lit("2024-01-15 14:23:45").cast("timestamp_ntz")).alias("f")).select("f", S.opens_at(F.col("f")).alias("t")).first()
    assert (row.f.hour, row.t.hour) == (14, 13)


def test_ceil_of_an_exact_hour_is_itself(spark):
    row = spark.range(1).select(S.hour_ceil(F.lit("2024-01-15 14:00:00").cast("timestamp_ntz")).alias("c"), S.hour_ceil(F.lit("2024-01-15 14:00:00.000001").cast("timestamp_ntz")).alias("d")).first()
    assert (row.c.hour, row.d.hour) == (14, 15)


def test_epochs_of_both_units_and_junk(spark):
    rows = spark.createDataFrame([("1704067200000",), ("1704067200000123",), ("x",), (None,)], "e string").select(S.epoch_ms(F.col("e")).alias("ms")).collect()
    assert [x.ms for x in rows] == [1704067200000, 1704067200000, None, None]


def test_last_n_before(spark):
    assert hours_of(st.last_n(bars(spark, [7, 8, 9, 10]), 2, before="2024-01-01 10:00:00")) == [8, 9]


def test_append_is_idempotent_and_fills_holes(spark):
    store = bars(spark, [8, 10])
    delta = st.append_absent(bars(spark, [8, 9, 10, 11]), store)
    assert hours_of(delta) == [9, 11]
    assert hours_of(st.append_absent(bars(spark, [9, 11]), store.union(delta))) == []
    assert hours_of(st.append_newer(bars(spark, [8, 9, 10, 11]), store)) == [11]
    assert hours_of(st.append_newer(bars(spark, [8, 9]), bars(spark, []))) == [8, 9]


def test_insert_or_ignore_skips_null_and_nan(spark):
    rows = [("x", DAY, 1.0, "b", 0), ("x", DAY, 2.0, "a", 0), ("x", DAY + timedelta(hours=1), float("nan"), "a", 1), ("x", DAY + timedelta(hours=2), None, "a", 2)]
    batch = spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, close double, file string, line_no int")
    got = st.insert_or_ignore(batch, batch.limit(0), ["close"]).collect()
    assert [(x.close, x.file) for x in got] == [(2.0, "a")]


@pytest.mark.parametrize(
    ("batch", "off", "held", "reason", "validated"),
    [
        ([8, 9, 10], 0.0, [8, 9], "validated", 2),
        ([8, 9, 10], 0.01, [8, 9], "mismatch in close", 0),
        ([8, 9, 10], 0.0, [7, 8], "times differ", 0),
        ([8, 9, 10], 0.0, [9], "store too short", 0),
        ([7, 9, 10], 0.0, [8, 9], "not hourly", 0),
        ([8, 9], 0.0, [8, 9], "last row is not the target", 0),
        ([10], 0.0, [8, 9], "no history", 0),
        ([], 0.0, [8, 9], "empty batch", 0),
    ],
)
def test_validation_reasons(spark, batch, off, held, reason, validated):
    row = r.validate_window(bars(spark, batch, off=off), bars(spark, held), targets(spark, 10)).first()
    assert (row.reason, row.validated, row.ok) == (reason, validated, reason in ("validated", "no history"))


def test_nan_difference_passes_unless_all_are_nan(spark):
    nan = bars(spark, [8, 9, 10]).withColumn("close", F.when(F.hour("bar_ts") == 8, float("nan")).otherwise(F.col("close")))
    assert r.validate_window(nan, bars(spark, [8, 9]), targets(spark, 10)).first().reason == "validated"
    all_nan = bars(spark, [8, 9, 10]).withColumn("close", F.lit(float("nan")))
    assert r.validate_window(all_nan, bars(spark, [8, 9]), targets(spark, 10)).first().reason == "NaN in close"


def test_overlap(spark):
    verdict = lambda batch, held: r.validate_overlap(bars(spark, batch), held).first().reason
    assert verdict([8, 9, 10, 11], bars(spark, [8, 9, 10])) == "validated"
    assert verdict([8, 9, 10, 11], bars(spark, [8, 10])) == "not hourly"
    assert verdict([8, 9], bars(spark, [])) == "empty store"
    assert verdict([8, 9], bars(spark, [1, 2])) == "no overlap"
    assert verdict([9, 10, 11], bars(spark, [9]).union(bars(spark, [10], off=0.5))) == "mismatch at target"


def test_catch_up(spark):
    row = p.catch_up(bars(spark, [8, 9, 10, 11]), bars(spark, [8, 9]), 10).first()
    assert (row.ok, row.appended) == (True, 2)
    assert hours_of(p.recent_delta(bars(spark, [8, 9, 10, 11]), bars(spark, [8, 9]), validate=True)) == [10, 11]
    assert p.catch_up(bars(spark, [8, 9]), bars(spark, []), 10).first().reason == "empty store"
    assert p.catch_up(bars(spark, [8, 9, 10, 11]), bars(spark, [8, 10]), 10).first().ok is False


def test_append_target_bootstraps(spark):
    assert hours_of(p.append_target(bars(spark, [8, 9, 10]), bars(spark, []), targets(spark, 10))) == [10]
    assert hours_of(p.append_target(bars(spark, [8, 9, 10]), bars(spark, [8, 9], off=1.0), targets(spark, 10))) == []


def test_gaps_are_stitched_over_days(spark):
    rows = bars(spark, [22, 23, 24, 25, 50])
    assert q.gap_count(rows).first().gaps == 1
    assert [x.diff_s for x in q.gap_rows(rows).collect()] == [25 * 3600]
    assert q.gap_count(bars(spark, [1, 1, 2])).first().gaps == 1
    with pytest.raises(ValueError, match="gaps"):
        q.stop_on_gap(rows)


def test_snapshot_provenance(spark):
    at = lambda m: DAY + timedelta(minutes=m)
    rows = spark.createDataFrame([("x", at(0), 1.0), ("x", at(50), 2.0), ("x", at(55), 3.0), ("x", at(180), 4.0), ("x", at(185), 5.0)], "symbol string, ts timestamp_ntz, v double")
    got = {x.snapshot_time.hour: (x.provenance, x.v, x.is_fallback) for x in sn.hourly_snapshot(rows, ["v"]).collect()}
    assert got == {0: ("exact", 1.0, False), 1: ("fallback", 3.0, True), 2: ("missing", None, True), 3: ("exact", 4.0, False), 4: ("fallback", 5.0, True)}


def test_clean_of_empty_input_is_empty(spark):
    empty = spark.createDataFrame([], "symbol string, bar_ts timestamp_ntz, open double, close_text string, file string, line_no int")
    assert q.clean(empty).count() == 0


def test_reconcile_counts_nan_as_matched(spark):
    a, b = bars(spark, [1, 2, 3]), bars(spark, [2, 3, 4]).withColumn("close", F.when(F.hour("bar_ts") == 2, float("nan")).otherwise(F.col("close") + 1))
    x = r.reconcile(a, b, [("close", 0.01)]).first()
    assert (x.compared, x.matched, x.mismatched, x.archive_only, x.feed_only, x.max_diff) == (2, 1, 1, 1, 1, 1.0)


def zipped(name, body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(name, body)
    return out.getvalue()


def test_zip_round_trip_from_files(spark, tmp_path):
    line = "1704067200000,1,2,0.5,1.5,10,1704070799999,0,3,0,0,0"
    (tmp_path / "x-1h-2024-01-02.zip").write_bytes(zipped("a.CSV", "﻿" + ",".join(schemas.KLINE_COLUMNS) + "\r\n" + line + "\r\n\r\n"))
    (tmp_path / "x-1h-2024-01.zip").write_bytes(zipped("a.csv", line + "\n1,2\n"))
    (tmp_path / "none-1h-2024-01.zip").write_bytes(zipped("a.txt", line))
    (tmp_path / "bad-1h-2024-01.zip").write_bytes(b"not a zip")
    files = archives.read_archives(spark, str(tmp_path))
    lines = archives.zip_lines(files)
    assert sorted((x.file, x.line_no) for x in lines.collect()) == [("bad-1h-2024-01.zip", -1), ("x-1h-2024-01-02.zip", 0), ("x-1h-2024-01-02.zip", 1), ("x-1h-2024-01.zip", 0), ("x-1h-2024-01.zip", 1)]
    assert [x.file for x in archives.rejected_archives(lines).collect()] == ["bad-1h-2024-01.zip"]
    typed = archives.zip_klines(files).collect()
    assert sorted((x.file, x.close, x.number_of_trades) for x in typed) == [("x-1h-2024-01-02.zip", 1.5, 3), ("x-1h-2024-01.zip", 1.5, 3)]
    first = q.dedupe_first(archives.zip_klines(files), ["open_time"])
    assert first.first().file == "x-1h-2024-01-02.zip"


def test_names_and_periods(spark):
    rows = spark.createDataFrame([("BTC-1h-2024-01.zip",), ("BTC-metrics-2024-01-05.zip",), ("readme.txt",)], "file string")
    got = [(x.symbol, x.kind, x.period, x.daily) for x in archives.parse_names(rows).collect()]
    assert got[:2] == [("BTC", "1h", "2024-01", False), ("BTC", "metrics", "2024-01-05", True)] and got[2][0] is None
    spans = spark.sql("select 'x' as symbol, date'2023-11-15' as start, date'2024-01-01' as end union all select 'y', date'2024-02-01', date'2024-01-01'")
    assert sorted(x.period for x in archives.expected_periods(spans, daily=False).collect()) == ["2023-11", "2023-12", "2024-01"]


def test_lenient_csv_rejects_single_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\nx,3\n4,5\n")
    good, bad = text.lenient_csv(spark, str(tmp_path), spark.createDataFrame([], "a int, b int").schema)
    assert sorted(x.a for x in good.collect()) == [1, 4]
    assert [x.line for x in bad.collect()] == ["x,3"]


def test_payload_kinds(spark):
    p1 = spark.createDataFrame([('[[1704067200000,"1","2","0.5","1.5","10",1704070799999,"7",3,"4","5","0"]]',), ("[]",)], "payload string")
    assert payloads.klines(p1).first().close == 1.5
    premium = payloads.klines(p1, kind="premium").first()
    assert (premium.volume, premium.num_trades) == (0.0, None)
    assert "quote_asset_volume" not in payloads.klines(p1, kind="spot").columns


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="volume"):
        schemas.require(bars(spark, [1]).drop("volume"), ["open", "volume"])


def test_overwrite_guard(spark, tmp_path):
    text.write_csv(bars(spark, [1]), f"{tmp_path}/out")
    with pytest.raises(Exception, match="exists|EXISTS"):
        text.write_csv(bars(spark, [1]), f"{tmp_path}/out")
    text.write_csv(bars(spark, [1]), f"{tmp_path}/out", overwrite=True)


def test_stream_policies(spark, tmp_path):
    early, late = bars(spark, [1, 2, 4]).select("symbol", "bar_ts", "close"), bars(spark, [2, 3, 4, 5]).select("symbol", "bar_ts", "close")
    for policy, want in (("absent", [1, 2, 3, 4, 5]), ("newer", [1, 2, 4, 5])):
        landing = f"{tmp_path}/{policy}/landing"
        early.coalesce(1).write.parquet(landing)
        jobs.ingest(spark, landing, early.schema, f"{tmp_path}/{policy}/store", f"{tmp_path}/{policy}/work", policy=policy)
        late.coalesce(1).write.mode("append").parquet(landing)
        got = jobs.ingest(spark, landing, early.schema, f"{tmp_path}/{policy}/store", f"{tmp_path}/{policy}/work", policy=policy)
        assert hours_of(got) == want


def test_first_landed_writer_wins(spark, tmp_path):
    one, two = (bars(spark, [1, 2], off=x).select("symbol", "bar_ts", "close").coalesce(1) for x in (0.0, 7.0))
    two.union(two).coalesce(1).write.parquet(f"{tmp_path}/landing")
    time.sleep(1.1)  # modification times of some file systems are whole seconds
    one.write.mode("append").parquet(f"{tmp_path}/landing")
    got = jobs.ingest(spark, f"{tmp_path}/landing", one.schema, f"{tmp_path}/store", f"{tmp_path}/work").collect()
    assert sorted(x.close for x in got) == [109.0, 110.0]


def test_late_rows_of_the_bounded_variant(spark, tmp_path):
    schema = "symbol string, bar_ts timestamp_ntz"
    for hours in ([1, 2], [40, 40], [3, 41]):
        bars(spark, hours).select("symbol", "bar_ts").coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        stream = jobs.dedupe_within(spark.readStream.schema(schema).parquet(f"{tmp_path}/landing"), ["symbol"], "bar_ts", "5 hours")
        sink = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/work")
        sink.trigger(availableNow=True).start().awaitTermination()
    assert hours_of(spark.read.schema(schema).parquet(f"{tmp_path}/out")) == [1, 2, 40, 41]  # hour 3 came too late


def test_rows_without_time_or_key_stay_and_never_enter_the_store(spark):
    rows = spark.createDataFrame([("x", DAY), ("x", None), (None, DAY), ("x", DAY + timedelta(hours=1))], "symbol string, bar_ts timestamp_ntz")
    got = {x.symbol: (x.gaps, x.n_rows) for x in q.gap_count(rows).collect()}
    assert got == {"x": (0, 3), None: (0, 1)}
    assert hours_of(st.append_absent(rows, rows.limit(0))) == [0, 1]


def test_numbers_are_finite(spark):
    rows = spark.createDataFrame([("1.5",), ("Infinity",), ("-inf",), ("NaN",), ("x",), (None,)], "t string").select(S.number(F.col("t")).alias("n")).collect()
    assert [x.n for x in rows] == [1.5, None, None, None, None, None]


def test_strict_casts_stop_the_job(spark):
    ok = spark.createDataFrame([("12.0", "1.5"), (None, None)], "n string, v string")
    assert [(x.n, x.v) for x in ok.select(S.strict_count(F.col("n")).alias("n"), S.strict_number(F.col("v")).alias("v")).collect()] == [(12, 1.5), (None, None)]
    for strict in (S.strict_count, S.strict_number):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            spark.createDataFrame([("x",)], "n string").select(strict(F.col("n"))).collect()


def test_damaged_member_gives_no_row(spark):
    body = "\n".join(f"{1704067200000 + i},1,2,0.5,1.5,10,1704070799999,0,3,0,0,0" for i in range(3000))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", body)
    good = out.getvalue()
    broken = bytearray(good)
    broken[len(good) // 2 : len(good) // 2 + 40] = b"\xff" * 40
    latin = zipped("a.csv", b"1,2\n\xff\xfe,3\n")
    rows = spark.createDataFrame([("good.zip", good), ("broken.zip", bytes(broken)), ("latin.zip", latin), ("empty.zip", b"")], "file string, content binary")
    lines = archives.zip_lines(rows)
    assert sorted(x.file for x in archives.rejected_archives(lines).collect()) == ["broken.zip", "empty.zip", "latin.zip"]
    assert {x.file for x in archives.zip_klines(rows).collect()} == {"good.zip"} and archives.zip_klines(rows).count() == 3000


def test_merged_header_rules(spark):
    rows = [("a.zip", 0, "create_time,v"), ("a.zip", 1, "1,2"), ("b.zip", 0, "create_time,v"), ("b.zip", 1, "3,4")]
    merge = lambda own, **more: sorted((not x.is_header, x.line) for x in archives.merged_lines(spark.createDataFrame(own, "file string, line_no long, line string"), **more).collect())
    assert merge(rows) == [(False, "create_time,v"), (True, "1,2"), (True, "3,4")]
    head = ",".join(schemas.KLINE_COLUMNS)
    premium = [("a.zip", 0, "1,2"), ("b.zip", 0, "open_time,open"), ("b.zip", 1, "3,4")]
    assert merge(premium, may_lack_header=True) == [(False, head), (True, "1,2"), (True, "3,4")]
    assert merge(premium[1:], may_lack_header=True) == [(False, "open_time,open"), (True, "3,4")]
    assert merge([]) == []


def test_absent_metric_is_null_and_the_first_exact_row_counts(spark):
    rows = spark.createDataFrame([("x", DAY, 9.0, "b"), ("x", DAY, 5.0, "c"), ("x", DAY, 7.0, "a")], "symbol string, ts timestamp_ntz, sum_open_interest double, file string")
    got = sn.hourly_snapshot(rows, order=["file"]).first()
    assert got.sum_open_interest == 7.0 and got.sum_taker_long_short_vol_ratio is None
    assert set(sn.METRICS) <= set(got.asDict())


def test_store_with_later_rows_only_has_no_overlap(spark):
    row = r.validate_overlap(bars(spark, [8, 9]), bars(spark, [20, 21])).first()
    assert (row.reason, row.ok) == ("no overlap", False)


def test_two_intervals_in_one_store(spark):
    """A minute series and an hour series of one symbol never meet: gaps, validation, catch-up, appends."""
    step = schemas.step_of(F.col("interval"))
    keys = schemas.STORE_KEYS

    def both(hours, minutes, off=0.0):
        h = bars(spark, hours).withColumn("interval", F.lit("1h"))
        m = spark.createDataFrame([("x", DAY + timedelta(minutes=k), *[200.0 + k + off] * 5) for k in minutes], BAR).withColumn("interval", F.lit("1m"))
        return h.unionByName(m)

    batch, held = both([8, 9, 10, 11], [480, 481, 482, 483]), both([8, 9, 10], [480, 481])
    assert {(x.interval, x.gaps) for x in q.gap_count(batch, keys, step=step).collect()} == {("1h", 0), ("1m", 0)}
    verdicts = {x.interval: (x.reason, x.validated) for x in r.validate_overlap(batch, held, keys=keys, step=step).collect()}
    assert verdicts == {"1h": ("validated", 2), "1m": ("validated", 1)}
    ends = spark.createDataFrame([("x", "1h", DAY + timedelta(hours=11)), ("x", "1m", DAY + timedelta(minutes=483))], "symbol string, interval string, target timestamp_ntz")
    got = {x.interval: x.reason for x in r.validate_window(batch, held, ends, keys=keys, step=step).collect()}
    assert got == {"1h": "validated", "1m": "store too short"}
    rows = lambda df: sorted((x.interval, x.open) for x in df.collect())
    assert rows(p.recent_delta(batch, held, True, keys, step=step)) == [("1h", 111.0), ("1m", 682.0), ("1m", 683.0)]
    assert {x.interval: x.appended for x in p.catch_up(batch, held, 10, keys=keys, step=step).collect()} == {"1h": 1, "1m": 2}
    assert rows(p.append_target(batch, held, ends, keys=keys, step=step)) == [("1h", 111.0)]
    assert rows(p.recent_delta(batch, both([8, 9, 10], [480, 481], off=1.0), True, keys, step=step)) == [("1h", 111.0)]


def test_rank_bound_is_a_constant(spark):
    """Each task keeps the last rows of a series before rows move: the plan has a group limit."""
    df = r.validate_window(bars(spark, [8, 9, 10]), bars(spark, range(8)), targets(spark, 10))
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_day_slices_of_a_store(spark, tmp_path):
    rows = bars(spark, [1, 30, 60]).withColumnRenamed("bar_ts", "timestamp").withColumn("interval", F.lit("1m")).withColumn("close", F.when(F.col("open") < 140, F.col("close")))
    path, schema = f"{tmp_path}/store", schemas.STORES["ohlcv_1m"]
    assert st.read_store(spark, path, schema).count() == 0
    st.write_append(rows, path, "ohlcv_1m")
    held = st.read_store(spark, path, schema)
    assert held.columns == schema.names and sorted(x.open for x in held.collect()) == [101.0, 130.0]  # the row without a price was ignored
    part = st.read_store(spark, path, schema, (DAY + timedelta(hours=25), DAY + timedelta(hours=40)))
    assert [x.open for x in part.collect()] == [130.0] and "PartitionFilters: [isnotnull(day" in part._jdf.queryExecution().executedPlan().toString()
