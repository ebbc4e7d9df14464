"""Queries of sources and sinks. Their files and payloads are made by Spark from ``events``."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import schemas
from ..operators import store as st
from ..operators.kept import KeptStore
from ..operators.shared import shared_path
from ..sources import archives, payloads, text
from ..streaming import archives as archive_jobs
from . import fixtures as fx
from .book import query

# ---------------------------------------------------------------- archives


def open_ms():
    return F.unix_millis(F.col("bar_ts").cast("timestamp"))


@F.pandas_udf(T.BinaryType())
def _zipped(bodies: pd.Series) -> pd.Series:
    def one(body: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            info = zipfile.ZipInfo("bars.CSV", (2024, 1, 1, 0, 0, 0))
            z.writestr(info, "﻿" + body)
        return out.getvalue()

    return bodies.map(one)


def kline_line():
    """A bar as a line of twelve fields; microseconds every fifth hour."""
    scale = F.when(F.hour("bar_ts") % 5 == 0, 1000).otherwise(1)
    price = lambda c: F.round(c, 6).cast("decimal(20,6)").cast("string")
    return F.concat_ws(
        ",", (open_ms() * scale).cast("string"), price("open"), price("high"), price("low"), price("close"), price("volume"), ((open_ms() + 3599999) * scale).cast("string"), F.lit("0"), F.col("num_trades").cast("string"), F.lit("0"), F.lit("0"), F.lit("0")
    )


def archive_files(spark, d, bars=fx.candles, interval="1h"):
    """An archive per series and day, (file, content); even days have a header, lines end in CR LF."""
    header = F.when(F.dayofmonth("day") % 2 == 0, F.lit(",".join(schemas.KLINE_COLUMNS)))
    lines = bars(spark, d).groupBy("symbol", F.to_date("bar_ts").alias("day")).agg(F.array_sort(F.collect_list(kline_line())).alias("lines"))
    body = F.concat(F.array_join(F.concat(F.filter(F.array(header), lambda h: h.isNotNull()), F.col("lines")), "\r\n"), F.lit("\r\n\r\n"))
    return lines.select(F.concat_ws("-", "symbol", F.lit(interval), F.date_format("day", "yyyy-MM-dd")).alias("name"), body.alias("body")).select(F.concat("name", F.lit(".zip")).alias("file"), _zipped("body").alias("content"))


def archive_names(spark, d, bars=fx.candles, interval="1h"):
    """The names alone of ``archive_files``."""
    days = bars(spark, d).select("symbol", F.to_date("bar_ts").alias("day")).distinct()
    return days.select(F.concat_ws("-", "symbol", F.lit(interval), F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(".zip"))).alias("file"))


LINES = """, line as (
  select symbol, bar_ts, symbol || '-1h-' || strftime(bar_ts, '%Y-%m-%d') || '.zip' as file, day(bar_ts) % 2 as odd,
    concat_ws(',', epoch_ms(bar_ts) * s, p(open), p(high), p(low), p(close), p(volume), (epoch_ms(bar_ts) + 3599999) * s, '0', num_trades, '0', '0', '0') as line
  from (select *, case when hour(bar_ts) % 5 = 0 then 1000 else 1 end as s from candles))
"""
for _c in ("open", "high", "low", "close", "volume"):
    LINES = LINES.replace(f"p({_c})", f"cast(cast(round({_c}, 6) as decimal(20, 6)) as varchar)")
HEAD = ",".join(schemas.KLINE_COLUMNS)


@query(LINES + f"select file, line from line union all select distinct file, '{HEAD}' from line where odd = 0")
def zip_lines(spark, d):
    return archives.zip_lines(archive_files(spark, d)).select("file", "line")


TYPED = LINES + """, f as (select file, string_split(line, ',') as x from line),
 typed as (select file, x[1]::bigint as open_time, x[2]::double as open, x[3]::double as high, x[4]::double as low, x[5]::double as close, x[6]::double as volume, x[7]::bigint as close_time, x[9]::bigint as number_of_trades from f)
"""
_TYPED = ["file", "open_time", "open", "high", "low", "close", "volume", "close_time", "number_of_trades"]


@query(TYPED + "select * from typed")
def zip_klines(spark, d):
    return archives.zip_klines(archive_files(spark, d)).select(*_TYPED)


MERGED = TYPED + """, merged as (select *, case when open_time > 1000000000000000 then open_time // 1000 else open_time end as ms from typed)
"""


def merged_klines(spark, d):
    """Archives of all series in one table: epochs in milliseconds, UTC text, range flag."""
    rows = archives.zip_klines(archive_files(spark, d))
    ms = S.epoch_ms(F.col("open_time").cast("string"))
    return rows.withColumn("ms", ms).withColumn("datetime_utc", S.utc_text(S.from_ms(F.col("ms")))).withColumn("in_range", S.in_epoch_range(F.col("ms")))


@query(MERGED + "select *, strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S') as datetime_utc, ms between 1483228800000 and 1893456000000 as in_range from merged")
def merge_klines(spark, d):
    return merged_klines(spark, d).select(*_TYPED, "ms", "datetime_utc", "in_range")


@query(LINES + f"select file, line, row_number() over (partition by file order by line) - odd as line_no from (select file, line, odd from line union all select distinct file, '{HEAD}', 0 from line where false)")
def union_files(spark, d):
    lines = archives.zip_lines(archive_files(spark, d))
    return archives.without_headers(lines).select("file", "line", "line_no")


@query(LINES + f""", first as (select file, odd, min(line) as line from line group by 1, 2)
select true as is_header, arg_min(case when odd = 1 then line else '{HEAD}' end, file) as line from first
union all select false, line from (select line, odd, row_number() over (partition by file order by line) as r from line) where odd = 0 or r > 1""")
def merge_metrics(spark, d):
    """Passthrough merge: the first line of each file is taken as its header, whatever it holds, and the first file's one is kept."""
    return archives.merged_lines(archives.zip_lines(archive_files(spark, d))).select("is_header", "line")


@query(LINES + f"select true as is_header, '{HEAD}' as line union all select false, line from line")
def merge_premium(spark, d):
    """Files of which some lack a header: nothing but headers is dropped, and one header is kept or made."""
    return archives.merged_lines(archives.zip_lines(archive_files(spark, d)), may_lack_header=True).select("is_header", "line")


@query(LINES + "select distinct file from line where odd = 0")
def reject_archives(spark, d):
    """Archives cut in their middle are told by name, and none of their lines counts."""
    cut = F.when(F.substring_index("file", "-", -1).substr(1, 2).cast("int") % 2 == 0, F.expr("substring(content, 1, length(content) div 2)")).otherwise(F.col("content"))
    return archives.rejected_archives(archives.zip_lines(archive_files(spark, d).withColumn("content", cut))).select("file")


@query(MERGED + """, st as (select symbol, bar_ts from store),
 m as (select string_split(file, '-1h-')[1] as symbol, epoch_ms(ms) as bar_ts, close from merged)
 select symbol, bar_ts, close from m anti join st using (symbol, bar_ts)""")
def backfill_full(spark, d):
    """Archives to the store: typed, first of repeated bars, absent keys only."""
    rows = archives.parse_names(merged_klines(spark, d)).withColumn("bar_ts", S.from_ms(F.col("ms")))
    rows = rows.select("symbol", "bar_ts", "close", "file", "line_no")
    return st.append_absent(rows, fx.store(spark, d), order=("file", "line_no"), bounds=archives.period_bounds(archive_names(spark, d))).select("symbol", "bar_ts", "close")


_SIX = ", ".join(f"cast(cast(round({c}, 6) as decimal(20, 6)) as double) as {c}" for c in ("open", "high", "low", "close", "volume"))


@query(f"select symbol, bar_ts, {_SIX}, num_trades from minutes anti join minute_store using (symbol, bar_ts)")
def backfill_1m(spark, d):
    """Archives of one-minute bars to their store: merged, strictly typed, first writer wins, rows without a price ignored."""
    rows = archives.parse_names(archives.zip_klines(archive_files(spark, d, fx.minutes, "1m"), strict=True))
    rows = schemas.canonical(rows).withColumn("bar_ts", S.from_ms(S.epoch_ms(F.col("open_time").cast("string"))))
    rows = rows.select("symbol", "bar_ts", "open", "high", "low", "close", "volume", "num_trades", "file", "line_no")
    fresh = st.insert_or_ignore(rows, fx.minute_store(spark, d), schemas.REQUIRED["ohlcv_1m"], bounds=archives.period_bounds(archive_names(spark, d, fx.minutes, "1m")))
    return fresh.drop("file", "line_no")


@query(MERGED + """, m as (select string_split(file, '-1h-')[1] as symbol, epoch_ms(ms) as bar_ts, open, close from merged) select symbol, '1h' as "interval", bar_ts, open, close from m""")
def archive_stream(spark, d):
    """Archives that land in two deliveries, the second with all of the first again under their names: a run for each, each archive's rows once."""
    files, landing, work = archive_files(spark, d), shared_path(spark, "archives"), shared_path(spark, "taken")
    store = KeptStore(spark, shared_path(spark, "bars"), T.StructType.fromDDL("symbol string, `interval` string, bar_ts timestamp_ntz, open double, close double"), keys=("symbol", "interval"))
    for part in (files.filter(F.xxhash64("file") % 2 == 0), files):
        part.repartition(4).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("file string, content binary").parquet(landing)
        out = archive_jobs.ingest_archives(stream, store, work)
    return out


def names(spark, d):
    """Daily names of the days with events, except each seventh, and a monthly one."""
    day = fx.events(spark, d).select("event_type", F.to_date("ts").alias("day")).distinct().filter(F.dayofmonth("day") % 7 != 0)
    daily = day.select(F.concat("event_type", F.lit("-1h-"), F.date_format("day", "yyyy-MM-dd"), F.lit(".zip")).alias("file"))
    return daily.union(day.select(F.concat("event_type", F.lit("-metrics-"), F.date_format("day", "yyyy-MM"), F.lit(".zip"))).distinct())


NAMES = """, days as (select distinct event_type as symbol, ts::date as day from events),
landed as (
  select symbol, '1h' as kind, strftime(day, '%Y-%m-%d') as period, true as daily from days where day(day) % 7 <> 0
  union all select distinct symbol, 'metrics', strftime(day, '%Y-%m'), false from days where day(day) % 7 <> 0)
"""


@query(NAMES + "select symbol || '-' || kind || '-' || period || '.zip' as file, * from landed")
def archive_name_parse(spark, d):
    return archives.parse_names(names(spark, d))


def spans(spark, d):
    return fx.events(spark, d).groupBy(F.col("event_type").alias("symbol")).agg(F.min(F.to_date("ts")).alias("start"), F.max(F.to_date("ts")).alias("end"))


EXPECTED = NAMES + """, expected as (select symbol, strftime(unnest(generate_series(min(day), max(day), interval 1 day)), '%Y-%m-%d') as period from days group by symbol)
"""


@query(EXPECTED + "select * from expected")
def expected_periods(spark, d):
    return archives.expected_periods(spans(spark, d), daily=True)


@query(EXPECTED + "select * from expected anti join (select symbol, period from landed where daily) using (symbol, period)")
def missing_periods(spark, d):
    return archives.missing_periods(archives.expected_periods(spans(spark, d), daily=True), archives.parse_names(names(spark, d)).filter("daily"))


# ---------------------------------------------------------------- text

MIXED = """, raw as (
  select event_id, case when event_id % 100 = 0 then 'open_time,open,close' when event_id % 31 = 0 then concat_ws(',', epoch_us(ts) // 1000, '1', '2')
    else concat_ws(',', epoch_us(ts) // 1000, event_id, event_type, user_id, 'a', 'b', 'c') end as line from events)
"""


def mixed_lines(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    line = F.when(F.col("event_id") % 100 == 0, "open_time,open,close").when(F.col("event_id") % 31 == 0, F.concat_ws(",", ms, F.lit("1"), F.lit("2")))
    line = line.otherwise(F.concat_ws(",", ms, F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string"), F.lit("a"), F.lit("b"), F.lit("c")))
    return fx.events(spark, d).select("event_id", line.alias("line"))


@query(MIXED + "select event_id, line from raw where not regexp_matches(string_split(line, ',')[1], '[A-Za-z]')")
def header_filter(spark, d):
    return mixed_lines(spark, d).filter(~archives.is_header(F.col("line")))


@query(MIXED + "select event_id, line, len(string_split(line, ',')) < 7 as malformed from raw")
def malformed_split(spark, d):
    return mixed_lines(spark, d).withColumn("malformed", archives.is_malformed(F.col("line")))


EXPORT = "select symbol, bar_ts as timestamp, open, high, low, close, volume from store"


def written(spark, d, header=True):
    path = shared_path(spark, "csv")
    rows = fx.store(spark, d).withColumnRenamed("bar_ts", "timestamp").select("symbol", *schemas.EXPORT_COLUMNS)
    text.write_csv(rows, path, header=header)
    return path, rows.schema


@query(EXPORT)
def csv_scan(spark, d):
    path, schema = written(spark, d)
    return text.csv_scan(spark, path, schema)


@query("select symbol, count(*) as n_rows, count(*) filter (hour(bar_ts) % 5 = 0) as micros_rows, min(bar_ts) as first_ts, max(bar_ts) as last_ts from candles group by 1")
def merged_table(spark, d):
    """Archives merged into one CSV table with a header; then its rows are counted, per series."""
    path = shared_path(spark, "merged")
    rows = archives.parse_names(archives.zip_klines(archive_files(spark, d))).select("symbol", "open_time", "open", "high", "low", "close", "volume")
    text.write_csv(rows, path)
    again, ms = text.csv_scan(spark, path, rows.schema), S.epoch_ms(F.col("open_time").cast("string"))
    again = again.withColumn("bar_ts", S.from_ms(ms))
    return again.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.count_if(F.col("open_time") > S.MICROS_FROM).alias("micros_rows"), F.min("bar_ts").alias("first_ts"), F.max("bar_ts").alias("last_ts"))


@query("select epoch_ms(bar_ts) as open_time, close, symbol from candles")
def csv_autoheader(spark, d):
    """Two folders of files, one with and one without header, read as one."""
    rows = fx.candles(spark, d).select(open_ms().cast("string").alias("open_time"), F.round("close", 6).cast("decimal(20,6)").cast("string").alias("close"), "symbol")
    root = shared_path(spark, "autoheader")
    text.write_csv(rows.filter(F.col("symbol") < "c"), f"{root}/part=1")
    text.write_csv(rows.filter(F.col("symbol") >= "c"), f"{root}/part=2", header=False)
    got = text.csv_autoheader(spark, f"{root}/*", ["open_time", "close", "symbol"])
    return got.select(F.col("open_time").cast("bigint").alias("open_time"), F.col("close").cast("double").alias("close"), "symbol")


@query("select event_id, user_id from events where event_id % 97 <> 0")
def lenient_csv(spark, d):
    rows = fx.raw_epoch(spark, d).join(fx.events(spark, d).select("event_id", "user_id"), "event_id")
    bad = F.when(F.col("event_id") % 97 == 0, "bad").otherwise(F.col("event_id").cast("string"))
    path = shared_path(spark, "lenient")
    text.write_csv(rows.select(bad.alias("event_id"), "user_id"), path)
    good, _ = text.lenient_csv(spark, path, fx.events(spark, d).select("event_id", "user_id").schema)
    return good


@query(EXPORT)
def export_ohlcv(spark, d):
    return schemas.require(fx.store(spark, d).withColumnRenamed("bar_ts", "timestamp"), schemas.EXPORT_COLUMNS).select("symbol", *schemas.EXPORT_COLUMNS)


@query("select bar_ts as timestamp, open, high, low, close, volume from feed")
def raw_snapshot(spark, d):
    batch = fx.feed(spark, d).withColumnRenamed("bar_ts", "timestamp")
    path = text.raw_snapshot(batch, shared_path(spark, "snapshots"), "20240128_123456Z", schemas.EXPORT_COLUMNS)
    return text.csv_scan(spark, path, batch.select(*schemas.EXPORT_COLUMNS).schema)


# ---------------------------------------------------------------- payloads


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def props_extract(spark, d):
    return fx.events(spark, d).select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def kline_payloads(spark, d):
    """A JSON array of arrays per series and day, as text."""
    price = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    cells = [open_ms().cast("string"), *map(price, ("open", "high", "low", "close", "volume")), (open_ms() + 3599999).cast("string"), F.lit('"0"'), F.col("num_trades").cast("string"), F.lit('"1.5"'), F.lit('"2.5"')]
    row = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
    return fx.candles(spark, d).groupBy("symbol", F.to_date("bar_ts").alias("day")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(row), ","), F.lit("]")).alias("payload"))


@query("select symbol, bar_ts as timestamp, bar_ts + interval 3599999 milliseconds as close_time, open, high, low, close, volume, 0.0::double as quote_asset_volume, 1.5::double as taker_buy_base_volume, 2.5::double as taker_buy_quote_volume, num_trades from candles")
def payload_klines(spark, d):
    return payloads.klines(kline_payloads(spark, d)).drop("day")


@query("select symbol, date_trunc('millisecond', ts) as snapshot_time, sum_open_interest, count_long_short_ratio from metrics5m")
def payload_metrics(spark, d):
    o = F.struct(F.col("sum_open_interest").cast("string").alias("sumOpenInterest"), F.col("count_long_short_ratio").cast("string").alias("longShortRatio"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"))
    landed = fx.metrics5m(spark, d).groupBy("symbol", F.to_date("ts").alias("day")).agg(F.to_json(F.collect_list(o)).alias("payload"))
    return payloads.metrics(landed, {"sumOpenInterest": "sum_open_interest", "longShortRatio": "count_long_short_ratio"}).drop("day")


@query("select event_id, event_type as symbol, value as \"openInterest\", epoch_us(ts) // 1000 as time from events")
def payload_single(spark, d):
    o = F.struct(F.col("event_type").alias("symbol"), F.col("value").cast("string").alias("openInterest"), F.unix_millis(F.col("ts").cast("timestamp")).alias("time"))
    return payloads.single(fx.events(spark, d).select("event_id", F.to_json(o).alias("payload")), {"symbol": "string", "openInterest": "double", "time": "bigint"})


