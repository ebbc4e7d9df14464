"""Queries of scalar functions, filters, joins, aggregates, windows, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import schemas
from ..operators import quality as q
from ..operators import reconcile as r
from ..operators import snapshot as sn
from ..operators import store as st
from . import fixtures as fx
from .book import query


def now():
    return fx.ntz(fx.NOW)


# ---------------------------------------------------------------- scalar functions


@query("""select event_id, epoch_ms(case when x > 1000000000000000 then x // 1000 else x end) as ts from (select event_id, try_cast(epoch_text as bigint) as x from raw_epoch)""")
def epoch_to_ts(spark, d):
    return fx.raw_epoch(spark, d).select("event_id", S.from_ms(S.epoch_ms(F.col("epoch_text"))).alias("ts"))


@query("""select event_id, case when x > 1000000000000000 then x // 1000 else x end as ms, x > 1000000000000000 as was_micros from (select event_id, try_cast(epoch_text as bigint) as x from raw_epoch)""")
def epoch_normalize(spark, d):
    x = F.col("epoch_text").try_cast("bigint")
    return fx.raw_epoch(spark, d).select("event_id", S.epoch_ms(F.col("epoch_text")).alias("ms"), (x > S.MICROS_FROM).alias("was_micros"))


@query("""select event_id, epoch_text from raw_epoch where try_cast(epoch_text as bigint) is null""")
def epoch_rejects(spark, d):
    return fx.raw_epoch(spark, d).filter(S.epoch_ms(F.col("epoch_text")).isNull())


@query("""select event_id, ms, ms between 1483228800000 and 1893456000000 as in_range from (
  select event_id, case when event_id % 50 = 0 then 1 else case when x > 1000000000000000 then x // 1000 else x end end as ms
  from (select event_id, try_cast(epoch_text as bigint) as x from raw_epoch))""")
def epoch_range_flag(spark, d):
    ms = F.when(F.col("event_id") % 50 == 0, 1).otherwise(S.epoch_ms(F.col("epoch_text")))
    return fx.raw_epoch(spark, d).select("event_id", ms.alias("ms")).withColumn("in_range", S.in_epoch_range(F.col("ms")))


@query("""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as datetime_utc, strftime(timestamp '2024-01-28 12:34:56', '%Y%m%d_%H%M%SZ') as run_id from events""")
def datetime_utc(spark, d):
    return fx.events(spark, d).select("event_id", S.utc_text(F.col("ts")).alias("datetime_utc"), S.run_id(now()).alias("run_id"))


@query("""select symbol, bar_ts, bar_ts + interval 1 hour as snapshot_time from candles""")
def align_bar(spark, d):
    return fx.candles(spark, d).select("symbol", "bar_ts", S.closes_at(F.col("bar_ts")).alias("snapshot_time"))


@query("""select symbol, ts as snapshot_time, ts - interval 1 hour as timestamp from metrics5m""")
def align_snapshot(spark, d):
    return fx.metrics5m(spark, d).select("symbol", F.col("ts").alias("snapshot_time"), S.opens_at(F.col("ts")).alias("timestamp"))


@query("""select event_id, date_trunc('hour', ts) as floor_ts, date_trunc('hour', ts + interval 1 hour - interval 1 microsecond) as ceil_ts from events""")
def hour_floor_ceil(spark, d):
    return fx.events(spark, d).select("event_id", S.hour_floor(F.col("ts")).alias("floor_ts"), S.hour_ceil(F.col("ts")).alias("ceil_ts"))


@query("""select event_id, date_trunc('hour', ts) as now_floor, date_trunc('hour', ts) - interval 1 hour as target_hour from events""")
def target_hour(spark, d):
    return fx.events(spark, d).select("event_id", S.hour_floor(F.col("ts")).alias("now_floor"), S.opens_at(S.hour_floor(F.col("ts"))).alias("target_hour"))


@query("""select symbol, bar_ts, file, try_cast(close_text as double) as close from raw_bars""")
def lenient_cast(spark, d):
    return fx.raw_bars(spark, d).select("symbol", "bar_ts", "file", S.number(F.col("close_text")).alias("close"))


@query("""select symbol, bar_ts, cast(round(volume, 2) as double) as volume, num_trades from (select symbol, bar_ts, volume, num_trades from candles)""")
def strict_cast(spark, d):
    text = fx.candles(spark, d).select("symbol", "bar_ts", F.round("volume", 2).cast("string").alias("volume"), F.col("num_trades").cast("string").alias("num_trades"))
    return text.select("symbol", "bar_ts", S.strict_number(F.col("volume")).alias("volume"), S.strict_count(F.col("num_trades")).alias("num_trades"))


@query("""select event_id, case when event_id % 13 = 0 then null else date_trunc('second', ts) end as ts from events""")
def parse_ts(spark, d):
    text = F.when(F.col("event_id") % 13 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return fx.events(spark, d).select("event_id", S.timestamp_or_null(text).alias("ts"))


@query("""select symbol, bar_ts, coalesce(case when num_trades = 1 then null else close end, 0) as close, coalesce(case when num_trades = 1 then null else num_trades end, 0)::int as num_trades from candles""")
def null_defaults(spark, d):
    few = F.col("num_trades") == 1
    c = fx.candles(spark, d).select("symbol", "bar_ts", F.when(~few, F.col("close")).alias("close"), F.when(~few, F.col("num_trades")).alias("num_trades"))
    return c.fillna({"close": 0.0, "num_trades": 0})


@query("""select symbol, bar_ts, volume as quote_asset_volume, num_trades, volume / 2 as taker_buy_base_volume from candles""")
def canonical_columns(spark, d):
    archive = fx.candles(spark, d).select("symbol", "bar_ts", F.col("volume").alias("quote_volume"), F.col("num_trades").alias("count"), (F.col("volume") / 2).alias("taker_buy_volume"))
    return schemas.canonical(archive)


@query("""select symbol, bar_ts, open, close from candles""")
def clean_names(spark, d):
    return schemas.clean_names(fx.candles(spark, d).select(F.col("symbol").alias(" Symbol"), F.col("bar_ts").alias("BAR_TS "), F.col("open").alias("Open"), F.col("close").alias(" CLOSE ")))


@query("""select symbol, bar_ts, open, close from candles""")
def require_columns(spark, d):
    return schemas.require(fx.candles(spark, d), ["symbol", "bar_ts", "open", "close"]).select("symbol", "bar_ts", "open", "close")


@query("""select symbol, bar_ts, open, high, low, close, cast(0 as double) as volume, cast(null as double) as quote_asset_volume, cast(null as int) as num_trades from candles""")
def premium_shape(spark, d):
    return fx.candles(spark, d).select(
        "symbol", "bar_ts", "open", "high", "low", "close", F.lit(0.0).alias("volume"), F.lit(None).cast("double").alias("quote_asset_volume"), F.lit(None).cast("int").alias("num_trades")
    )


@query("""select symbol, ts, coalesce(count_long_short_ratio, 0) as long_short_ratio, coalesce(sum_open_interest, 0) as long_account, coalesce(sum_open_interest / 2, 0) as short_account, 'archive' as source from metrics5m""")
def ls_ratio_map(spark, d):
    more = {"count_toptrader_long_short_ratio": F.col("sum_open_interest"), "sum_toptrader_long_short_ratio": F.col("sum_open_interest") / 2}
    return long_short_from_archive(fx.metrics5m(spark, d).withColumns(more), "ts")


def long_short_from_archive(m, *times):
    """Archive ratios in the store's columns. The account columns hold other quantities than the feed's, hence ``source``."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ratios = {"count_long_short_ratio": "long_short_ratio", "count_toptrader_long_short_ratio": "long_account", "sum_toptrader_long_short_ratio": "short_account"}
    return m.select("symbol", *times, *(zero(c).alias(name) for c, name in ratios.items()), F.lit("archive").alias("source"))


# ---------------------------------------------------------------- filters


def close_time(interval: str = "1 hour"):
    return S.closes_at(F.col("bar_ts"), interval) - F.expr("interval 1 millisecond")


@query("""select symbol, bar_ts, close from candles where bar_ts + interval 1 hour - interval 1 millisecond <= timestamp '2024-01-28 12:00:00' - interval 1 millisecond""")
def closed_by_close_time(spark, d):
    return closed(fx.candles(spark, d)).select("symbol", "bar_ts", "close")


def closed(bars, at=None):
    """Bars whose close time lies before the floor of the clock."""
    return bars.filter(close_time() <= S.hour_floor(now() if at is None else at) - F.expr("interval 1 millisecond"))


@query("""select symbol, ts, sum_open_interest from metrics5m where ts - interval 1 hour < timestamp '2024-01-28 12:00:00'""")
def closed_by_timestamp(spark, d):
    return fx.metrics5m(spark, d).filter(S.opens_at(F.col("ts")) < S.hour_floor(now())).select("symbol", "ts", "sum_open_interest")


@query("""select symbol, bar_ts, close from minutes where bar_ts + interval 1 minute - interval 1 millisecond < timestamp '2024-01-28 12:34:56'""")
def closed_1m(spark, d):
    return closed_strict(fx.minutes(spark, d)).select("symbol", "bar_ts", "close")


def closed_strict(bars, at=None, interval: str = "1 minute"):
    """Bars whose close time lies before the clock itself."""
    return bars.filter(close_time(interval) < (now() if at is None else at))


@query("""select symbol, bar_ts, close from candles where bar_ts between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-12 05:00:00'""")
def range_filter(spark, d):
    return fx.candles(spark, d).filter(F.col("bar_ts").between(fx.ntz("2024-01-10 00:00:00"), fx.ntz("2024-01-12 05:00:00"))).select("symbol", "bar_ts", "close")


@query("""select symbol, bar_ts, close from (select symbol, bar_ts, case when num_trades = 1 then null else close end as close from candles) where close is not null""")
def drop_incomplete(spark, d):
    return fx.candles(spark, d).select("symbol", "bar_ts", F.when(F.col("num_trades") != 1, F.col("close")).alias("close")).dropna(subset=["close"])


@query("""select symbol, ts, sum_open_interest, count_long_short_ratio from metrics5m where minute(ts) = 0""")
def on_the_hour(spark, d):
    return fx.metrics5m(spark, d).filter(F.minute("ts") == 0)


@query("""select symbol, bar_ts, close from feed semi join store using (symbol, bar_ts)""")
def semi_common(spark, d):
    return fx.feed(spark, d).join(fx.store(spark, d).select("symbol", "bar_ts"), ["symbol", "bar_ts"], "left_semi").select("symbol", "bar_ts", "close")


@query("""select * from candles where bar_ts = timestamp '2024-01-17 08:00:00'""")
def point_lookup(spark, d):
    return fx.candles(spark, d).filter(F.col("bar_ts") == fx.ntz("2024-01-17 08:00:00"))


# ---------------------------------------------------------------- joins


@query("""select symbol, bar_ts, close from feed anti join store using (symbol, bar_ts)""")
def anti_absent(spark, d):
    return fx.feed(spark, d).join(fx.store(spark, d).select("symbol", "bar_ts"), ["symbol", "bar_ts"], "left_anti").select("symbol", "bar_ts", "close")


@query("""select symbol, bar_ts, s.close as store_close, f.close as feed_close from store s join feed f using (symbol, bar_ts)""")
def inner_overlap(spark, d):
    s = fx.store(spark, d).select("symbol", "bar_ts", F.col("close").alias("store_close"))
    return s.join(fx.feed(spark, d).select("symbol", "bar_ts", F.col("close").alias("feed_close")), ["symbol", "bar_ts"])


@query("""select coalesce(s.symbol, f.symbol) as symbol, count(*) filter (f.symbol is null) as store_only, count(*) filter (s.symbol is null) as feed_only,
  count(*) filter (s.symbol is not null and f.symbol is not null) as common
from store s full join feed f on s.symbol = f.symbol and s.bar_ts = f.bar_ts group by 1""")
def outer_presence(spark, d):
    sides = r.both_sides(fx.store(spark, d), fx.feed(spark, d), ["close"])
    return sides.groupBy("symbol").agg(F.count_if(~F.col("in_right")).alias("store_only"), F.count_if(~F.col("in_left")).alias("feed_only"), F.count_if(F.col("in_left") & F.col("in_right")).alias("common"))


CALENDAR = """, span as (select symbol, date_trunc('hour', min(ts)) as lo, date_trunc('hour', max(ts) + interval 1 hour - interval 1 microsecond) as hi from metrics5m group by 1),
cal as (select symbol, unnest(generate_series(lo, hi, interval 1 hour)) as snapshot_time from span),
prev_hour as (select symbol, date_trunc('hour', ts) + interval 1 hour as snapshot_time, max(ts) as asof_ts, arg_max(sum_open_interest, ts) as oi, arg_max(count_long_short_ratio, ts) as ls from metrics5m group by 1, 2),
ex as (select symbol, ts as snapshot_time, sum_open_interest as oi, count_long_short_ratio as ls from metrics5m where ts = date_trunc('hour', ts)),
snap as (
  select symbol, snapshot_time, snapshot_time - interval 1 hour as timestamp, e.oi is null as is_fallback,
    case when e.oi is not null then 'exact' when a.oi is not null then 'fallback' else 'missing' end as provenance,
    coalesce(e.oi, a.oi) as sum_open_interest, coalesce(e.ls, a.ls) as count_long_short_ratio
  from cal left join ex e using (symbol, snapshot_time) left join prev_hour a using (symbol, snapshot_time))
"""


@query(CALENDAR + "select symbol, snapshot_time, ex.oi as sum_open_interest from cal left join ex using (symbol, snapshot_time)")
def calendar_join(spark, d):
    m = fx.metrics5m(spark, d)
    return sn.calendar(m).join(m.select("symbol", F.col("ts").alias("snapshot_time"), "sum_open_interest"), ["symbol", "snapshot_time"], "left")


@query(CALENDAR + "select symbol, snapshot_time, asof_ts, oi as sum_open_interest from prev_hour")
def asof_prev_hour(spark, d):
    return sn.last_of_previous_hour(fx.metrics5m(spark, d), ["sum_open_interest"])


@query("""select coalesce(f.symbol, s.symbol) as symbol, coalesce(f.bar_ts, s.bar_ts) as bar_ts, f.symbol is not null as in_left, s.symbol is not null as in_right
from (select symbol, bar_ts from (select *, row_number() over (partition by symbol order by bar_ts desc) as r from feed where bar_ts < timestamp '2024-01-25 00:00:00') where r <= 24) f
full join (select symbol, bar_ts from (select *, row_number() over (partition by symbol order by bar_ts desc) as r from store) where r <= 24) s on f.symbol = s.symbol and f.bar_ts = s.bar_ts""")
def tail_align(spark, d):
    f = st.last_n(fx.feed(spark, d), 24, before="2024-01-25 00:00:00")
    return r.both_sides(f, st.last_n(fx.store(spark, d), 24), []).select("symbol", "bar_ts", "in_left", "in_right")


# ---------------------------------------------------------------- aggregates and windows


@query("""select symbol, min(bar_ts) as first_ts, max(bar_ts) as last_ts, count(*) as n_rows from store group by 1""")
def coverage(spark, d):
    return st.coverage(fx.store(spark, d))


PREVIOUS = """, diffs as (select *, date_diff('second', prev_ts, bar_ts) as diff_s from (select symbol, bar_ts, lag(bar_ts) over (partition by symbol order by bar_ts) as prev_ts from {0}))
"""


@query(PREVIOUS.format("raw_klines") + "select symbol, count(*) filter (diff_s <> 3600) as gaps, count(*) as n_rows from diffs group by 1")
def gap_count(spark, d):
    return q.gap_count(fx.raw_klines(spark, d).select("symbol", "bar_ts"))


@query(PREVIOUS.format("minutes") + "select symbol, count(*) filter (diff_s <> 60) as gaps, count(*) as n_rows from diffs group by 1")
def gap_count_1m(spark, d):
    return q.gap_count(fx.minutes(spark, d).select("symbol", "bar_ts"), step=60)


@query("""select symbol, "interval", count(*) filter (date_diff('second', p, bar_ts) <> case "interval" when '1h' then 3600 else 60 end) as gaps, count(*) as n_rows
from (select *, lag(bar_ts) over (partition by symbol, "interval" order by bar_ts) as p from mixed_store) group by 1, 2""")
def gap_count_intervals(spark, d):
    """Two intervals in one store: each series is a symbol and an interval, with a step of its own."""
    bars = fx.mixed_store(spark, d).select(*schemas.STORE_KEYS, "bar_ts")
    return q.gap_count(bars, schemas.STORE_KEYS, step=schemas.step_of(F.col("interval")))


@query("""select symbol, "interval", bar_ts, close from (select *, row_number() over (partition by symbol, "interval" order by bar_ts desc) as r from mixed_store) where r <= 30""")
def last_n_intervals(spark, d):
    return st.last_n(fx.mixed_store(spark, d), 30, schemas.STORE_KEYS).select(*schemas.STORE_KEYS, "bar_ts", "close")


@query(PREVIOUS.format("candles") + "select symbol, bar_ts, prev_ts, diff_s from diffs where diff_s <> 3600")
def gap_rows(spark, d):
    return q.gap_rows(fx.candles(spark, d).select("symbol", "bar_ts"))


@query("""select symbol, count(*) - count(distinct bar_ts) as duplicates from raw_klines group by 1""")
def dup_count(spark, d):
    return q.duplicate_count(fx.raw_klines(spark, d))


@query("""select symbol, round(coalesce(max(abs(s.close - f.close)), 0), 10) as max_diff from store s join feed f using (symbol, bar_ts) group by 1""")
def max_abs_diff(spark, d):
    sides = r.both_sides(fx.store(spark, d), fx.feed(spark, d), ["close"]).filter("in_left and in_right")
    return sides.groupBy("symbol").agg(F.round(F.coalesce(F.max(r.difference(F.col("l_close"), F.col("r_close"))), F.lit(0.0)), 10).alias("max_diff"))


@query("""select symbol, count(*) as compared, count(*) filter (abs(s.close - f.close) > 0.01) as mismatched, count(*) filter (not abs(s.close - f.close) > 0.01) as matched
from store s join feed f using (symbol, bar_ts) group by 1""")
def reconcile_counts(spark, d):
    return r.reconcile(fx.store(spark, d), fx.feed(spark, d), [("close", 0.01)]).filter("compared > 0").select("symbol", "compared", "mismatched", "matched")


@query("""select count(*) as n_rows, count(*) filter (try_cast(epoch_text as bigint) > 1000000000000000) as micros_rows, count(*) filter (try_cast(epoch_text as bigint) is null) as bad_rows from raw_epoch""")
def merge_counters(spark, d):
    x = F.col("epoch_text").try_cast("bigint")
    return fx.raw_epoch(spark, d).agg(F.count("*").alias("n_rows"), F.count_if(x > S.MICROS_FROM).alias("micros_rows"), F.count_if(x.isNull()).alias("bad_rows"))


@query("""select bool_and(ok) as all_ok, count(*) as series from (select symbol, count(*) > 0 and count(*) filter (abs(s.close - f.close) > 0.01) = 0 as ok from store s join feed f using (symbol, bar_ts) group by 1)""")
def verdict(spark, d):
    return r.reconcile(fx.store(spark, d), fx.feed(spark, d), [("close", 0.01)]).filter("compared > 0").agg(F.bool_and("ok").alias("all_ok"), F.count("*").alias("series"))


@query(CALENDAR + "select symbol, provenance, count(*) as n from snap group by 1, 2")
def provenance_counts(spark, d):
    return sn.provenance_counts(sn.hourly_snapshot(fx.metrics5m(spark, d), ["sum_open_interest", "count_long_short_ratio"]))


@query("""select symbol, count(*) as inserted, min(bar_ts) as first_ts, max(bar_ts) as last_ts from (select * from feed anti join store using (symbol, bar_ts)) group by 1""")
def append_summary(spark, d):
    return st.append_summary(st.append_absent(fx.feed(spark, d), fx.store(spark, d)))


COUNTERS = """select symbol, sum(n)::bigint as n_rows, sum(n - good)::bigint as dropped_incomplete, sum(greatest(good - 1, 0))::bigint as dropped_duplicate
from (select symbol, bar_ts, count(*) as n, count(*) filter (try_cast(close_text as double) is not null) as good from raw_bars group by 1, 2) group by 1"""


@query(COUNTERS)
def clean_counters(spark, d):
    return q.clean_counters(fx.raw_bars(spark, d))


@query("""select symbol, count(*) filter (ok) as n_ok, count(*) filter (not ok) as n_bad from (select symbol, date_diff('second', bar_ts, close_time) between 3599 and 3600 as ok from
  (select symbol, bar_ts, date_trunc('second', close_time) as close_time from raw_bars)) group by 1""")
def close_time_sanity(spark, d):
    return q.close_time_sanity(fx.raw_bars(spark, d))


@query("""select symbol, bar_ts, arg_min(open, file) as open, arg_min(close, file) as close, min(file) as file, 0 as line_no from raw_klines group by 1, 2""")
def dedupe_first(spark, d):
    return q.dedupe_first(fx.raw_klines(spark, d), ["symbol", "bar_ts"])


@query("""select symbol, bar_ts, arg_max(open, file) as open, arg_max(close, file) as close, max(file) as file, 0 as line_no from raw_klines group by 1, 2""")
def dedupe_last(spark, d):
    return q.dedupe_last(fx.raw_klines(spark, d), ["symbol", "bar_ts"])


# ---------------------------------------------------------------- limits


@query("""select symbol, bar_ts, close from (select *, row_number() over (partition by symbol order by bar_ts desc) as r from store where bar_ts < timestamp '2024-01-20 10:00:00') where r <= 24""")
def last_n_before(spark, d):
    return st.last_n(fx.store(spark, d), 24, before="2024-01-20 10:00:00").select("symbol", "bar_ts", "close")


@query("""select symbol, bar_ts, close from (select *, row_number() over (partition by symbol order by bar_ts desc) as r from store) where r <= 48""")
def last_n(spark, d):
    return st.last_n(fx.store(spark, d), 48).select("symbol", "bar_ts", "close")


@query("""select symbol, max(bar_ts) as bar_ts, arg_max(close, bar_ts) as close from store group by 1""")
def latest_row(spark, d):
    return st.latest_row(fx.store(spark, d)).select("symbol", "bar_ts", "close")


@query("""select symbol, bar_ts, s.close as l_close, f.close as r_close, round(abs(s.close - f.close), 10) as diff from store s join feed f using (symbol, bar_ts) where round(abs(s.close - f.close), 10) > 0.01 order by bar_ts, symbol limit 5""")
def mismatch_sample(spark, d):
    return r.mismatch_sample(fx.store(spark, d), fx.feed(spark, d), "close", 0.01)


def seeded_rank(seed: int = 42):
    """A portable pseudorandom number per hour of a series."""
    return (F.unix_timestamp(F.col("bar_ts").cast("timestamp")) / 3600).cast("bigint") * 48271 % 2147483647 * (seed + 16807) % 2147483647


@query("""select symbol, bar_ts, close from store order by (epoch(bar_ts)::bigint // 3600) * 48271 % 2147483647 * (42 + 16807) % 2147483647, symbol limit 20""")
def seeded_sample(spark, d):
    return fx.store(spark, d).orderBy(seeded_rank(), "symbol").limit(20).select("symbol", "bar_ts", "close")


# ---------------------------------------------------------------- set operations


@query("""select symbol, bar_ts, open, close, null::double as volume, file from raw_klines union all select symbol, bar_ts, open, close, volume, null from feed""")
def union_sources(spark, d):
    a = fx.raw_klines(spark, d).select("symbol", "bar_ts", "open", "close", "file")
    return a.unionByName(fx.feed(spark, d).select("symbol", "bar_ts", "open", "close", "volume"), allowMissingColumns=True)


@query("""select symbol, bar_ts from store intersect select symbol, bar_ts from feed""")
def keys_intersect(spark, d):
    return fx.store(spark, d).select("symbol", "bar_ts").intersect(fx.feed(spark, d).select("symbol", "bar_ts"))


@query("""select symbol, bar_ts from store except select symbol, bar_ts from feed""")
def keys_except(spark, d):
    return fx.store(spark, d).select("symbol", "bar_ts").subtract(fx.feed(spark, d).select("symbol", "bar_ts"))
