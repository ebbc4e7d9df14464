"""Composite operators: snapshot, validation, reconciliation, cleaning, recent and archive backfill, streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import schemas
from ..operators import quality as q
from ..operators import reconcile as r
from ..operators import rewrite as rw
from ..operators import snapshot as sn
from ..operators import store as st
from ..operators.asof import asof_join
from ..operators.bucketed import BucketedStore, by_series
from ..operators.counters import write_clean
from ..operators.kept import KeptStore
from ..operators.shared import shared_path, written
from ..sources import text
from ..streaming import archives as archive_jobs
from ..streaming import gaps, jobs
from ..streaming.counters import run_counted
from . import basics
from . import fixtures as fx
from .basics import CALENDAR, PREVIOUS, closed, closed_strict
from .book import query

# ---------------------------------------------------------------- library entry points


def recent_delta(batch: DataFrame, store: DataFrame | KeptStore, validate: bool = False, keys=("symbol",), ts: str = "bar_ts", step=3600) -> DataFrame:
    """Rows of a closed batch that are newer than the store; with ``validate`` only of series whose overlap is sound. A kept store is read by its summary."""
    kept = isinstance(store, KeptStore)
    batch = st.unique_rows(batch, [*keys, ts])
    delta = st.append_newer(batch, batch if kept else store, keys, ts, last=store.coverage() if kept else None)
    if validate:
        verdict = store.validate_overlap(batch, step=step) if kept else r.validate_overlap(batch, store, ts=ts, keys=keys, step=step)
        delta = delta.join(verdict.filter("ok").select(*keys), list(keys), "left_semi")
    return delta


def archive_backfill(rows: DataFrame, store: DataFrame, required: list[str], keys=("symbol",), ts: str = "bar_ts", bounds: tuple | None = None) -> DataFrame:
    """Rows of archives with all required values whose key isn't stored; interior holes are filled. Only the store's slice between their times is read.

    ``bounds`` of these times, where they are known from the source, spare computing the rows once more.
    """
    rows = rows.dropna(subset=required)
    return st.append_absent(rows, store, keys, ts, bounds=bounds or st.batch_bounds(rows, ts))


def catch_up(batch: DataFrame, store: DataFrame | KeptStore, recent: int, ts: str = "bar_ts", keys=("symbol",), step=3600) -> DataFrame:
    """Per series of a closed batch: verdict on its rows up to the store's end, and how many rows follow.

    Rows up to the end are not intersected with the store, so a hole there shows as a short or
    differing store. An empty store is fine and takes the whole batch.
    """
    on, most = list(keys), max(recent - 1, 1)
    kept = isinstance(store, KeptStore)
    end = store.coverage().select(*on, F.col("last_ts").alias("end")) if kept else store.groupBy(*on).agg(F.max(ts).alias("end"))
    x = batch.join(end, on, "left")
    overlap = st.last_n(x.filter(F.col(ts) <= F.col("end")).drop("end"), most, keys, ts)
    targets = overlap.groupBy(*on).agg(F.max(ts).alias("target"))
    verdict = store.validate_window(overlap, targets, step=step, most=most) if kept else r.validate_window(overlap, store, targets, ts=ts, keys=keys, step=step, most=most)
    follow = x.groupBy(*on).agg(F.max("end").alias("end"), F.count_if(F.col("end").isNull() | (F.col(ts) > F.col("end"))).alias("following"))
    y = follow.join(verdict, on, "left")
    reason = F.when(F.col("end").isNull(), "empty store").otherwise(F.coalesce("reason", F.lit("no overlap")))
    ok = F.col("end").isNull() | F.coalesce("ok", F.lit(False))
    return y.select(*on, ok.alias("ok"), reason.alias("reason"), F.when(ok, F.col("following")).otherwise(0).cast("long").alias("appended"))


def append_target(batch: DataFrame, store: DataFrame | KeptStore, targets: DataFrame, ts: str = "bar_ts", keys=("symbol",), step=3600) -> DataFrame:
    """The batch's row at each target, if its window is valid or nothing is stored before the target."""
    on = list(keys)
    if isinstance(store, KeptStore):
        verdict = store.validate_window(batch, targets, step=step)
        before = store.coverage().join(targets, on).filter(F.col("first_ts") < F.col("target")).select(*on, F.lit(1).alias("held"))
        days = [x.day for x in targets.select(F.to_date("target").alias("day")).distinct().collect()]
        held, bounds = store.read(days), None
    else:
        verdict = r.validate_window(batch, store, targets, ts=ts, keys=keys, step=step)
        before = store.join(targets, on).filter(F.col(ts) < F.col("target")).groupBy(*on).agg(F.count("*").alias("held"))
        held, bounds = store, st.batch_bounds(targets, "target")
    allowed = verdict.join(before, on, "left").filter(F.col("ok") | F.col("held").isNull()).select(*on)
    rows = batch.join(targets, on).filter(F.col(ts) == F.col("target")).drop("target")
    return st.append_absent(rows.join(allowed, on, "left_semi"), held, keys, ts, bounds=bounds)


# ---------------------------------------------------------------- queries


@query(CALENDAR + "select * from snap")
def hourly_snapshot(spark, d):
    return sn.hourly_snapshot(fx.metrics5m(spark, d), ["sum_open_interest", "count_long_short_ratio"])


def window_batch(spark, d):
    """Closed bars of one day, without hour 3 for one series, off by 0.02 for another, ending late for a third."""
    c = closed(fx.candles(spark, d)).filter(F.col("bar_ts").between(fx.ntz("2024-01-21 12:00:00"), fx.ntz("2024-01-22 12:00:00")))
    c = c.filter(~((F.col("symbol") == "click") & (F.hour("bar_ts") == 3)) & ~((F.col("symbol") == "error") & (F.col("bar_ts") > fx.ntz("2024-01-22 10:00:00"))))
    return c.withColumn("close", F.when((F.col("symbol") == "login") & (F.hour("bar_ts") == 5), F.col("close") + 0.02).otherwise(F.col("close")))


BATCH = """, batch as (
  select symbol, bar_ts, open, high, low, case when symbol = 'login' and hour(bar_ts) = 5 then close + 0.02 else close end as close, volume, num_trades from candles
  where bar_ts between timestamp '2024-01-21 12:00:00' and timestamp '2024-01-22 12:00:00'
    and not (symbol = 'click' and hour(bar_ts) = 3) and not (symbol = 'error' and bar_ts > timestamp '2024-01-22 10:00:00'))
"""

_DIFFS = ", ".join(f"max(abs(h.{v} - s.{v})) as d_{v}" for v in r.VALUES)
_REASONS = " ".join(f"when d_{v} is null then 'NaN in {v}' when d_{v} > {r.TOLERANCE} then 'mismatch in {v}'" for v in r.VALUES)


def verdict_sql(batch: str, targets: str, name: str) -> str:
    """CTEs that end in ``name`` (symbol, ok, reason, validated)."""
    return f""",
{name}_b as (select b.*, t.target from {batch} b join {targets} t using (symbol)),
{name}_n as (select symbol, count(*) as n, max(bar_ts) as last from {name}_b group by 1),
{name}_g as (select symbol, count(*) filter (date_diff('second', p, bar_ts) <> 3600) as gaps from (select symbol, bar_ts, lag(bar_ts) over (partition by symbol order by bar_ts) as p from {name}_b) group by 1),
{name}_h as (select b.* from {name}_b b join {name}_n n using (symbol) where bar_ts < n.last),
{name}_s as (select * from (select s.*, n.n, row_number() over (partition by s.symbol order by bar_ts desc) as r from store s join {targets} t using (symbol) join {name}_n n using (symbol) where s.bar_ts < t.target) where r <= n - 1),
{name}_d as (select coalesce(h.symbol, s.symbol) as symbol, count(s.symbol) as stored, count(*) filter (h.symbol is null or s.symbol is null) as apart, {_DIFFS}
  from {name}_h h full join {name}_s s on h.symbol = s.symbol and h.bar_ts = s.bar_ts group by 1),
{name}_r as (
  select t.symbol, n.n, case when n.n is null then 'empty batch' when n.last <> t.target then 'last row is not the target' when n.n = 1 then 'no history' when gaps > 0 then 'not hourly'
    when coalesce(stored, 0) < n.n - 1 then 'store too short' when apart > 0 then 'times differ' {_REASONS} else 'validated' end as reason
  from {targets} t left join {name}_n n using (symbol) left join {name}_g using (symbol) left join {name}_d using (symbol)),
{name} as (select symbol, reason in ('validated', 'no history') as ok, reason, case when reason = 'validated' then n - 1 else 0 end as validated from {name}_r)
"""


TARGETS = ", targets as (select distinct symbol, timestamp '2024-01-22 12:00:00' as target from candles)"


def targets(spark, d):
    return fx.candles(spark, d).select("symbol").distinct().withColumn("target", fx.ntz("2024-01-22 12:00:00"))


@query(BATCH + TARGETS + verdict_sql("batch", "targets", "v") + "select * from v")
def validate_window(spark, d):
    return r.validate_window(window_batch(spark, d), fx.store(spark, d), targets(spark, d))


OVERLAP = """, last as (select symbol, max(bar_ts) as last from {0} group by 1),
tail as (select * from (select s.*, row_number() over (partition by s.symbol order by bar_ts desc) as r from store s join last l using (symbol) where s.bar_ts <= l.last) where r <= 72),
common as (select * from {0} semi join tail using (symbol, bar_ts)),
ot as (select symbol, max(bar_ts) as target from common group by 1)
"""
_OFF = " or ".join(f"coalesce(abs(c.{v} - t.{v}) > {r.TOLERANCE}, false)" for v in r.VALUES)


def overlap_sql(batch: str) -> str:
    return OVERLAP.format(batch) + verdict_sql("common", "ot", "ov") + f""",
at as (select c.symbol, {_OFF} as off from common c join ot using (symbol) join tail t on c.symbol = t.symbol and c.bar_ts = t.bar_ts where c.bar_ts = ot.target),
ovr as (
  select l.symbol, case when h.symbol is null then 'empty store' when ov.reason is null then 'no overlap' when ov.ok and a.off then 'mismatch at target' else ov.reason end as reason, ov.validated as v
  from last l left join (select distinct symbol from tail) h using (symbol) left join ov using (symbol) left join at a using (symbol)),
overlap as (select symbol, reason in ('validated', 'no history', 'empty store') as ok, reason, case when reason = 'validated' then v else 0 end as validated from ovr)
""".replace("at as (", "att as (").replace("left join at a", "left join att a")


@query(BATCH + overlap_sql("batch") + "select * from overlap")
def validate_overlap(spark, d):
    return r.validate_overlap(window_batch(spark, d), fx.store(spark, d))


def recent(spark, d):
    """The last 120 closed bars of each series."""
    return st.last_n(closed(fx.candles(spark, d)), 120)


RECENT = """, recent as (select * exclude r from (select *, row_number() over (partition by symbol order by bar_ts desc) as r from candles
  where bar_ts + interval 1 hour <= timestamp '2024-01-28 12:00:00') where r <= 120)
"""


@query(RECENT + """, ends as (select symbol, max(bar_ts) as e from store group by 1),
cover as (select * exclude (e, r) from (select b.*, e, row_number() over (partition by symbol order by bar_ts desc) as r from recent b join ends using (symbol) where bar_ts <= e) where r <= 119),
ct as (select symbol, max(bar_ts) as target from cover group by 1)""" + verdict_sql("cover", "ct", "cv") + """
select f.symbol, f.e is null or coalesce(cv.ok, false) as ok, case when f.e is null then 'empty store' else coalesce(cv.reason, 'no overlap') end as reason,
  case when f.e is null or coalesce(cv.ok, false) then following else 0 end as appended
from (select b.symbol, max(e) as e, count(*) filter (e is null or bar_ts > e) as following from recent b left join ends using (symbol) group by 1) f left join cv using (symbol)""", name="catch_up")
def catch_up_overlap(spark, d):
    return catch_up(recent(spark, d), fx.store(spark, d), 120)


@query("""select symbol, max(bar_ts) as last_closed, max(bar_ts) = timestamp '2024-01-28 11:00:00' as at_target from candles where bar_ts + interval 1 hour <= timestamp '2024-01-28 12:00:00' group by 1""")
def target_check(spark, d):
    return r.target_check(closed(fx.candles(spark, d)), fx.ntz("2024-01-28 11:00:00"))


def _reconcile_sql(a: str, b: str, value: str, tol: float, ts: str) -> str:
    bad = f"coalesce(abs(a.{value} - b.{value}) > {tol}, false)"
    both = "a.symbol is not null and b.symbol is not null"
    return f"""select *, compared > 0 and mismatched = 0 as ok from (
  select coalesce(a.symbol, b.symbol) as symbol, count(*) filter ({both}) as compared, count(*) filter ({both} and not {bad}) as matched, count(*) filter ({both} and {bad}) as mismatched,
    count(*) filter (b.symbol is null) as archive_only, count(*) filter (a.symbol is null) as feed_only, round(coalesce(max(abs(a.{value} - b.{value})), 0), 10) as max_diff
  from {a} a full join {b} b on a.symbol = b.symbol and a.{ts} = b.{ts} group by 1)"""


_OI_FEED = "(select symbol, ts, sum_open_interest + case when hour(ts) = 5 then 2 else 0.5 end as sum_open_interest, count_long_short_ratio + case when hour(ts) = 5 then 0.02 else 0 end as count_long_short_ratio from metrics5m where minute(ts) = 0 and hour(ts) <> 3)"
_OI = "(select * from metrics5m where minute(ts) = 0)"


def _metric_sides(spark, d):
    on = fx.metrics5m(spark, d).filter(F.minute("ts") == 0)
    five = F.hour("ts") == 5
    feed = on.filter(F.hour("ts") != 3).withColumn("sum_open_interest", F.col("sum_open_interest") + F.when(five, 2).otherwise(0.5)).withColumn("count_long_short_ratio", F.col("count_long_short_ratio") + F.when(five, 0.02).otherwise(0))
    return on, feed


@query(_reconcile_sql(_OI, _OI_FEED, "sum_open_interest", 1.0, "ts"))
def reconcile_oi(spark, d):
    a, b = _metric_sides(spark, d)
    return r.reconcile(a, b, [("sum_open_interest", 1.0)], ts="ts")


@query(_reconcile_sql(_OI, _OI_FEED, "count_long_short_ratio", 0.01, "ts"))
def reconcile_ls(spark, d):
    a, b = _metric_sides(spark, d)
    return r.reconcile(a, b, [("count_long_short_ratio", 0.01)], ts="ts")


@query(_reconcile_sql("store", "feed", "close", 0.000001, "bar_ts"))
def reconcile_premium(spark, d):
    return r.reconcile(fx.store(spark, d), fx.feed(spark, d), [("close", 0.000001)])


@query(_reconcile_sql("store", "feed", "close", 0.01, "bar_ts"))
def reconcile_spot(spark, d):
    return r.reconcile(fx.store(spark, d), fx.feed(spark, d), [("close", 0.01)])


_SPOT, _OIR = _reconcile_sql("store", "feed", "close", 0.01, "bar_ts"), _reconcile_sql(_OI, _OI_FEED, "sum_open_interest", 1.0, "ts")


@query(f", rep as (select 'spot' as dataset, * from ({_SPOT}) union all select 'open_interest', * from ({_OIR})) select *, (select bool_and(ok) from rep) as all_ok from rep")
def reconcile_report(spark, d):
    rep = reconcile_spot(spark, d).withColumn("dataset", F.lit("spot")).unionByName(reconcile_oi(spark, d).withColumn("dataset", F.lit("open_interest")))
    return rep.crossJoin(F.broadcast(rep.agg(F.bool_and("ok").alias("all_ok"))))  # one row


@query(PREVIOUS.format("raw_bars") + """select b.symbol, n_rows, first_ts, last_ts, close_time_ok, n_rows - n_distinct as duplicates, gaps from (
  select symbol, count(*) as n_rows, count(distinct bar_ts) as n_distinct, arg_min(bar_ts, (file, bar_ts)) as first_ts, arg_max(bar_ts, (file, bar_ts)) as last_ts,
    bool_and(date_diff('second', bar_ts, date_trunc('second', close_time)) between 3599 and 3600) as close_time_ok from raw_bars group by 1) b
  join (select symbol, count(*) filter (diff_s <> 3600) as gaps from diffs group by 1) g on b.symbol = g.symbol""")
def inspect_raw(spark, d):
    return q.profile(fx.raw_bars(spark, d))


CLEAN = """, clean as (
  select symbol, bar_ts, arg_min(open, file) as open, arg_min(c, file) as close, arg_min(close_time, file) as close_time, min(file) as file
  from (select *, try_cast(close_text as double) as c from raw_bars) where c is not null and bar_ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-25 00:00:00' group by 1, 2)
"""


def cleaned(spark, d):
    return q.clean(fx.raw_bars(spark, d).drop("close"), "2024-01-05 00:00:00", "2024-01-25 00:00:00").drop("line_no")


@query(CLEAN + "select * from clean")
def clean_ohlcv(spark, d):
    return cleaned(spark, d)


@query(CLEAN + PREVIOUS.format("clean") + "select symbol, count(*) filter (diff_s <> 3600) as gaps, count(*) as n_rows, count(*) filter (diff_s <> 3600) = 0 as may_write from diffs group by 1")
def gap_gate(spark, d):
    return q.gap_gate(cleaned(spark, d).select("symbol", "bar_ts"))


@query(BATCH + TARGETS + verdict_sql("batch", "targets", "v") + """select b.symbol, b.bar_ts, b.close from batch b join v using (symbol) where b.bar_ts = timestamp '2024-01-22 12:00:00'
  and (ok or not exists (select 1 from store s where s.symbol = b.symbol and s.bar_ts < b.bar_ts)) and not exists (select 1 from store s where s.symbol = b.symbol and s.bar_ts = b.bar_ts and s.symbol <> 'view')""", name="append_target")
def append_target_bar(spark, d):
    held = fx.store(spark, d).filter(~((F.col("symbol") == "view") & (F.col("bar_ts") >= fx.ntz("2024-01-22 12:00:00"))))
    return append_target(window_batch(spark, d), held, targets(spark, d)).select("symbol", "bar_ts", "close")


NEWER = "select {1} from {0} b left join (select symbol, max(bar_ts) as e from store group by 1) using (symbol) where e is null or b.bar_ts > e"


@query(RECENT + overlap_sql("recent") + "select b.symbol, b.bar_ts, b.open, b.high, b.low, b.close, b.volume from recent b join overlap o using (symbol) left join (select symbol, max(bar_ts) as e from store group by 1) using (symbol) where o.ok and (e is null or b.bar_ts > e)")
def recent_delta_ohlcv(spark, d):
    return recent_delta(fx.repeated(recent(spark, d)), fx.store(spark, d), validate=True).select("symbol", "bar_ts", "open", "high", "low", "close", "volume")


@query(RECENT + NEWER.format("recent", "symbol, bar_ts, open, high, low, close, volume, num_trades"))
def recent_delta_full(spark, d):
    return recent_delta(fx.repeated(recent(spark, d)), fx.store(spark, d))


METRIC_CUT = "ts < timestamp '2024-01-20 00:00:00' and not (hour(ts) in (10, 11) and day(ts) % 5 = 0)"


def metric_store(spark, d):
    hole = F.hour("ts").isin(10, 11) & (F.dayofmonth("ts") % 5 == 0)
    return fx.metrics5m(spark, d).filter((F.col("ts") < fx.ntz("2024-01-20 00:00:00")) & ~hole)


def closed_metrics(spark, d):
    return fx.metrics5m(spark, d).filter(S.opens_at(F.col("ts")) < S.hour_floor(basics.now()))


_CLOSED_METRICS = f"from metrics5m m left join (select symbol, max(ts) as e from metrics5m where {METRIC_CUT} group by 1) using (symbol) where ts - interval 1 hour < timestamp '2024-01-28 12:00:00' and (e is null or ts > e)"


@query("select symbol, ts as snapshot_time, ts - interval 1 hour as timestamp, sum_open_interest " + _CLOSED_METRICS)
def recent_delta_oi(spark, d):
    x = recent_delta(fx.repeated(closed_metrics(spark, d), "ts", "sum_open_interest"), metric_store(spark, d), ts="ts")
    return x.select("symbol", F.col("ts").alias("snapshot_time"), S.opens_at(F.col("ts")).alias("timestamp"), "sum_open_interest")


@query("select symbol, ts as snapshot_time, ts - interval 1 hour as timestamp, count_long_short_ratio as long_short_ratio " + _CLOSED_METRICS)
def recent_delta_ls(spark, d):
    x = recent_delta(fx.repeated(closed_metrics(spark, d), "ts", "sum_open_interest"), metric_store(spark, d), ts="ts")
    return x.select("symbol", F.col("ts").alias("snapshot_time"), S.opens_at(F.col("ts")).alias("timestamp"), F.col("count_long_short_ratio").alias("long_short_ratio"))


@query(RECENT + NEWER.format("recent", "symbol, bar_ts, bar_ts + interval 1 hour as snapshot_time, open, high, low, close"))
def recent_delta_premium(spark, d):
    x = recent_delta(fx.repeated(recent(spark, d)), fx.store(spark, d))
    return x.select("symbol", "bar_ts", S.closes_at(F.col("bar_ts")).alias("snapshot_time"), "open", "high", "low", "close")


@query(RECENT + NEWER.format("recent", "symbol, bar_ts, bar_ts + interval 1 hour as snapshot_time, open, high, low, close, volume, num_trades"))
def recent_delta_spot(spark, d):
    return recent_delta(fx.repeated(recent(spark, d)), fx.store(spark, d)).withColumn("snapshot_time", S.closes_at(F.col("bar_ts")))


CLEAN_METRICS = CALENDAR + """select symbol, snapshot_time, timestamp, is_fallback, sum_open_interest, sum_open_interest * 2 as sum_open_interest_value, count_long_short_ratio,
  sum_open_interest + 1 as count_toptrader_long_short_ratio, sum_open_interest / 2 as sum_toptrader_long_short_ratio, null::double as sum_taker_long_short_vol_ratio from snap"""


def six_metrics(spark, d):
    """Metrics with five of the six value columns; the sixth is absent."""
    oi = F.col("sum_open_interest")
    more = {"sum_open_interest_value": oi * 2, "count_toptrader_long_short_ratio": oi + 1, "sum_toptrader_long_short_ratio": oi / 2}
    return fx.metrics5m(spark, d).withColumns(more)


@query(CLEAN_METRICS)
def clean_metrics(spark, d):
    """The hourly snapshot of all six value columns as a CSV file, read back."""
    rows = sn.hourly_snapshot(six_metrics(spark, d)).drop("provenance")
    path = shared_path(spark, "clean_metrics")
    text.write_csv(rows, path)
    return text.csv_scan(spark, path, rows.schema)


SNAPSHOT = CALENDAR + f", mstore as (select symbol, ts as snapshot_time from metrics5m where {METRIC_CUT})"


def snapshot_backfill(spark, d):
    raw = six_metrics(spark, d)
    # the snapshot's hours lie between the raw rows' first and last one
    span = raw.agg(S.hour_floor(F.min("ts")).alias("lo"), S.hour_ceil(F.max("ts")).alias("hi")).first()
    held = metric_store(spark, d).withColumnRenamed("ts", "snapshot_time")
    return archive_backfill(sn.hourly_snapshot(raw), held, ["sum_open_interest"], ts="snapshot_time", bounds=tuple(span) if span.lo else None)


@query(SNAPSHOT + "select symbol, snapshot_time, timestamp, sum_open_interest from snap anti join mstore using (symbol, snapshot_time) where sum_open_interest is not null")
def backfill_oi(spark, d):
    return snapshot_backfill(spark, d).select("symbol", "snapshot_time", "timestamp", "sum_open_interest")


@query(SNAPSHOT + """select symbol, snapshot_time, timestamp, coalesce(count_long_short_ratio, 0) as long_short_ratio, coalesce(sum_open_interest + 1, 0) as long_account, coalesce(sum_open_interest / 2, 0) as short_account, 'archive' as source
from snap anti join mstore using (symbol, snapshot_time) where sum_open_interest is not null""")
def backfill_ls(spark, d):
    return basics.long_short_from_archive(snapshot_backfill(spark, d), "snapshot_time", "timestamp")


@query("select symbol, bar_ts, bar_ts + interval 1 hour as snapshot_time, open, high, low, close from candles anti join store using (symbol, bar_ts)")
def backfill_premium(spark, d):
    x = archive_backfill(fx.candles(spark, d), fx.store(spark, d), ["open", "close"])
    return x.select("symbol", "bar_ts", S.closes_at(F.col("bar_ts")).alias("snapshot_time"), "open", "high", "low", "close")


@query("select symbol, bar_ts, open, high, low, close, volume, num_trades, bar_ts + interval 1 hour as snapshot_time from candles anti join store using (symbol, bar_ts)")
def backfill_spot(spark, d):
    return archive_backfill(fx.candles(spark, d), fx.store(spark, d), ["open", "close"]).withColumn("snapshot_time", S.closes_at(F.col("bar_ts")))


def holed(spark, d):
    return fx.raw_klines(spark, d).withColumn("close", F.when(F.hour("bar_ts") % 7 != 0, F.col("close")))


IGNORE = "select symbol, bar_ts, arg_min(open, file) as open, arg_min(close, file) as close from raw_klines anti join store using (symbol, bar_ts) where hour(bar_ts) % 7 <> 0 group by 1, 2"


@query(IGNORE)
def insert_or_ignore(spark, d):
    batch = holed(spark, d)
    return st.insert_or_ignore(batch, fx.store(spark, d), ["open", "close"], bounds=st.batch_bounds(batch)).select("symbol", "bar_ts", "open", "close")


@query("""select symbol, n_delta as inserted, first_ts, last_ts, n_rows from (
  select symbol, min(bar_ts) as first_ts, max(bar_ts) as last_ts, count(*) as n_rows, count(*) filter (fresh) as n_delta from (
    select symbol, bar_ts, false as fresh from minute_store union all
    select symbol, bar_ts, true from minutes anti join minute_store using (symbol, bar_ts)
    where bar_ts + interval 1 minute - interval 1 millisecond < timestamp '2024-01-28 12:34:56' and hour(bar_ts) % 7 <> 0) group by 1)""")
def accumulate_1m(spark, d):
    """Closed one-minute bars, inserted unless stored or incomplete; then coverage of the store."""
    bars = fx.minutes(spark, d).withColumn("close", F.when(F.hour("bar_ts") % 7 != 0, F.col("close"))).withColumn("line_no", F.monotonically_increasing_id())
    batch = closed_strict(fx.repeated(bars))
    held = fx.minute_store(spark, d)
    fresh = st.insert_or_ignore(batch, held, schemas.REQUIRED["ohlcv_1m"], order=("open", "line_no"), bounds=st.batch_bounds(batch)).drop("line_no")
    after = held.unionByName(fresh)
    return st.coverage(after).join(fresh.groupBy("symbol").agg(F.count("*").alias("inserted")), "symbol", "left").fillna({"inserted": 0})


@query("""select symbol, "interval", bar_ts as timestamp, bar_ts + case "interval" when '1h' then interval 1 hour else interval 1 minute end as snapshot_time, open, high, low, close, volume from mixed_store
  where not ("interval" = '1m' and hour(bar_ts) = 4)""")
def store_write(spark, d):
    """Bars of two intervals through the writers of two stores and back; the one-minute store takes no row without a price."""
    bars = fx.mixed_store(spark, d).withColumnRenamed("bar_ts", "timestamp")
    bars = bars.withColumn("snapshot_time", F.col("timestamp") + F.make_dt_interval(secs=schemas.step_of(F.col("interval"))))
    bars = bars.withColumn("close", F.when((F.col("interval") == "1h") | (F.hour("timestamp") != 4), F.col("close")))
    out = None
    for interval, dataset in (("1h", "ohlcv"), ("1m", "ohlcv_1m")):
        path, own = shared_path(spark, dataset), bars.filter(F.col("interval") == interval)
        st.write_append(own, path, dataset)
        again = st.read_store(spark, path, schemas.STORES[dataset], st.batch_bounds(own, "timestamp"))
        st.write_append(st.append_absent(own.drop("market"), again, schemas.STORE_KEYS, "timestamp"), path, dataset)  # a second delivery adds nothing
        got = st.read_store(spark, path, schemas.STORES[dataset])
        got = got.select(*schemas.STORE_KEYS, "timestamp", "snapshot_time", *r.VALUES)
        out = got if out is None else out.unionByName(got)
    return out


_WINDOW_KEYS = """, vb as (select symbol, "interval", bar_ts, close from mixed_store where bar_ts between timestamp '2024-01-21 12:00:00' and timestamp '2024-01-22 12:00:00'),
ends as (select symbol, "interval", max(bar_ts) as target from vb group by 1, 2),
x as (select vb.*, lag(bar_ts) over (partition by symbol, "interval" order by bar_ts) as p from vb)
select symbol, "interval", case when n = 1 then 'no history' when gaps > 0 then 'not hourly' else 'validated' end as reason, n = 1 or gaps = 0 as ok, case when n > 1 and gaps = 0 then n - 1 else 0 end as validated
from (select symbol, "interval", count(*) as n, count(*) filter (date_diff('second', p, bar_ts) <> case "interval" when '1h' then 3600 else 60 end) as gaps from x group by 1, 2)
"""


@query(_WINDOW_KEYS)
def validate_intervals(spark, d):
    """Window validation of a store that holds two intervals: a series is a symbol and an interval."""
    held = fx.mixed_store(spark, d)
    batch = held.filter(F.col("bar_ts").between(fx.ntz("2024-01-21 12:00:00"), fx.ntz("2024-01-22 12:00:00")))
    ends = batch.groupBy(*schemas.STORE_KEYS).agg(F.max("bar_ts").alias("target"))
    return r.validate_window(batch, held, ends, keys=schemas.STORE_KEYS, step=schemas.step_of(F.col("interval")))


@query("select symbol, bar_ts, close from feed anti join store using (symbol, bar_ts)")
def append_absent(spark, d):
    batch = fx.feed(spark, d)
    return st.append_absent(batch, fx.store(spark, d), bounds=st.batch_bounds(batch)).select("symbol", "bar_ts", "close")


@query(NEWER.format("feed", "symbol, bar_ts, close"))
def append_newer(spark, d):
    return st.append_newer(fx.repeated(fx.feed(spark, d)), fx.store(spark, d)).select("symbol", "bar_ts", "close")


@query("select symbol, bar_ts, count(*) as copies from raw_klines group by 1, 2 having count(*) > 1")
def unique_key_audit(spark, d):
    return st.unique_key_audit(fx.raw_klines(spark, d))


@query("select symbol, bar_ts, bar_ts + interval 1 hour as snapshot_time from store")
def migrate_snapshot(spark, d):
    held = fx.store(spark, d).select("symbol", "bar_ts", F.when(F.hour("bar_ts") % 2 == 0, S.closes_at(F.col("bar_ts"))).alias("snapshot_time"))
    return st.migrate_snapshot(held)


@query("""select s.symbol, s.bar_ts, s.close as store_close, f.close as feed_close, f.close is not null as found, round(abs(s.close - f.close), 10) as diff from
  (select * from store order by (epoch(bar_ts)::bigint // 3600) * 48271 % 2147483647 * (42 + 16807) % 2147483647, symbol limit 50) s left join feed f using (symbol, bar_ts)""")
def sample_compare(spark, d):
    sample = fx.store(spark, d).orderBy(basics.seeded_rank(), "symbol").limit(50).select("symbol", "bar_ts", F.col("close").alias("store_close"))
    x = sample.join(fx.feed(spark, d).select("symbol", "bar_ts", F.col("close").alias("feed_close")), ["symbol", "bar_ts"], "left")
    return x.withColumn("found", F.col("feed_close").isNotNull()).withColumn("diff", F.round(r.difference(F.col("store_close"), F.col("feed_close")), 10))


@query("""select 'absent' as policy, symbol, count(*) as inserted from feed anti join store using (symbol, bar_ts) group by 2
  union all select 'newer', symbol, count(*) from (""" + NEWER.format("feed", "symbol, bar_ts") + ") group by 2")
def late_policy(spark, d):
    per = lambda name, rows: rows.groupBy("symbol").agg(F.count("*").alias("inserted")).withColumn("policy", F.lit(name))
    return per("absent", st.append_absent(fx.feed(spark, d), fx.store(spark, d))).unionByName(per("newer", st.append_newer(fx.feed(spark, d), fx.store(spark, d))))


# ---------------------------------------------------------------- kept summaries


def parts_of(rows: DataFrame, n: int = 3, ts: str = "bar_ts") -> list[DataFrame]:
    """Rows dealt to n deliveries, in no order of time."""
    return [rows.filter(F.pmod(F.hour(ts) * 7 + F.dayofmonth(ts) * 5, F.lit(n)) == i) for i in range(n)]


def kept_store(spark, rows: DataFrame, ts: str = "bar_ts") -> KeptStore:
    """A store with a summary, filled by several appends out of order."""
    store = KeptStore(spark, shared_path(spark, "kept"), rows.schema, ts=ts)
    for part in parts_of(rows, ts=ts):
        store.append(part)
    return store


@query("select symbol, min(bar_ts) as first_ts, max(bar_ts) as last_ts, count(*) as n_rows from store group by 1")
def kept_coverage(spark, d):
    """Coverage from the summary alone."""
    return kept_store(spark, fx.store(spark, d)).coverage()


@query(NEWER.format("feed", "symbol, bar_ts, close"))
def kept_append_newer(spark, d):
    """What lies behind the summary's last time, each key once."""
    return kept_store(spark, fx.store(spark, d)).append(fx.repeated(fx.feed(spark, d)), "newer").select("symbol", "bar_ts", "close")


@query("select 'delta' as what, symbol, bar_ts from feed anti join store using (symbol, bar_ts) union all select 'held', symbol, bar_ts from store")
def dry_run(spark, d):
    """The rows that an append would insert, and the store after asking: as it was."""
    store = kept_store(spark, fx.store(spark, d))
    delta = written(store.delta(fx.repeated(fx.feed(spark, d))), "dry")
    what = lambda rows, name: rows.select(F.lit(name).alias("what"), "symbol", "bar_ts")
    return what(delta, "delta").unionByName(what(store.read(), "held"))


@query(BATCH + TARGETS + verdict_sql("batch", "targets", "v") + "select * from v")
def kept_validate_window(spark, d):
    return kept_store(spark, fx.store(spark, d)).validate_window(window_batch(spark, d), targets(spark, d))


@query(RECENT + overlap_sql("recent") + "select b.symbol, b.bar_ts, b.open, b.close from recent b join overlap o using (symbol) left join (select symbol, max(bar_ts) as e from store group by 1) using (symbol) where o.ok and (e is null or b.bar_ts > e)")
def kept_recent_delta(spark, d):
    return recent_delta(fx.repeated(recent(spark, d)), kept_store(spark, fx.store(spark, d)), validate=True).select("symbol", "bar_ts", "open", "close")


@query(CALENDAR + "select * from snap")
def snapshot_refresh(spark, d):
    """The hourly snapshot after three deliveries out of order, of which each changed only the hours that it affects."""
    rows, values = fx.metrics5m(spark, d), ["sum_open_interest", "count_long_short_ratio"]
    raw, path = KeptStore(spark, shared_path(spark, "raw"), rows.schema, ts="ts"), shared_path(spark, "snapshot")
    for part in parts_of(rows, ts="ts"):
        sn.refresh_snapshot(raw, part, path, values)
    return sn.read_snapshot(spark, path, sn.hourly_snapshot(rows, values).schema)


@query(_reconcile_sql("store", "feed", "close", 0.01, "bar_ts"))
def reconcile_digests(spark, d):
    """The report of reconciliation; only days whose digests differ were joined."""
    return r.reconcile_by_digest(fx.store(spark, d), fx.feed(spark, d), [("close", 0.01)])[0]


@query("""select f.symbol, f.bar_ts, s.bar_ts as asof_ts, s.close from (select symbol, bar_ts from feed) f asof left join (select symbol, bar_ts, close from store where hour(bar_ts) % 5 = 0) s
  on f.symbol = s.symbol and f.bar_ts >= s.bar_ts where s.bar_ts is null or f.bar_ts - s.bar_ts <= interval 30 hour
  union all select f.symbol, f.bar_ts, null, null from (select symbol, bar_ts from feed) f asof join (select symbol, bar_ts from store where hour(bar_ts) % 5 = 0) s on f.symbol = s.symbol and f.bar_ts >= s.bar_ts
  where f.bar_ts - s.bar_ts > interval 30 hour""")
def asof_tolerance(spark, d):
    """The last stored fifth hour of at most thirty hours before each bar of the feed."""
    held = fx.store(spark, d).filter(F.hour("bar_ts") % 5 == 0)
    return asof_join(fx.feed(spark, d).select("symbol", "bar_ts"), held, ["close"], 30 * 3600, ts="bar_ts")


# ---------------------------------------------------------------- rewrites, counters of the writing pass


@query("select symbol, bar_ts as timestamp, bar_ts + interval 1 hour as snapshot_time, close, volume as base_volume, num_trades::bigint as num_trades from store")
def rewrite_days(spark, d):
    """A store without snapshot times, with a narrow count and an old column name, rewritten in steps; the run is cut off after two and resumed."""
    old = fx.store(spark, d).select("symbol", F.col("bar_ts").alias("timestamp"), "close", "volume", "num_trades")
    path = shared_path(spark, "rewritten")
    st.write_append(old, path)
    schema = T.StructType.fromDDL("symbol string, timestamp timestamp_ntz, snapshot_time timestamp_ntz, close double, base_volume double, num_trades long")
    fill = lambda rows: st.migrate_snapshot(rows, "timestamp")
    for steps in (2, None):
        rw.rewrite_store(spark, path, schema, fill, "snapshot", {"volume": "base_volume"}, days_per_step=5, steps=steps)
    return st.read_store(spark, path, schema)


@query(f"""select n.*, k.* from (select sum(n_rows)::bigint as n_rows, sum(dropped_incomplete)::bigint as dropped_incomplete, sum(dropped_duplicate)::bigint as dropped_duplicate from ({basics.COUNTERS})) n,
  (select count(*) as inserted, min(bar_ts) as first_ts, max(bar_ts) as last_ts, count(*) as stored from (select distinct symbol, bar_ts from raw_bars where try_cast(close_text as double) is not null)) k""")
def counters_written(spark, d):
    """Counters that the cleaning write itself gave, beside the number of rows then stored."""
    rows, path = fx.raw_bars(spark, d), shared_path(spark, "cleaned")
    rows = rows.withColumn("close", S.number(F.col("close_text"))).drop("close_text")
    got = write_clean(rows, path, ["open", "close"])
    schema = "n_rows long, dropped_incomplete long, dropped_duplicate long, inserted long, first_ts timestamp_ntz, last_ts timestamp_ntz"
    return spark.createDataFrame([tuple(got.values())], schema).join(st.read_store(spark, path, rows.schema).agg(F.count("*").alias("stored")))


@query("select symbol, count(*) as inserted, min(bar_ts) as first_ts, max(bar_ts) as last_ts from (select * from feed anti join store using (symbol, bar_ts)) group by 1")
def append_counted(spark, d):
    """What an append put in, per series, from its entry in the summary."""
    store = kept_store(spark, fx.store(spark, d))
    store.append(fx.repeated(fx.feed(spark, d)), name="feed")
    return store.appended("feed")


@query("select count(*) as n_rows, count(*) filter (try_cast(epoch_text as bigint) > 1000000000000000) as micros_rows, count(*) filter (try_cast(epoch_text as bigint) is null) as bad_rows from raw_epoch")
def stream_counters(spark, d):
    """Row and unit counters of epochs that arrive in three deliveries, told by the writing stream."""
    rows, landing, out, work = fx.raw_epoch(spark, d), *(shared_path(spark, x) for x in ("landing", "epochs", "stream"))
    x, told = F.col("epoch_text").try_cast("bigint"), []
    for i in range(3):
        rows.filter(F.col("event_id") % 3 == i).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        write = lambda w: w.format("parquet").option("path", out).option("checkpointLocation", work)
        told += run_counted(stream, write, n_rows=F.count("*"), micros_rows=F.count_if(x > S.MICROS_FROM), bad_rows=F.count_if(x.isNull())).values()
    sums = ("n_rows", "micros_rows", "bad_rows")
    return spark.createDataFrame(told, ", ".join(f"{c} long" for c in sums)).agg(*(F.sum(c).alias(c) for c in sums))


def bucketed_store(spark, rows: DataFrame) -> BucketedStore:
    """A store bucketed by series, filled by several appends out of order."""
    by_series(spark)
    store = BucketedStore(spark, f"bars_{uuid.uuid4().hex}", shared_path(spark, "bucketed"), rows.schema, buckets=4)
    for part in parts_of(rows):
        store.append(part)
    return store


@query("select symbol, bar_ts, close from store union all select symbol, bar_ts, close from feed anti join store using (symbol, bar_ts)")
def bucketed_append(spark, d):
    """A store bucketed by series after an append of a feed with repeats."""
    store = bucketed_store(spark, fx.store(spark, d).select("symbol", "bar_ts", "close", "open"))
    for _ in range(2):  # the second delivery adds nothing
        store.append(fx.repeated(fx.feed(spark, d)).select("symbol", "bar_ts", "close", "open"))
    return store.read().select("symbol", "bar_ts", "close")


@query(_reconcile_sql("store", "feed", "close", 0.01, "bar_ts"))
def bucketed_reconcile(spark, d):
    """The report of reconciliation of two stores bucketed alike: no stored row moves."""
    return r.reconcile(bucketed_store(spark, fx.store(spark, d)).read(), bucketed_store(spark, fx.feed(spark, d)).read(), [("close", 0.01)])


# ---------------------------------------------------------------- streaming


def deliveries(spark, d):
    """Three deliveries of bars: early rows, late rows with repeats, and the holes, of which some come again with another price."""
    c = fx.candles(spark, d).select("symbol", "bar_ts", "close")
    hole = F.hour("bar_ts") == 9
    again = c.filter(F.hour("bar_ts") == 8).withColumn("close", F.col("close") + 1)
    return [c.filter((F.col("bar_ts") < fx.ntz("2024-01-15 00:00:00")) & ~hole), c.filter((F.col("bar_ts") >= fx.ntz("2024-01-14 00:00:00")) & ~hole), c.filter(hole).union(again)]


def land(part: DataFrame, path: str) -> None:
    part.repartition("symbol", F.to_date("bar_ts")).write.mode("append").parquet(path)


BARS = "symbol string, bar_ts timestamp_ntz, close double"


@query("select symbol, bar_ts, close from candles")
def stream_dedupe(spark, d):
    """Each delivery is taken up by a run of its own, as by a timer; the store and the progress carry over."""
    landing, at, work = (shared_path(spark, x) for x in ("landing", "bars", "stream"))
    for part in deliveries(spark, d):
        land(part, landing)
        got = jobs.ingest(spark, landing, BARS, at, work)
    return got


def _stream(spark, d, **more):
    landing = shared_path(spark, "landing")
    for part in deliveries(spark, d):
        land(part, landing)
    return jobs.ingest(spark, landing, BARS, shared_path(spark, "bars"), shared_path(spark, "stream"), **more)


@query("select symbol, bar_ts, close from candles")
def stream_accumulate(spark, d):
    """All deliveries in one run: repeats inside a batch and across batches give the same store."""
    return _stream(spark, d)


@query("select symbol, bar_ts, close from candles where bar_ts + interval 1 hour <= timestamp '2024-01-28 12:00:00'")
def stream_closed(spark, d):
    return _stream(spark, d, transform=closed)


@query("select distinct symbol, bar_ts from candles")
def stream_dedupe_within(spark, d):
    """The bounded-state variant; its delay covers the whole span, so no row is too late."""
    landing, out, work = (shared_path(spark, x) for x in ("landing", "within", "stream"))
    for part in deliveries(spark, d):
        land(part.select("symbol", "bar_ts"), landing)
    stream = spark.readStream.schema("symbol string, bar_ts timestamp_ntz").parquet(landing)
    kept = jobs.dedupe_within(stream, ["symbol"], "bar_ts", "60 days")
    kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", work).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("symbol string, bar_ts timestamp_ntz").parquet(out)


@query(PREVIOUS.format("store") + "select symbol, prev_ts, bar_ts as ts, diff_s from diffs where diff_s <> 3600")
def stream_gaps(spark, d):
    """Final gaps of bars that arrive out of order in three deliveries; two beats of a clock let every time pass."""
    landing, out, work = (shared_path(spark, x) for x in ("landing", "gaps", "watch"))
    beat = lambda ts: spark.sql(f"select '~' as symbol, timestamp_ntz'{ts}' as bar_ts")
    for part in [*parts_of(fx.store(spark, d).select("symbol", "bar_ts")), beat("2025-01-01 00:00:00"), beat("2025-01-01 01:00:00")]:
        part.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("symbol string, bar_ts timestamp_ntz").parquet(landing)
        told = gaps.watch_to_end(spark, gaps.watch(stream, delay="60 days"), out, work)
    return told.filter("kind = 'gap' and symbol <> '~'").drop("kind")


@query(BATCH + overlap_sql("batch") + "select b.symbol, b.bar_ts, b.close, o.reason from batch b join overlap o using (symbol) where not o.ok")
def stream_quarantine(spark, d):
    """Rows of series whose overlap with the store isn't sound, held back from it with the reason."""
    rows = window_batch(spark, d)
    store, landing, work = kept_store(spark, fx.store(spark, d)), shared_path(spark, "landing"), shared_path(spark, "validated")
    rows.coalesce(1).write.parquet(landing)
    archive_jobs.ingest_validated(spark.readStream.schema(rows.schema).parquet(landing), store, work)
    return archive_jobs.quarantined(store, work).select("symbol", "bar_ts", "close", "reason")
