"""Registered queries and the SQL that checks them, side by side."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: The stand-in tables in DuckDB.
TABLES = """
candles as (
  select event_type as symbol, date_trunc('hour', ts) as bar_ts, arg_min(value, event_id) as open, max(value) as high, min(value) as low,
    arg_max(value, event_id) as close, round(sum(value), 4) as volume, cast(count(*) as int) as num_trades from events group by 1, 2),
feed as (
  select symbol, bar_ts, open, high, low, case hour(bar_ts) when 5 then close + 0.02 when 7 then close + 0.000000001 else close end as close, volume, num_trades
  from candles where bar_ts >= timestamp '2024-01-16 00:00:00' and hour(bar_ts) <> 3),
store as (select * from candles where bar_ts < timestamp '2024-01-25 00:00:00' and not (hour(bar_ts) in (10, 11) and day(bar_ts) % 5 = 0)),
raw_klines as (
  select symbol, bar_ts, open, close, 'a' as file, 0 as line_no from candles
  union all select symbol, bar_ts, open + 1, close, 'b', 0 from candles where hour(bar_ts) % 6 = 0),
raw_bars as (
  select *, bar_ts + interval 1 hour - interval 1 millisecond + case when hour(bar_ts) % 11 = 0 then interval 1 second else interval 0 second end as close_time,
    case when hour(bar_ts) = 13 then 'n/a' else cast(cast(round(close, 6) as decimal(20, 6)) as varchar) end as close_text from raw_klines),
raw_epoch as (
  select event_id, case when event_id % 97 = 0 then 'bad' when event_id % 3 = 0 then cast(epoch_us(ts) as varchar) else cast(epoch_us(ts) // 1000 as varchar) end as epoch_text from events),
minutes as (
  select event_type as symbol, date_trunc('minute', ts) as bar_ts, arg_min(value, event_id) as open, max(value) as high, min(value) as low,
    arg_max(value, event_id) as close, round(sum(value), 4) as volume, cast(count(*) as int) as num_trades from events group by 1, 2),
minute_store as (select * from minutes where bar_ts < timestamp '2024-01-25 00:00:00' and not (hour(bar_ts) in (10, 11) and day(bar_ts) % 5 = 0)),
mixed_store as (select symbol, '1h' as "interval", bar_ts, open, high, low, close, volume from store union all select symbol, '1m', bar_ts, open, high, low, close, volume from minute_store),
metrics5m as (
  select symbol, ts, arg_max(value, event_id) as sum_open_interest, cast(count(*) as double) as count_long_short_ratio
  from (select event_type as symbol, event_id, value, time_bucket(interval 5 minutes, ts) as ts from events) group by 1, 2)
"""


def query(sql: str, name: str | None = None):
    """Register a function (spark, sf_dir) under its name or ``name``; ``sql`` follows the stand-in tables."""

    def register(f):
        QUERIES[name or f.__name__] = f
        ORACLE_SQL[name or f.__name__] = f"with {TABLES}{sql}"
        return f

    return register
