"""Stand-in tables over ``events``: bars, a second feed, a store, raw lines, epochs and five-minute metrics.

An event type plays the instrument. The tables feed the registered queries; building bars from
ticks is no capability of the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed clock of all registered queries.
NOW = "2024-01-28 12:34:56"


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def hour_of(c):
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def minute_of(c):
    return F.date_trunc("minute", c).cast("timestamp_ntz")


def candles(spark, sf_dir, opens=hour_of) -> DataFrame:
    return (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("symbol"), opens(F.col("ts")).alias("bar_ts"))
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("close"),
            F.round(F.sum("value"), 4).alias("volume"),
            F.count("*").cast("int").alias("num_trades"),
        )
    )


def feed(spark, sf_dir) -> DataFrame:
    c = candles(spark, sf_dir).filter((F.col("bar_ts") >= ntz("2024-01-16 00:00:00")) & (F.hour("bar_ts") != 3))
    return c.withColumn("close", F.when(F.hour("bar_ts") == 5, F.col("close") + 0.02).when(F.hour("bar_ts") == 7, F.col("close") + 0.000000001).otherwise(F.col("close")))


def held(bars: DataFrame) -> DataFrame:
    hole = F.hour("bar_ts").isin(10, 11) & (F.dayofmonth("bar_ts") % 5 == 0)
    return bars.filter((F.col("bar_ts") < ntz("2024-01-25 00:00:00")) & ~hole)


def store(spark, sf_dir) -> DataFrame:
    return held(candles(spark, sf_dir))


def minutes(spark, sf_dir) -> DataFrame:
    """One-minute bars."""
    return candles(spark, sf_dir, minute_of)


def minute_store(spark, sf_dir) -> DataFrame:
    return held(minutes(spark, sf_dir))


def mixed_store(spark, sf_dir) -> DataFrame:
    """Hourly and one-minute bars of the same instruments in one store, told apart by ``interval``."""
    columns = ["symbol", "bar_ts", "open", "high", "low", "close", "volume"]
    hours, mins = (t.select(*columns, F.lit(i).alias("interval")) for t, i in ((store(spark, sf_dir), "1h"), (minute_store(spark, sf_dir), "1m")))
    return hours.unionByName(mins)


def repeated(batch: DataFrame, ts: str = "bar_ts", value: str = "open") -> DataFrame:
    """A batch with some bars twice, the second with a larger value, and rows without a time or a series."""
    again = batch.filter(F.hour(ts) % 6 == 0).withColumn(value, F.col(value) + 1)
    some = batch.filter(F.hour(ts) == 1)
    return batch.unionByName(again).unionByName(some.withColumn(ts, F.lit(None).cast("timestamp_ntz"))).unionByName(some.withColumn("symbol", F.lit(None).cast("string")))


def raw_klines(spark, sf_dir) -> DataFrame:
    c = candles(spark, sf_dir)
    a = c.select("symbol", "bar_ts", "open", "close", F.lit("a").alias("file"), F.lit(0).alias("line_no"))
    b = c.filter(F.hour("bar_ts") % 6 == 0).select("symbol", "bar_ts", (F.col("open") + 1).alias("open"), "close", F.lit("b").alias("file"), F.lit(0).alias("line_no"))
    return a.unionByName(b)


def raw_bars(spark, sf_dir) -> DataFrame:
    """raw_klines with a close time that is one second late in hours divisible by 11, and text prices of which some are junk."""
    late = F.when(F.hour("bar_ts") % 11 == 0, F.expr("interval 1 second")).otherwise(F.expr("interval 0 second"))
    r = raw_klines(spark, sf_dir).withColumn("close_time", F.col("bar_ts") + F.expr("interval 1 hour") - F.expr("interval 1 millisecond") + late)
    return r.withColumn("close_text", F.when(F.hour("bar_ts") == 13, F.lit("n/a")).otherwise(F.round("close", 6).cast("decimal(20,6)").cast("string")))


def raw_epoch(spark, sf_dir) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    text = F.when(F.col("event_id") % 97 == 0, "bad").when(F.col("event_id") % 3 == 0, micros.cast("string")).otherwise(F.expr("unix_micros(cast(ts as timestamp)) div 1000").cast("string"))
    return events(spark, sf_dir).select("event_id", text.alias("epoch_text"))


def metrics5m(spark, sf_dir) -> DataFrame:
    five = F.window("ts", "5 minutes")["start"].cast("timestamp_ntz")
    return (
        events(spark, sf_dir)
        .select("event_type", "event_id", "value", five.alias("ts"))
        .groupBy(F.col("event_type").alias("symbol"), "ts")
        .agg(F.max_by("value", "event_id").alias("sum_open_interest"), F.count("*").cast("double").alias("count_long_short_ratio"))
    )
