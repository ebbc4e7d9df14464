"""Store schemas, the raw kline columns, and the aliases under which archives name them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the exchange's files and of the stores.
KLINE_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_asset_volume",
    "number_of_trades", "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume", "ignore",
]
ALIASES = {
    "quote_volume": "quote_asset_volume",
    "count": "num_trades",
    "number_of_trades": "num_trades",
    "taker_buy_volume": "taker_buy_base_volume",
    "taker_buy_base_asset_volume": "taker_buy_base_volume",
    "taker_buy_quote_asset_volume": "taker_buy_quote_volume",
}
EXPORT_COLUMNS = ["timestamp", "open", "high", "low", "close", "volume"]

_KEY = [T.StructField(c, T.StringType()) for c in ("market", "symbol", "interval")] + [T.StructField(c, T.TimestampNTZType()) for c in ("timestamp", "snapshot_time")]


#: The key of each store: one store holds many instruments and intervals.
STORE_KEYS = ("symbol", "interval")
#: Seconds of the intervals in use.
STEPS = {"1m": 60, "5m": 300, "1h": 3600, "1d": 86400}


def step_of(interval: Column) -> Column:
    """Seconds between the bars of an interval; null for an unknown one."""
    return F.create_map(*(F.lit(x) for pair in STEPS.items() for x in pair))[interval]


def _store(doubles: list[str], ints: list[str] = (), written: str = "created_at") -> T.StructType:
    fields = [T.StructField(c, T.DoubleType()) for c in doubles] + [T.StructField(c, T.IntegerType()) for c in ints]
    return T.StructType([*_KEY, *fields, T.StructField(written, T.TimestampNTZType())])


PRICES = ["open", "high", "low", "close"]
STORES = {
    "ohlcv": _store([*PRICES, "volume"]),
    "ohlcv_full": _store([*PRICES, "volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"], ["num_trades"]),
    "open_interest": _store(["sum_open_interest", "sum_open_interest_value"]),
    "long_short": _store(["long_short_ratio", "long_account", "short_account"]),
    "premium": _store(PRICES),
    "spot": _store([*PRICES, "volume", "taker_buy_base_volume"], ["num_trades"]),
    "ohlcv_1m": _store([*PRICES, "volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"], ["num_trades"], written="ingested_at"),
}
#: Columns that a store doesn't take as null: rows without them are ignored.
REQUIRED = {"ohlcv_1m": [*PRICES, "volume"]}


def canonical(df: DataFrame) -> DataFrame:
    """Archive column names in the store's spelling."""
    return df.withColumnsRenamed({k: v for k, v in ALIASES.items() if k in df.columns})


def clean_names(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*(c.strip().lower() for c in df.columns))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` itself, or an error that names the missing columns; no job runs."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def as_store(df: DataFrame, dataset: str) -> DataFrame:
    """``df`` in the columns, order and types of a store; absent columns are null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in STORES[dataset]))
