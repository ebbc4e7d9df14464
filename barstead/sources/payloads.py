"""Landed API payloads: arrays of arrays, arrays of objects, single objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Cell positions of a kline.
CELLS = {"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "quote_asset_volume": 7, "taker_buy_base_volume": 9, "taker_buy_quote_volume": 10}


def klines(payloads: DataFrame, column: str = "payload", kind: str = "perp") -> DataFrame:
    """Bars of JSON arrays of arrays, typed, with ``close_time``; ``premium`` has volume 0 and no trade fields. A cell that doesn't parse is null."""
    keep = [c for c in payloads.columns if c != column]
    rows = payloads.select(*keep, F.explode(F.from_json(column, "array<array<string>>")).alias("k"))
    cell = lambda i: F.get("k", F.lit(i))
    cols = [S.from_ms(cell(0).try_cast("bigint")).alias("timestamp"), S.from_ms(cell(6).try_cast("bigint")).alias("close_time")]
    for name, i in CELLS.items():
        value = cell(i).try_cast("double")
        if kind == "premium":
            value = F.lit(0.0) if name == "volume" else value if name in ("open", "high", "low", "close") else F.lit(None).cast("double")
        if kind == "spot" and name in ("quote_asset_volume", "taker_buy_quote_volume"):
            continue
        cols.append(value.alias(name))
    trades = F.lit(None).cast("int") if kind == "premium" else cell(8).try_cast("int")
    return rows.select(*keep, *cols, trades.alias("num_trades"))


def metrics(payloads: DataFrame, fields: dict[str, str], column: str = "payload", time: str = "timestamp") -> DataFrame:
    """Rows of JSON arrays of objects; ``fields`` maps JSON names to columns. Numbers arrive as text."""
    keep = [c for c in payloads.columns if c != column]
    kind = "array<struct<" + ", ".join(f"{f}: string" for f in [*fields, time]) + ">>"
    rows = payloads.select(*keep, F.explode(F.from_json(column, kind)).alias("o"))
    return rows.select(*keep, S.from_ms(F.col(f"o.{time}").try_cast("bigint")).alias("snapshot_time"), *(F.col(f"o.{f}").try_cast("double").alias(c) for f, c in fields.items()))


def single(payloads: DataFrame, fields: dict[str, str], column: str = "payload") -> DataFrame:
    """One row of a single JSON object; ``fields`` maps names to types."""
    keep = [c for c in payloads.columns if c != column]
    kind = ", ".join(f"{f} string" for f in fields)
    rows = payloads.select(*keep, F.from_json(column, kind).alias("o"))
    return rows.select(*keep, *(F.col(f"o.{f}").try_cast(t).alias(f) for f, t in fields.items()))
