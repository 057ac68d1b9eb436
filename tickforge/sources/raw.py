"""Exchange messages as JSON strings to canonical rows; the same expressions read files and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.micro import parse_levels
from ..schema import PRICE

#: Columns of a candle message, in order.
KLINE_NAMES = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote")
_LONGS = ("open_time", "close_time", "trades")


def _parsed(df: DataFrame, column: str) -> DataFrame:
    """Fields differ by case alone, so messages are read as maps, whose keys are matched exactly."""
    return df.withColumn("_j", F.from_json(column, "map<string,string>"))


def _f(name: str, kind: str = "string") -> Column:
    return F.try_element_at("_j", F.lit(name)).cast(kind)


def agg_trades(df: DataFrame, symbol: Column, column: str = "value") -> DataFrame:
    ts = F.timestamp_millis(_f("T", "long"))
    return _parsed(df, column).select(
        symbol.alias("symbol"), _f("a", "long").alias("trade_id"), ts.alias("ts"), _f("p", PRICE).alias("price"), _f("q", PRICE).alias("quantity"),
        _f("m", "boolean").alias("is_buyer_maker"), F.to_date(ts).alias("date"), _f("f", "long").alias("first_trade_id"), _f("l", "long").alias("last_trade_id"), _f("M", "boolean").alias("is_best_match"),
    )


def trade_events(df: DataFrame, column: str = "value") -> DataFrame:
    p, q = _f("p", PRICE), _f("q", PRICE)
    return _parsed(df, column).select(_f("s").alias("symbol"), _f("t", "long").alias("trade_id"), F.timestamp_millis(_f("T", "long")).alias("ts"), p.alias("price"), q.alias("quantity"), _f("m", "boolean").alias("is_buyer_maker"), F.to_date(F.timestamp_millis(_f("T", "long"))).alias("date"), (p * q).alias("quote_quantity"))


def agg_trade_events(df: DataFrame, column: str = "value") -> DataFrame:
    return agg_trades(df.withColumn("_s", F.get_json_object(column, "$.s")), F.col("_s"), column)


def depth_events(df: DataFrame, column: str = "value") -> DataFrame:
    level = lambda c: F.transform(c, lambda p: F.struct(F.get(p, 0).cast(PRICE).alias("price"), F.get(p, 1).cast(PRICE).alias("quantity")))
    return _parsed(df, column).select(_f("s").alias("symbol"), F.timestamp_millis(_f("E", "long")).alias("ts"), _f("U", "long").alias("first_update_id"), _f("u", "long").alias("last_update_id"), level(F.from_json(_f("b"), "array<array<string>>")).alias("bids"), level(F.from_json(_f("a"), "array<array<string>>")).alias("asks"))


def klines(df: DataFrame, symbol: Column, column: str = "value") -> DataFrame:
    """A 12-element JSON array per row to named columns; the last element is ignored."""
    d = df.withColumn("_k", F.from_json(column, "array<string>"))
    cols = [F.get("_k", F.lit(i)).cast("long" if n in _LONGS else PRICE).alias(n) for i, n in enumerate(KLINE_NAMES)]
    return d.select(symbol.alias("symbol"), *cols, F.to_date(F.timestamp_millis(F.get("_k", F.lit(0)).cast("long"))).alias("date"))


def book_snapshots(df: DataFrame, levels: int = 20) -> DataFrame:
    """bids_json and asks_json to arrays of (price, quantity) with level counts."""
    d = df.withColumn("bids", parse_levels(F.col("bids_json"), levels)).withColumn("asks", parse_levels(F.col("asks_json"), levels))
    return d.withColumn("bid_levels", F.size("bids")).withColumn("ask_levels", F.size("asks")).drop("bids_json", "asks_json")


def envelope(df: DataFrame, topic: str, at: Column) -> DataFrame:
    """(key, value): the row as JSON in an envelope with topic and time, ready for a message sink."""
    return df.select(F.lit(topic).alias("key"), F.to_json(F.struct(F.lit(topic).alias("topic"), at.alias("timestamp"), F.struct(*df.columns).alias("data"))).alias("value"))
