"""Retrieval, projection, top-k and set operations on ticks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ORDER = ("ts", "trade_id")


def select_ticks(ticks: DataFrame, symbol: str | None = None, symbols: list[str] | None = None, start: datetime | None = None, end: datetime | None = None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Ticks of a symbol or several in an inclusive time range, oldest first if limited. Bounds also prune dates."""
    if start and end and start > end:
        raise ValueError("start is after end")
    df = ticks
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        df = df.where((F.col("ts") >= F.lit(start)) & (F.col("date") >= F.lit(start.date())))
    if end is not None:
        df = df.where((F.col("ts") <= F.lit(end)) & (F.col("date") <= F.lit(end.date())))
    if limit is not None:
        df = df.orderBy("ts", "trade_id").limit(limit)
    return df.select(*columns) if columns else df


def last_days(ticks: DataFrame, as_of: datetime, days: int = 7, symbol: str | None = None) -> DataFrame:
    return select_ticks(ticks, symbol, start=as_of - timedelta(days=days), end=as_of)


def recent_window(ticks: DataFrame, as_of: datetime, seconds: int = 60, symbol: str | None = None) -> DataFrame:
    return select_ticks(ticks, symbol, start=as_of - timedelta(seconds=seconds), end=as_of)


def drop_incomplete_tail(ticks: DataFrame, cutoff: datetime) -> DataFrame:
    return ticks.where(F.col("ts") <= F.lit(cutoff))


def since(ticks: DataFrame, symbol: str, after_ts: datetime, after_id: int, batch: int) -> DataFrame:
    """The next page of a symbol's ticks after (after_ts, after_id): keyset paging, stable under ties."""
    key = (F.col("ts") > F.lit(after_ts)) | ((F.col("ts") == F.lit(after_ts)) & (F.col("trade_id") > after_id))
    return ticks.where((F.col("symbol") == symbol) & key).orderBy("ts", "trade_id").limit(batch)


def new_since(ticks: DataFrame, cursors: DataFrame) -> DataFrame:
    """Ticks beyond each symbol's last known id; symbols without a cursor are all new."""
    c = cursors.select("symbol", F.col("last_id").alias("_last"))
    return ticks.join(c, "symbol", "left").where(F.col("_last").isNull() | (F.col("trade_id") > F.col("_last"))).drop("_last")


def with_dollar_volume(ticks: DataFrame) -> DataFrame:
    """Adds dollar_volume and side (a buyer who is maker means a seller took)."""
    return ticks.withColumn("dollar_volume", F.col("price") * F.col("quantity")).withColumn("side", F.when(F.col("is_buyer_maker"), "sell").otherwise("buy"))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    return df.withColumnsRenamed(mapping)


def finite_metrics(long: DataFrame, value: str = "value") -> DataFrame:
    v = F.col(value).cast("double")
    return long.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def latest(ticks: DataFrame, n: int = 100, symbol: str | None = None) -> DataFrame:
    """The newest n ticks, over all symbols or of one."""
    return select_ticks(ticks, symbol).orderBy(F.desc("ts"), F.desc("trade_id")).limit(n)


def last_n_per_symbol(ticks: DataFrame, n: int) -> DataFrame:
    w = W.partitionBy("symbol").orderBy(F.desc("ts"), F.desc("trade_id"))
    return ticks.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def distinct_symbols(ticks: DataFrame) -> DataFrame:
    return ticks.select("symbol").distinct().orderBy("symbol")


def deduplicate(df: DataFrame, keys: tuple = ("symbol", "trade_id"), order: tuple = ("ts",), keep: str = "first") -> DataFrame:
    """One row per key: the first or last in the given order. Only one row per key and task is shuffled."""
    cols = df.columns
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in cols if c not in keys]
    got = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r"))
    return got.select(*keys, "_r.*").select(*cols)


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def missing_symbols(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.join(present.select("symbol").distinct(), "symbol", "left_anti")


def coverage(expected: DataFrame, present: DataFrame) -> DataFrame:
    """(expected, present, missing, coverage_pct) as one row."""
    p = present.select("symbol").distinct().withColumn("_p", F.lit(1))
    e = expected.select("symbol").distinct().join(p, "symbol", "left")
    n, k = F.count("*"), F.count("_p")
    return e.agg(n.alias("expected"), k.alias("present"), (n - k).alias("missing"), F.round(F.try_divide(k * F.lit(100.0), n), 6).alias("coverage_pct"))


def where(df: DataFrame, predicate: str | Column) -> DataFrame:
    return df.where(predicate)


def query(df: DataFrame, sql: str, name: str = "data") -> DataFrame:
    """Arbitrary SQL over df as a temporary view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql)


def train_test(df: DataFrame, test_share: float = 0.2, key: str = "symbol") -> DataFrame:
    """Adds split: 'train' for the first int(n * (1 - test_share)) rows of each key by time, else 'test'."""
    from ..plans.prefix import row_numbers

    d = row_numbers(df, "_rn", key)
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    d = d.join(n, key)
    return d.withColumn("split", F.when(F.col("_rn") <= F.floor(F.col("_n") * F.lit(1 - test_share)), "train").otherwise("test")).drop("_rn", "_n")


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a null in the named columns, or in any."""
    return df.na.drop(subset=subset)


def raw_trades(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Raw trades (id, price, qty, time in ms, isBuyerMaker) as ticks, so every operator on ticks takes them."""
    return df.select(
        F.col(symbol).alias("symbol"), F.col("id").cast("long").alias("trade_id"), F.timestamp_millis("time").alias("ts"), F.col("price").cast("decimal(18,8)").alias("price"),
        F.col("qty").cast("decimal(18,8)").alias("quantity"), F.col("isBuyerMaker").alias("is_buyer_maker"), F.to_date(F.timestamp_millis("time")).alias("date"),
    )
