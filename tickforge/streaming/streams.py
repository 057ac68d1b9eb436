"""Structured Streaming forms: windows, de-duplication, stateful bars, current books, latest rows, alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.bars import Sampler, _units, fed_ticks
from ..schema import ticks_from_events
from ..sources.files import shared_path

LATE = "10 seconds"


def stream_ticks(spark: SparkSession, sf_dir: str, name: str = "events.parquet", files_per_batch: int = 1) -> DataFrame:
    """Ticks of the event files of a folder as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files_per_batch).parquet(sf_dir)
    return ticks_from_events(raw)


def with_watermark(ticks: DataFrame, late: str = LATE) -> DataFrame:
    return ticks.withWatermark("ts", late)


def tumbling(ticks: DataFrame, metrics: list, seconds: int = 60, late: str = LATE) -> DataFrame:
    """The batch metrics per closed event-time window."""
    d = with_watermark(ticks, late).groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "symbol").agg(*metrics)
    return d.withColumn("bucket", F.col("w.start")).drop("w")


def sliding(ticks: DataFrame, metrics: list, seconds: int, slide: int, late: str = LATE) -> DataFrame:
    d = with_watermark(ticks, late).groupBy(F.window("ts", f"{seconds} seconds", f"{slide} seconds").alias("w"), "symbol").agg(*metrics)
    return d.withColumn("bucket", F.col("w.start")).drop("w")


def sessions(ticks: DataFrame, gap: str = "1 hour", late: str = LATE) -> DataFrame:
    d = with_watermark(ticks, late).groupBy(F.session_window("ts", gap).alias("w"), "symbol").agg(F.count("*").alias("n"))
    return d.select("symbol", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def deduplicated(ticks: DataFrame, late: str = "1 hour") -> DataFrame:
    return with_watermark(ticks, late).dropDuplicatesWithinWatermark(["symbol", "trade_id"])


def price_alerts(ticks: DataFrame, above: float) -> DataFrame:
    return ticks.where(F.col("price") > above).select("symbol", "trade_id", "ts", "price")


def reset_bars(ticks: DataFrame, threshold: float) -> DataFrame:
    """Bars that close on the crossing tick, from a stream. State is the open bar; each batch is sorted per symbol.

    Closing is decided on dollars in whole units (Sampler), so it doesn't depend on how many ticks came before in a
    batch. Ticks without a price or quantity are left out.
    """
    out = "symbol string, bar_id long, timestamp long, open double, high double, low double, close double, volume double, dollar_volume double, tick_count long"
    names = [x.split()[0] for x in out.split(", ")]
    digits = _units(threshold)[0]

    def advance(key, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        s = Sampler(threshold, digits)
        if held.exists:
            s.resume(tuple(held.get), [])
        pdf = pd.concat(list(batches)).sort_values(["ts", "trade_id"])
        rows = s.feed(*(pdf[c].to_numpy() for c in ("ts", "price", "quantity", "worth")))
        held.update(s.state())
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in Sampler.ROW.split(", ")]).assign(symbol=key[0])[names]

    d = fed_ticks(ticks, digits).groupBy("symbol").applyInPandasWithState(advance, out, Sampler.STATE, "append", GroupStateTimeout.NoTimeout)
    return d.withColumn("timestamp", F.timestamp_micros("timestamp"))


def run_to_files(stream: DataFrame, label: str) -> DataFrame:
    """Process what is there, append closed results to files in the shared folder, and read them."""
    spark = stream.sparkSession
    path = shared_path(spark, label)
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_path(spark, label + "-state")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], label: str, mode: str = "append") -> None:
    """Side outputs: handle(batch, id) for every micro-batch; a repeated id means a repeated batch."""
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", shared_path(stream.sparkSession, label)).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def run_updates(stream: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Open-window results: every update of a key goes to files by batch, and the newest one per key is read."""
    spark = stream.sparkSession
    path = shared_path(spark, label)
    run_batches(stream, lambda b, i: b.withColumn("_batch", F.lit(i).cast("long")).write.mode("overwrite").parquet(f"{path}/batch={i}"), label + "-state", "update")
    schema = stream.withColumn("_batch", F.lit(0).cast("long")).schema
    d = spark.read.schema(schema).parquet(f"{path}/*")
    rest = [c for c in stream.columns if c not in keys]
    return d.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, "_r.*")


def latest_per_symbol(ticks: DataFrame) -> DataFrame:
    """The newest trade and totals per symbol so far (update mode)."""
    at = F.struct("ts", "trade_id")
    return ticks.groupBy("symbol").agg(F.count("*").alias("trades"), F.max_by("price", at).alias("last_price"), F.max("ts").alias("last_time"))


def current_books(books: DataFrame) -> DataFrame:
    """The newest order book per symbol (update mode)."""
    return books.groupBy("symbol").agg(F.max_by(F.struct("ts", "bids", "asks"), "ts").alias("b")).select("symbol", "b.*")


def last_n(ticks: DataFrame, n: int, label: str, keys: tuple = ("symbol",), seconds: int | None = None) -> DataFrame:
    """Buffers of the newest n rows per key, kept up by batch: each batch and the buffers before it make new ones.

    Only n rows a key are held, and a batch is cut to n rows a key before it meets them; with ``seconds``, rows older
    than that before the newest of their key go too. Every version is written whole; a repeated batch rewrites its own.
    """
    spark = ticks.sparkSession
    path, schema = shared_path(spark, label), ticks.schema
    w = W.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("trade_id"))
    newest = lambda d: d.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")
    held = [None]

    def keep(batch: DataFrame, i: int) -> None:
        d = newest(batch)
        before = [v for v in held if v is not None and v != i]
        if before:
            d = newest(d.unionByName(spark.read.schema(schema).parquet(f"{path}/v={before[-1]}")))
        if seconds is not None:
            top = F.max("ts").over(W.partitionBy(*keys))
            d = d.withColumn("_t", top).where(F.unix_micros("_t") - F.unix_micros("ts") <= seconds * 1_000_000).drop("_t")
        d.write.mode("overwrite").parquet(f"{path}/v={i}")
        held[:] = [*before, i]

    run_batches(ticks, keep, label + "-state")
    return spark.read.schema(schema).parquet(f"{path}/v={held[-1]}") if held[-1] is not None else spark.createDataFrame([], schema)


def monitor(ticks: DataFrame) -> DataFrame:
    """Per symbol so far (update mode): trades by side, imbalance, volumes, price and its deviation, vwap, delta, span."""
    p, q = F.col("price").cast("double"), F.col("quantity").cast("double")
    sell = F.col("is_buyer_maker")
    total = lambda c: F.coalesce(F.sum(F.when(c, q)), F.lit(0.0))
    n = F.count("*")
    return ticks.groupBy("symbol").agg(
        F.count_if(~sell).alias("buys"), F.count_if(sell).alias("sells"), F.round((F.count_if(~sell) - F.count_if(sell)) / n, 6).alias("imbalance"), total(~sell).alias("buy_volume"), total(sell).alias("sell_volume"),
        F.round(F.avg(p), 6).alias("mean_price"), F.round(F.stddev_pop(p), 6).alias("price_std"), F.round(F.sum(p * q) / F.sum(q), 6).alias("vwap"), F.round(total(~sell) - total(sell), 6).alias("delta"),
        F.round((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(1e6), 3).alias("uptime_seconds"),
    )
