"""Operators with state of their own on a stream: bars, buffers of the newest rows; and stream tables that resume.

State lives in Spark's state store and so in the checkpoint: a stream that is started again with its checkpoint goes on
where it stopped. The store must be RocksDB (use_rocksdb), as these operators keep several states a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.bars import Sampler, _units, bar_times, fed_ticks

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class _Bars(StatefulProcessor):
    """The open bar in a value state, the sizes of recent bars in a list state, a timer for a bar that goes stale."""

    names = ["symbol", *(x.split()[0] for x in Sampler.ROW.split(", ")), "stale"]

    def __init__(self, threshold: float, digits: int, lookback: int | None, stale_seconds: float | None):
        self.made, self.stale_ms = (threshold, digits, lookback, 1.0 if lookback else 0.0), None if stale_seconds is None else int(stale_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bar, self.sizes = handle.getValueState("bar", Sampler.STATE + ", timer long"), handle.getListState("sizes", "size double")

    def _load(self) -> tuple[Sampler, int | None]:
        s, timer = Sampler(*self.made), None
        if self.bar.exists():
            *state, timer = tuple(self.bar.get())
            s.resume(tuple(state), [x[0] for x in self.sizes.get()] if self.sizes.exists() else [])
        return s, timer

    def _save(self, s: Sampler, timer: int | None) -> None:
        due = (s.last // 1000 + 1 + self.stale_ms) if self.stale_ms is not None and s.n else None
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.bar.update((*s.state(), due))
        if s.sizes:
            self.sizes.put([(x,) for x in s.sizes])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s, timer = self._load()
        pdf = pd.concat(list(rows)).sort_values(["ts", "trade_id"])
        out = s.feed(*(pdf[c].to_numpy() for c in ("ts", "price", "quantity", "worth")))
        self._save(s, timer)
        yield pd.DataFrame([(key[0], *row, False) for row in out], columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s, timer = self._load()
        out = []
        if s.n and timer is not None and timer <= expiredTimerInfo.getExpiryTimeInMs():
            out.append((key[0], *s.close(), True))
            self._save(s, None)
        yield pd.DataFrame(out, columns=self.names)

    def close(self) -> None:
        pass


def bars(ticks: DataFrame, threshold: float, lookback: int | None = None, stale_seconds: float | None = None, late: str = "10 seconds") -> DataFrame:
    """Bars that close on the crossing tick, from a stream; with a lookback the threshold adapts as in adaptive_bars.

    They are the bars of the batch operators, without the unfinished one, however the ticks come in micro-batches, as
    long as no tick is older than those of the batches before. With stale_seconds, a bar whose last tick the watermark
    has left so far behind closes as it is, and is marked stale. A micro-batch's ticks of one symbol are sorted in memory.
    Ticks without a price or quantity are left out.
    """
    digits = _units(threshold)[0]
    d = fed_ticks(ticks, digits).withColumn("event_time", F.timestamp_micros("ts")).withWatermark("event_time", late)
    out = d.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=_Bars(threshold, digits, lookback, stale_seconds), outputStructType="symbol string, " + Sampler.ROW + ", stale boolean", outputMode="append", timeMode="eventtime",
    )
    return bar_times(out)


class _Newest(StatefulProcessor):
    """The newest n rows of a key in a list state, none older than span microseconds before the newest."""

    def __init__(self, n: int, span: int | None):
        self.n, self.span = n, span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", "ts long, id long, row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in self.rows.get()] if self.rows.exists() else []
        for pdf in rows:
            held += list(zip(pdf["ts"].tolist(), pdf["id"].tolist(), pdf["row"].tolist()))
            held = sorted(held, reverse=True)[: self.n]
        if self.span is not None:
            held = [x for x in held if held[0][0] - x[0] <= self.span]
        self.rows.put(held)
        yield pd.DataFrame({"symbol": [key[0]], "rows": [[x[2] for x in held]]})

    def close(self) -> None:
        pass


def newest_rows(ticks: DataFrame, n: int, seconds: float | None = None) -> DataFrame:
    """(symbol, rows): the newest n rows of each symbol so far as JSON, whenever one comes in (update mode).

    At most n rows a symbol are in the state; with ``seconds``, rows older than that before their symbol's newest go as
    well. opened() turns the result into rows again.
    """
    d = ticks.select("symbol", F.unix_micros("ts").alias("ts"), F.col("trade_id").alias("id"), F.to_json(F.struct(*ticks.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("row"))
    span = None if seconds is None else int(seconds * 1_000_000)
    return d.groupBy("symbol").transformWithStateInPandas(statefulProcessor=_Newest(n, span), outputStructType="symbol string, rows array<string>", outputMode="update", timeMode="none")


def opened(buffers: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of newest_rows, one each."""
    return buffers.select(F.explode("rows").alias("r")).select(F.from_json("r", schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("r")).select("r.*")


class _Enough(Exception):
    """A bounded run has handled its batches."""


class StreamTable:
    """What a stream gives, under one path together with its checkpoint.

    Each micro-batch is written to a folder named after its id. A batch that was written but not committed comes again
    under its id and takes its own place; it isn't skipped, as the state behind it must be made again too. So every row
    is there once, however often the stream stops and starts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def run(self, stream: DataFrame, mode: str = "append", max_batches: int | None = None, before_commit: Callable[[int], None] | None = None) -> int:
        """Take up the stream where the last run has stopped, until all that is there is done or max_batches are; their
        number comes back. before_commit(id) is called when a batch is written and not yet committed."""
        done = []

        def keep(batch: DataFrame, i: int) -> None:
            if max_batches is not None and len(done) >= max_batches:
                raise _Enough
            batch.withColumn("_batch", F.lit(i).cast("long")).write.mode("overwrite").parquet(f"{self.path}/data/batch={i}")
            if before_commit:
                before_commit(i)
            done.append(i)

        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{self.path}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except StreamingQueryException:
            if max_batches is None or len(done) < max_batches:
                raise
        return len(done)

    def rows(self, schema: T.StructType) -> DataFrame:
        """All rows so far, with _batch; none before the first run."""
        schema = T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/data/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def newest(self, schema: T.StructType, keys: list[str]) -> DataFrame:
        """The newest row of each key, of a stream in update mode."""
        rest = [f.name for f in schema.fields if f.name not in keys]
        return self.rows(schema).groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, "_r.*")


def books(depth: DataFrame) -> DataFrame:
    """The current book of each symbol (update mode): that of the newest message, the number of messages and levels so far."""
    at = F.struct("ts", "last_update_id")
    d = depth.groupBy("symbol").agg(F.max_by(F.struct("ts", "last_update_id", "bids", "asks"), at).alias("b"), F.count("*").alias("updates"), F.sum(F.size("bids") + F.size("asks")).cast("long").alias("levels_seen"))
    return d.select("symbol", "b.*", "updates", "levels_seen", F.size("b.bids").alias("bid_levels"), F.size("b.asks").alias("ask_levels"))


def side_outputs(stream: DataFrame, kind: str, handlers: dict[str, Callable[[DataFrame, int], None]], table: StreamTable) -> int:
    """Call the handler of each kind of message with the rows of every micro-batch that are of it, in the order of the
    dict; kinds without a handler are left alone. A batch comes again after a stop in its middle, so handlers should write
    by batch id, as StreamTable does."""
    def handle(batch: DataFrame, i: int) -> None:
        batch.persist()
        try:
            for k, f in handlers.items():
                f(batch.where(F.col(kind) == k), i)
        finally:
            batch.unpersist()
        done.append(i)

    done: list[int] = []
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{table.path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return len(done)


def in_time_files(df: DataFrame, path: str, parts: int, by: str = "ts", files: int = 2) -> list[tuple]:
    """Write df under path as ``parts`` ranges of ``by``, oldest first, ``files`` files each, as a stream finds them over
    time; read them with maxFilesPerTrigger = files. The bounds come back."""
    us = F.unix_micros(by)
    cuts = df.agg(F.percentile_approx(us, [k / parts for k in range(1, parts)])).first()[0] if parts > 1 else None
    edges = [None, *sorted(set(cuts or [])), None]
    for a, z in zip(edges, edges[1:]):
        lower, upper = F.lit(True) if a is None else us > a, F.lit(True) if z is None else us <= z
        df.where(lower & upper).repartition(files).write.mode("append").parquet(path)
    return list(zip(edges, edges[1:]))


def stream_of(spark: SparkSession, path: str, schema: T.StructType, files: int = 2) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
