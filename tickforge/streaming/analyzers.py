"""User-defined analyzers: column lists evaluated in one aggregation, in batch or on a stream."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Analyzer:
    """Subclass and return aggregate columns; they are prefixed with the analyzer's name."""

    name = "analyzer"
    enabled = True

    def columns(self) -> list[Column]:
        raise NotImplementedError


class SimpleCounter(Analyzer):
    name = "counter"

    def columns(self) -> list[Column]:
        buys, sells = F.count_if(~F.col("is_buyer_maker")), F.count_if(F.col("is_buyer_maker"))
        return [F.count("*").alias("trades"), F.sum("quantity").cast("double").alias("volume"), buys.alias("buys"), sells.alias("sells"), F.round(F.try_divide(buys.cast("double"), sells.cast("double")), 6).alias("ratio")]


class FromColumns(Analyzer):
    def __init__(self, name: str, make: Callable[[], list[Column]]):
        self.name, self._make = name, make

    def columns(self) -> list[Column]:
        return self._make()


class Registry:
    def __init__(self):
        self._by_name: dict[str, Analyzer] = {}

    def register(self, a: Analyzer) -> None:
        if a.name in self._by_name:
            raise ValueError(f"an analyzer named {a.name} is registered")
        self._by_name[a.name] = a

    def unregister(self, name: str) -> None:
        self._by_name.pop(name)

    def enable(self, name: str, on: bool = True) -> None:
        self._by_name[name].enabled = on

    def run(self, ticks: DataFrame, seconds: int = 60) -> DataFrame:
        """All enabled analyzers in one aggregation per (symbol, window): a struct column each."""
        used = [a for a in self._by_name.values() if a.enabled]
        if not used:
            raise ValueError("no analyzer is enabled")
        cols = [c.alias(f"_{i}_{j}") for i, a in enumerate(used) for j, c in enumerate(a.columns())]
        names = {(i, j): ticks.groupBy().agg(c).columns[0] for i, a in enumerate(used) for j, c in enumerate(a.columns())}
        d = ticks.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "symbol").agg(*cols)
        structs = [F.struct(*[F.col(f"_{i}_{j}").alias(names[i, j]) for j in range(len(a.columns()))]).alias(a.name) for i, a in enumerate(used)]
        return d.select("symbol", F.col("w.start").alias("bucket"), *structs)


def on_agg_trades(registry: Registry, messages: DataFrame, symbol: Column, seconds: int = 60, column: str = "value") -> DataFrame:
    """The registry's analyzers over raw aggregated trades: the messages become ticks, which all analyzers take."""
    from ..sources.raw import agg_trades

    return registry.run(agg_trades(messages, symbol, column), seconds)


class TradeAnalyzer:
    """Subclass for what aggregate columns can't say: state that each trade of a window changes, in order.

    reset() begins a window; on_trade(trade), or on_trades(trades) for a data frame of them at once, takes trades with
    their symbol, ts (microseconds), trade_id, price, quantity and is_buyer_maker; on_window_close() gives a row of
    ``schema``. All state lies in the instance's attributes, which must be small and picklable: on a stream they are kept
    in the state store between micro-batches.
    """

    schema = "n long"

    def reset(self) -> None:
        raise NotImplementedError

    def on_trade(self, trade) -> None:
        raise NotImplementedError

    def on_trades(self, trades: pd.DataFrame) -> None:
        for t in trades.itertuples(index=False):
            self.on_trade(t)

    def on_window_close(self) -> tuple:
        raise NotImplementedError


def _trades(ticks: DataFrame, seconds: float) -> DataFrame:
    us = F.unix_micros("ts")
    width = F.lit(int(seconds * 1_000_000))
    p, q = F.col("price").cast("double"), F.col("quantity").cast("double")
    return ticks.where(F.col("ts").isNotNull()).select("symbol", (F.floor(us / width) * width).alias("bucket"), us.alias("ts"), "trade_id", p.alias("price"), q.alias("quantity"), "is_buyer_maker")


def _names(analyzer: TradeAnalyzer) -> list[str]:
    return ["symbol", "bucket", *(x.split()[0] for x in analyzer.schema.split(", "))]


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.timestamp_micros("bucket"))


def replay_trades(ticks: DataFrame, make: Callable[[], TradeAnalyzer], seconds: float = 60) -> DataFrame:
    """One row per symbol and window of ``seconds`` from an analyzer that saw the window's trades in order.

    Windows are dealt to tasks and sorted there; their trades pass batch by batch, so a task holds one analyzer's state
    and one batch. Ticks without a time are left out.
    """
    d = _trades(ticks, seconds).repartition("symbol", "bucket").sortWithinPartitions("symbol", "bucket", "ts", "trade_id")
    names = _names(make())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, analyzer = None, make()
        for pdf in batches:
            out = []
            for (symbol, bucket), trades in pdf.groupby(["symbol", "bucket"], sort=False, dropna=False):
                symbol = None if pd.isna(symbol) else symbol
                if (symbol, bucket) != key:
                    if key is not None:
                        out.append((*key, *analyzer.on_window_close()))
                    key = (symbol, bucket)
                    analyzer.reset()
                analyzer.on_trades(trades)
            if out:
                yield pd.DataFrame(out, columns=names)
        if key is not None:
            yield pd.DataFrame([(*key, *analyzer.on_window_close())], columns=names)

    return _timed(d.mapInPandas(run, f"symbol string, bucket long, {make().schema}"))


class _Windows(StatefulProcessor):
    """An analyzer's attributes in a value state for each (symbol, window), and a timer at the window's end."""

    def __init__(self, make: Callable[[], TradeAnalyzer], width_ms: int):
        self.make, self.width_ms = make, width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("analyzer", "attributes binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        analyzer = self.make()
        if self.held.exists():
            analyzer.__dict__.update(pickle.loads(self.held.get()[0]))
        else:
            analyzer.reset()
            self.handle.registerTimer(key[1] // 1000 + self.width_ms)
        analyzer.on_trades(pd.concat(list(rows)).sort_values(["ts", "trade_id"]))
        self.held.update((pickle.dumps(analyzer.__dict__),))
        yield pd.DataFrame([], columns=_names(analyzer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        analyzer, out = self.make(), []
        if self.held.exists():
            analyzer.__dict__.update(pickle.loads(self.held.get()[0]))
            out.append((*key, *analyzer.on_window_close()))
            self.held.clear()
        yield pd.DataFrame(out, columns=_names(analyzer))

    def close(self) -> None:
        pass


def stream_trades(ticks: DataFrame, make: Callable[[], TradeAnalyzer], seconds: float = 60, late: str = "10 seconds") -> DataFrame:
    """replay_trades on a stream: a window's row comes when the watermark has passed its end.

    Trades of a window must come in order from batch to batch; within a micro-batch they are sorted. Needs the RocksDB
    state store (stateful.use_rocksdb).
    """
    d = _trades(ticks, seconds).withColumn("event_time", F.timestamp_micros("ts")).withWatermark("event_time", late)
    out = d.groupBy("symbol", "bucket").transformWithStateInPandas(statefulProcessor=_Windows(make, int(seconds * 1000)), outputStructType=f"symbol string, bucket long, {make().schema}", outputMode="append", timeMode="eventtime")
    return _timed(out)


class Streaks(TradeAnalyzer):
    """The longest streak of trades on one side in a window, its side, and the number of changes of side."""

    schema = "trades long, longest long, longest_is_sell boolean, changes long"

    def reset(self) -> None:
        self.n, self.side, self.run, self.longest, self.longest_side, self.changes = 0, None, 0, 0, None, 0

    def on_trade(self, trade) -> None:
        side = bool(trade.is_buyer_maker)
        self.n += 1
        self.changes += self.side is not None and side != self.side
        self.run = self.run + 1 if side == self.side else 1
        self.side = side
        if self.run > self.longest:
            self.longest, self.longest_side = self.run, side

    def on_window_close(self) -> tuple:
        return self.n, self.longest, self.longest_side, self.changes
