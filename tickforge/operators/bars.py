"""Event-driven bars. Three semantics, each with its own name.

floor bars (dollar_bars, volume_bars, tick_bars): bar_id = running measure div threshold; the crossing tick opens the
next bar, ids may skip, the tail stays. reset_bars: the crossing tick closes the bar, overshoot is dropped, and the
unfinished tail is kept or dropped. adaptive_bars: reset bars whose threshold follows the sizes of recent bars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import dbl, ratio
from ..plans.chains import chained
from ..plans.prefix import running_total


def validate_ticks(ticks: DataFrame) -> DataFrame:
    """One row of counts: records, nulls, prices that aren't positive, negative quantities, and whether all is well."""
    c = ticks.agg(
        F.count("*").alias("records"), F.count_if(F.col("price").isNull()).alias("null_price"), F.count_if(F.col("quantity").isNull()).alias("null_quantity"),
        F.count_if(F.col("price") <= 0).alias("bad_price"), F.count_if(F.col("quantity") < 0).alias("bad_quantity"),
    )
    return c.withColumn("valid", (F.col("records") > 0) & (F.col("null_price") + F.col("null_quantity") + F.col("bad_price") + F.col("bad_quantity") == 0))


def require_valid(ticks: DataFrame) -> DataFrame:
    missing = [c for c in ("symbol", "ts", "price", "quantity") if c not in ticks.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    row = validate_ticks(ticks).first()
    if not row["valid"]:
        raise ValueError(f"ticks are not valid: {row.asDict()}")
    return ticks


def with_threshold(ticks: DataFrame, threshold) -> DataFrame:
    """Adds threshold: a number for all symbols, or a table (symbol, threshold) with an optional 'default' row."""
    if not isinstance(threshold, DataFrame):
        return ticks.withColumn("threshold", F.lit(threshold).cast("decimal(38,16)") if not isinstance(threshold, int) else F.lit(threshold).cast("decimal(38,0)"))
    default = threshold.where("symbol = 'default'").select(F.col("threshold").alias("d")).first()
    own = threshold.where("symbol <> 'default'").select(F.col("symbol").alias("_s"), F.col("threshold").alias("_t"))
    out = ticks.join(own, F.col("symbol") == F.col("_s"), "left").withColumn("threshold", F.coalesce("_t", F.lit(default["d"] if default else None)))
    return out.drop("_s", "_t")


def floor_bars(ticks: DataFrame, measure: Column, threshold, unit: str = "day") -> DataFrame:
    """Ticks with bar_id; exact, as the measure is summed in integers or decimals and divided by ``div``."""
    d = running_total(with_threshold(ticks, threshold), measure, "_cum", unit=unit)
    return d.withColumn("bar_id", F.expr("cast(_cum div threshold as bigint)")).drop("_cum", "threshold")


def bars_of(ticks: DataFrame, *more: Column) -> DataFrame:
    """One row per (symbol, bar_id): prices, sizes, counts, side volumes, vwap and durations.

    Rates divide by the duration, and by 1 where it is 0. more: further aggregates.
    """
    at = F.struct("ts", "trade_id")
    p, q = F.col("price"), F.col("quantity")
    b = ticks.groupBy("symbol", "bar_id").agg(
        F.min("ts").alias("timestamp"), F.max("ts").alias("timestamp_close"), F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("quantity").alias("volume"), F.sum(p * q).alias("dollar_volume"), F.count("*").alias("tick_count"), dbl(F.stddev_samp(p.cast("double"))).alias("price_std"),
        F.coalesce(F.sum(F.when(~F.col("is_buyer_maker"), q)), F.lit(0)).alias("buy_volume"), F.coalesce(F.sum(F.when(F.col("is_buyer_maker"), q)), F.lit(0)).alias("sell_volume"), *more,
    )
    seconds = (F.unix_micros("timestamp_close") - F.unix_micros("timestamp")) / F.lit(1e6)
    span = F.when(seconds == 0, F.lit(1.0)).otherwise(seconds)
    prev = F.lag("timestamp").over(W.partitionBy("symbol").orderBy("bar_id"))
    return b.withColumns({
        "price_change": F.col("close") - F.col("open"), "vwap": dbl(ratio(F.col("dollar_volume"), F.col("volume"))), "duration_seconds": dbl(seconds), "ticks_per_second": dbl(F.col("tick_count") / span),
        "dollar_volume_per_second": dbl(F.col("dollar_volume").cast("double") / span, 4), "time_since_last_bar": dbl((F.unix_micros("timestamp") - F.unix_micros(prev)) / F.lit(1e6)),
    })


def dollar_bars(ticks: DataFrame, threshold, unit: str = "day") -> DataFrame:
    return bars_of(floor_bars(ticks, F.col("price") * F.col("quantity"), threshold, unit))


def volume_bars(ticks: DataFrame, threshold, unit: str = "day") -> DataFrame:
    return bars_of(floor_bars(ticks, F.col("quantity"), threshold, unit))


def tick_bars(ticks: DataFrame, n: int, unit: str = "day") -> DataFrame:
    """Bars of n ticks: the first n - 1 ticks are bar 0, as the crossing tick opens the next bar."""
    return bars_of(floor_bars(ticks, F.lit(1).cast("long"), n, unit))


def auto_threshold(ticks: DataFrame, ticks_per_bar: int) -> DataFrame:
    d = (F.col("price") * F.col("quantity")).cast("double")
    return ticks.groupBy("symbol").agg(dbl(F.avg(d) * ticks_per_bar).alias("threshold"))


def optimal_threshold(ticks: DataFrame, target_bars: int | None = None, target_bars_per_day: float | None = None) -> DataFrame:
    """Total dollar volume over the wanted number of bars; exactly one target must be given."""
    if (target_bars is None) == (target_bars_per_day is None):
        raise ValueError("give target_bars or target_bars_per_day")
    total = F.sum(F.col("price") * F.col("quantity")).cast("double")
    days = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(8.64e10)
    if target_bars is not None:
        return ticks.groupBy("symbol").agg(dbl(total / F.lit(target_bars)).alias("threshold"))
    d = ticks.groupBy("symbol").agg(total.alias("_t"), days.alias("_d"))
    short = F.raise_error(F.lit("the ticks span less than 0.01 days")).cast("double")
    return d.select("symbol", dbl(F.when(F.col("_d") < 0.01, short).otherwise(F.col("_t") / F.floor(F.lit(target_bars_per_day) * F.col("_d")))).alias("threshold"))


def adapted(sizes: list[float]) -> float:
    """The next threshold: the mean of the last bars' sizes, weighed exponentially, the newest most."""
    w = np.exp(np.linspace(-1, 0, len(sizes)))
    return float((w * sizes).sum() / w.sum())


#: Bars that the threshold needs before it adapts.
SETTLED = 5
#: Ticks over which a Sampler's running sums go before they begin anew.
SLICE = 4096


class Sampler:
    """The open bar of one symbol, fed with ticks in order: running sums only, whatever its number of ticks.

    Closing is decided on dollars in whole units (10**-digits), so it doesn't depend on how ticks come in batches. With a
    lookback the threshold follows the sizes of the last bars, which ``sizes`` holds. Rates divide by ``least`` seconds
    at least, and by 1 where a bar takes no time.
    """

    STATE = "id long, acc double, before long, n long, first long, last long, open double, close_ double, high double, low double, volume double, dollars double, mean double, m2 double, limit double"
    ROW = "bar_id long, timestamp long, timestamp_close long, open double, high double, low double, close double, volume double, dollar_volume double, tick_count long, vwap double, price_std double, price_change double, duration_seconds double, ticks_per_second double, dollar_volume_per_second double, time_since_last_bar double, threshold_used double"

    def __init__(self, threshold: float, digits: int, lookback: int | None = None, least: float = 0.0):
        self.digits, self.lookback, self.least, self.sizes = digits, lookback, least, []
        self.id, self.acc, self.before, self.limit = 0, 0.0, None, float(threshold)
        self._clear()

    def _clear(self) -> None:
        self.n, self.first, self.last, self.open, self.close_, self.high, self.low = 0, None, None, 0.0, 0.0, -np.inf, np.inf
        self.volume = self.dollars = self.mean = self.m2 = self.acc = 0.0

    def state(self) -> tuple:
        return tuple(getattr(self, x.split()[0]) for x in self.STATE.split(", "))

    def resume(self, state: tuple, sizes: list[float]) -> None:
        for x, v in zip(self.STATE.split(", "), state):
            setattr(self, x.split()[0], v)
        self.sizes = sizes

    def _add(self, ts: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
        k, mean = len(p), float(p.mean())
        if not self.n:
            self.first, self.open = int(ts[0]), float(p[0])
        # Means and squared deviations of two parts combine.
        gap = mean - self.mean
        self.m2 += float(((p - mean) ** 2).sum()) + gap * gap * self.n * k / (self.n + k)
        self.mean += gap * k / (self.n + k)
        self.n += k
        self.last, self.close_, self.high, self.low = int(ts[-1]), float(p[-1]), max(self.high, float(p.max())), min(self.low, float(p.min()))
        self.volume, self.dollars = self.volume + float(q.sum()), self.dollars + float((p * q).sum())

    def close(self) -> tuple:
        """The open bar as a row of ROW; the next one begins."""
        seconds = (self.last - self.first) / 1e6
        span = max(seconds, self.least) or 1.0
        since = None if self.before is None else (self.first - self.before) / 1e6
        row = (
            self.id, self.first, self.last, self.open, self.high, self.low, self.close_, self.volume, self.dollars, self.n, self.dollars / self.volume if self.volume else None,
            float(np.sqrt(self.m2 / (self.n - 1))) if self.n > 1 else None, self.close_ - self.open, seconds, self.n / span, self.dollars / span, since, self.limit,
        )
        if self.lookback:
            self.sizes = [*self.sizes, self.dollars][-self.lookback :]
            if len(self.sizes) >= SETTLED:
                self.limit = adapted(self.sizes)
        self.before, self.id = self.first, self.id + 1
        self._clear()
        return row

    def feed(self, ts: np.ndarray, p: np.ndarray, q: np.ndarray, worth: np.ndarray) -> list[tuple]:
        """The bars that these ticks close; ts in microseconds, worth in units. Sums begin anew after SLICE ticks, so
        that they stay whole numbers which a double holds, however many ticks there are."""
        out = []
        for k in range(0, len(p), SLICE):
            out += self._feed(*(x[k : k + SLICE] for x in (ts, p, q, worth)))
        return out

    def _feed(self, ts: np.ndarray, p: np.ndarray, q: np.ndarray, worth: np.ndarray) -> list[tuple]:
        sums, i, base, out = np.cumsum(worth), 0, 0.0, []
        while i < len(p):
            # One step a bar: the crossing tick is found in the running sums.
            j = int(np.searchsorted(sums, base + round(self.limit * 10**self.digits) - self.acc, "left"))
            if j >= len(p):
                self._add(ts[i:], p[i:], q[i:])
                self.acc += float(sums[-1] - base)
                break
            self._add(ts[i : j + 1], p[i : j + 1], q[i : j + 1])
            out.append(self.close())
            i, base = j + 1, sums[j]
        return out


def fed_ticks(ticks: DataFrame, digits: int) -> DataFrame:
    """(symbol, ts, trade_id, price, quantity, worth) as a Sampler takes them; ticks without price or quantity are left out."""
    worth = F.round(F.col("price") * F.col("quantity") * F.lit(10**digits).cast("decimal(9,0)")).cast("double")
    p, q = F.col("price").cast("double"), F.col("quantity").cast("double")
    return ticks.where(F.col("price").isNotNull() & F.col("quantity").isNotNull()).select("symbol", F.unix_micros("ts").alias("ts"), "trade_id", p.alias("price"), q.alias("quantity"), worth.alias("worth"))


def adaptive_bars(ticks: DataFrame, initial: float, lookback: int = 20) -> DataFrame:
    """Reset bars without tail whose threshold, once SETTLED bars are remembered, is the exponentially weighted mean size
    of the last ``lookback`` ones; with a shorter lookback it never changes. Rates divide by one second at least.

    Each threshold depends on all bars before it, so a symbol is sequential by definition: a sorted partition passes
    through one function batch by batch, which holds the open bar's sums and the recent sizes only. Symbols are parallel.
    Ticks without a price or quantity are left out.
    """
    digits = _units(initial)[0]
    d = fed_ticks(ticks, digits).repartition("symbol").sortWithinPartitions("symbol", "ts", "trade_id")
    names = ["symbol", *(x.split()[0] for x in Sampler.ROW.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, bar = object(), None
        for pdf in batches:
            out = []
            for symbol, g in pdf.groupby("symbol", sort=False, dropna=False):
                symbol = None if pd.isna(symbol) else symbol
                if symbol != name:
                    name, bar = symbol, Sampler(initial, digits, lookback, least=1.0)
                out += [(name, *row) for row in bar.feed(*(g[c].to_numpy() for c in ("ts", "price", "quantity", "worth")))]
            if out:
                yield pd.DataFrame(out, columns=names)

    return bar_times(d.mapInPandas(run, "symbol string, " + Sampler.ROW))


def bar_times(bars: DataFrame) -> DataFrame:
    """Rows of a Sampler with its microseconds as timestamps."""
    return bars.withColumns({c: F.timestamp_micros(c) for c in ("timestamp", "timestamp_close")})


#: Bars that a block is aimed at: the map of a block has a piece for each of the ticks of one bar at most.
BARS_PER_BLOCK = 64


def _closings(worth: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, after): running sums of ticks, and for a bar opened at each tick (or just after the last) the tick after
    the one that closes it, or a number beyond the end."""
    sums = np.concatenate([[0], np.cumsum(worth)])
    after = np.searchsorted(sums[1:], sums + limit, "left") + 1
    after[after > len(worth)] = len(worth) + 1
    return sums, after


def block_map(worth: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """Pieces (least, closed, open) of what a block does to the sum of the bar that it finds open: from a sum of ``least``
    on, it closes so many bars and leaves one with the sum ``open``. Below all pieces nothing closes."""
    n = len(worth)
    sums, after = _closings(worth, limit)
    # The first close is at one of the ticks up to the one that closes an empty bar.
    closes = np.arange(1, min(int(after[0]), n) + 1)
    closes = closes[sums[closes] > sums[closes - 1]]
    if not len(closes):
        return []
    at, closed = closes.copy(), np.ones(len(closes), np.int64)
    while True:
        nxt = after[at]
        go = nxt <= n
        if not go.any():
            break
        at[go] = nxt[go]
        closed[go] += 1
    least, left = np.maximum(limit - sums[closes], 0), sums[n] - sums[at]
    keep = np.ones(len(closes), bool)
    # Closes that go on alike are one piece, which begins at the last of them.
    keep[:-1] = (at[1:] != at[:-1]) | (closed[1:] != closed[:-1])
    return list(zip(least[keep].tolist(), closed[keep].tolist(), left[keep].tolist()))[::-1]


def _units(threshold: float) -> tuple[int, int]:
    """(digits, limit): dollars count in 10**-digits, 8 digits or fewer where a block's sum would not fit 64 bits."""
    digits = max(0, min(8, 17 - len(str(int(threshold * BARS_PER_BLOCK)))))
    limit = round(threshold * 10**digits)
    if limit < 1:
        raise ValueError("the threshold must be positive")
    return digits, limit


def _blocked(ticks: DataFrame, threshold: float, unit: str) -> tuple[DataFrame, int]:
    """(ticks with _worth and _block, limit): dollars as integers, cut to one bar's worth, in blocks of BARS_PER_BLOCK bars."""
    digits, limit = _units(threshold)
    worth = F.least(F.round(F.col("price") * F.col("quantity") * F.lit(10**digits).cast("decimal(9,0)")).cast("decimal(38,0)"), F.lit(limit).cast("decimal(38,0)"))
    d = ticks.withColumn("_worth", F.coalesce(worth.cast("long"), F.lit(0).cast("long")))
    d = running_total(d, F.col("_worth").cast("decimal(38,0)"), "_sum", unit=unit)
    block = F.expr(f"cast((_sum - _worth) div {limit * BARS_PER_BLOCK} as long)")
    return d.withColumn("_block", F.struct("symbol", block.alias("n"))).drop("_sum"), limit


def reset_bar_ids(ticks: DataFrame, threshold: float, unit: str = "day") -> DataFrame:
    """Ticks with the bar_id of bars that close on the crossing tick, and _worth, their share in it.

    A bar begins where the one before it has closed, so bars depend on all ticks before them; yet a block of ticks only
    maps the sum of the bar that it finds open to the sum of the one that it leaves. All blocks find their maps at once,
    the maps are followed from block to block (a few rows a block: the only thing of a symbol that one task reads), and
    with the sums that they begin with all blocks number their bars at once. A block takes 24 bytes of a task's memory
    for each tick.
    """
    d, limit = _blocked(ticks, threshold, unit)

    def pieces(t: pa.Table) -> list[tuple[int, int, int]]:
        worth = t.column("_worth").to_numpy()
        return [(-1, 0, int(worth.sum())), *block_map(worth, limit)]

    def number(t: pa.Table, open_: int) -> np.ndarray:
        worth = t.column("_worth").to_numpy()
        _, after = _closings(worth, limit)
        at = int(np.searchsorted(np.cumsum(worth), limit - open_, "left")) + 1
        closes = []
        while at <= len(worth):
            closes.append(at)
            at = int(after[at])
        return np.searchsorted(np.array(closes, np.int64), np.arange(1, len(worth) + 1), "left")

    return chained(d, ["_worth"], pieces, number, 0, "bar_id")


def reset_bars(ticks: DataFrame, threshold: float, keep_tail: bool = True, unit: str = "day") -> DataFrame:
    """Bars that close on the crossing tick, parallel within a symbol (reset_bar_ids); the unfinished last bar stays or goes."""
    d = reset_bar_ids(ticks, threshold, unit)
    b = bars_of(d, F.sum(F.col("_worth").cast("decimal(38,0)")).alias("_sum"))
    if not keep_tail:
        b = b.where(F.col("_sum") >= _units(threshold)[1])
    doubles = {c: F.col(c).cast("double") for c in ("open", "high", "low", "close", "volume", "dollar_volume", "price_change", "buy_volume", "sell_volume")}
    return b.drop("_sum").withColumns(doubles).withColumn("threshold_used", F.lit(float(threshold)))


def bar_statistics(bars: DataFrame) -> DataFrame:
    """Per symbol: bars, tick counts, mean sizes, the four moments of the returns from bar to bar, and, for adaptive
    bars, the least, largest and mean threshold. No bars at all are an error."""
    if not bars.limit(1).count():
        raise ValueError("there are no bars")
    c = F.col("close").cast("double")
    r = ratio(c, F.lag(c).over(W.partitionBy("symbol").orderBy("bar_id"))) - 1
    b = bars.withColumn("_r", r)
    limits = [dbl(f("threshold_used")).alias(f"threshold_{n}") for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))] if "threshold_used" in bars.columns else []
    n = F.count("_r").cast("double")
    skew = F.when((n > 2) & (F.stddev_pop("_r") > 0), F.skewness("_r") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when((n > 3) & (F.stddev_pop("_r") > 0), ((n + 1) * F.kurtosis("_r") + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return b.groupBy("symbol").agg(
        F.count("*").alias("n_bars"), dbl(F.avg("tick_count")).alias("mean_ticks"), dbl(F.stddev_samp("tick_count")).alias("std_ticks"), dbl(F.avg(F.col("volume").cast("double"))).alias("mean_volume"),
        dbl(F.avg(F.col("dollar_volume").cast("double")), 4).alias("mean_dollars"), dbl(F.avg("_r")).alias("mean_return"), dbl(F.stddev_samp("_r")).alias("std_return"),
        dbl(skew, 4).alias("skew_return"), dbl(kurt, 3).alias("kurtosis_return"), *limits,
    )
