"""Values over the last rows or the last seconds of a symbol, in blocks: trailing statistics, price impact, intensity,
and windows that trades open."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import dbl, ratio
from ..plans.chains import chained
from ..plans.prefix import row_numbers
from ..sources.files import written
from .selection import exact_quantiles
from .stats import sell

#: Rows of a block, and decay times of one.
ROWS, SPANS = 65_536, 64


def trailing_statistics(ticks: DataFrame, as_of, column: str = "price", sizes: tuple = (1, 5, 30, 60)) -> DataFrame:
    """Statistics of a metric over trailing windows of these seconds that end at as_of, one row per size and symbol.

    Ticks are counted once, by pane (the greatest length that divides all sizes) and value; the windows are put together
    from the panes. Both ends of a window belong to it. Null values don't count.
    """
    end, pane = F.unix_micros(F.lit(as_of).cast("timestamp")), math.gcd(*sizes)
    age = end - F.unix_micros("ts")
    d = ticks.where((age >= 0) & (age <= max(sizes) * 1_000_000) & F.col(column).isNotNull())
    at = F.struct("ts", "trade_id")
    panes = d.groupBy("symbol", F.ceil(age / F.lit(pane * 1_000_000)).alias("pane"), F.col(column).cast("double").alias("v")).agg(F.count("*").alias("c"), F.min(at).alias("a"), F.max(at).alias("z"))
    size = F.explode(F.array(*[F.lit(s) for s in sizes]))
    w = panes.withColumn("window_s", size).where(F.col("pane") * pane <= F.col("window_s"))
    w = w.groupBy("symbol", "window_s", "v").agg(F.sum("c").alias("c"), F.min("a").alias("a"), F.max("z").alias("z"))
    w = written(w, "panes")
    mean = F.sum(F.col("v") * F.col("c")) / F.sum("c")
    first, last = F.min_by("v", "a"), F.max_by("v", "z")
    s = w.groupBy("symbol", "window_s").agg(F.sum("c").alias("n"), mean.alias("_m"), F.min("v").alias("min"), F.max("v").alias("max"), first.alias("first"), last.alias("last"))
    gap = F.col("v") - F.col("_m")
    keyed = lambda d: d.withColumn("_k", F.struct("symbol", "window_s"))
    var = keyed(w).drop("symbol", "window_s").join(keyed(s).select("_k", "_m"), "_k").groupBy("_k").agg((F.sum(gap * gap * F.col("c")) / F.sum("c")).alias("_v"))
    q = exact_quantiles(w, "v", {"median": 0.5, "p25": 0.25, "p75": 0.75, "p95": 0.95}, ("symbol", "window_s"), weight="c")
    out = keyed(s).join(var, "_k").join(keyed(q).drop("symbol", "window_s"), "_k")
    change = F.col("last") - F.col("first")
    return out.select(
        "symbol", "window_s", "n", dbl("_m").alias("mean"), dbl(F.sqrt("_v")).alias("std"), dbl("min").alias("min"), dbl("max").alias("max"), *[dbl(c).alias(c) for c in ("median", "p25", "p75", "p95")],
        dbl(F.col("max") - F.col("min")).alias("range"), dbl("first").alias("first"), dbl("last").alias("last"), dbl(change).alias("change"), dbl(ratio(change, F.col("first")) * 100).alias("change_pct"),
    )


def in_row_blocks(df: DataFrame, back: int, rows: int = ROWS) -> tuple[DataFrame, W]:
    """(rows with _rn, _block and _mine, window): blocks of a symbol's rows in order, each with the ``back`` rows before it.

    What looks back no further than that can be taken over the window, which holds one block; then keep _mine only.
    """
    rows = max(rows, back)
    d = row_numbers(df, "_rn")
    n = F.floor((F.col("_rn") - 1) / rows)
    late = (F.col("_rn") - 1) % rows >= rows - back
    d = d.withColumn("_b", F.explode(F.when(late, F.array(n, n + 1)).otherwise(F.array(n)))).withColumn("_mine", F.col("_b") == n)
    d = d.withColumn("_block", F.struct("symbol", F.col("_b").alias("n"))).drop("_b")
    return d, W.partitionBy("_block").orderBy("_rn")


def price_impact(ticks: DataFrame, n: int = 100, rows: int = ROWS) -> DataFrame:
    """Ticks with impact: the least-squares slope of the price change on the signed volume over the last n trades, null
    until there are n changes or where volumes don't differ, and r_squared of that fit.

    Sums over n rows are differences of running sums inside a block; they are exact, as they are of decimals.
    """
    d, w = in_row_blocks(ticks, n + 1, rows)
    p = F.col("price")
    d = d.withColumn("_x", F.when(sell(), -F.col("quantity")).otherwise(F.col("quantity")).cast("decimal(18,8)")).withColumn("_y", (p - F.lag("price").over(w)).cast("decimal(18,8)"))
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Rows without a change (the first of a block) count nothing.
    terms = {"_sx": F.col("_x"), "_sy": F.col("_y"), "_sxx": F.col("_x") * F.col("_x"), "_sxy": F.col("_x") * F.col("_y"), "_syy": F.col("_y") * F.col("_y"), "_n": F.lit(1)}
    for name, t in terms.items():
        run = F.sum(F.when(F.col("_y").isNotNull(), t)).over(upto)
        d = d.withColumn(name, run)
    back = lambda c: (F.col(c) - F.coalesce(F.lag(c, n).over(w), F.lit(0))).cast("double")
    d = d.withColumns({c + "n": back(c) for c in terms}).where("_mine and _rn > 0")
    k = F.col("_nn")
    sxx, sxy, syy = k * F.col("_sxxn") - F.col("_sxn") * F.col("_sxn"), k * F.col("_sxyn") - F.col("_sxn") * F.col("_syn"), k * F.col("_syyn") - F.col("_syn") * F.col("_syn")
    full = (k == n) & (sxx > 0)
    d = d.withColumn("impact", F.when(full, sxy / sxx)).withColumn("r_squared", F.when(full & (syy > 0), sxy * sxy / (sxx * syy)))
    return d.select(*ticks.columns, "impact", "r_squared")


def impact_decay(ticks: DataFrame, lags: int = 10, rows: int = ROWS) -> DataFrame:
    """(symbol, lag, n, mean_move): the mean price move in a trade's direction 1 to ``lags`` trades after it."""
    d, w = in_row_blocks(ticks, lags, rows)
    signed = lambda k: F.when(F.lag(sell(), k).over(w), -1).otherwise(1) * (F.col("price") - F.lag("price", k).over(w)).cast("double")
    d = d.withColumns({f"_m{k}": signed(k) for k in range(1, lags + 1)}).where("_mine")
    move = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_m{k}").alias("m")) for k in range(1, lags + 1)]))
    return d.select("symbol", move.alias("x")).where("x.m is not null").groupBy("symbol", "x.lag").agg(F.count("*").alias("n"), dbl(F.avg("x.m")).alias("mean_move"))


def trade_intensity(ticks: DataFrame, decay_seconds: float = 60.0, over: int = 100, z: float = 3.0, rows: int = ROWS) -> DataFrame:
    """Ticks with intensity, the trades so far weighed by exp(-age / decay_seconds), per second; intensity_z, its distance
    from its mean over the ``over`` trades before in deviations, null until they are there; and burst, whether that is over z.

    The weight of a trade is a function of time, so a block of SPANS decay times sums weights counted from its end, and
    takes over the sum of the block before it; what is older weighs less than a double resolves.
    """
    tau, span = decay_seconds * 1e6, int(decay_seconds * 1e6 * SPANS)
    us = F.unix_micros("ts")
    d = ticks.where(F.col("ts").isNotNull()).withColumn("_b", F.floor(us / F.lit(span))).withColumn("_age", ((F.col("_b") + 1) * F.lit(span) - us) / F.lit(tau))
    group = F.struct("symbol", F.col("_b").alias("n"))
    weight = F.exp(-F.col("_age"))
    carry = d.groupBy(F.struct("symbol", (F.col("_b") + 1).alias("n")).alias("_block")).agg(F.sum(weight).alias("_carry"))
    d = d.withColumn("_block", group).join(carry, "_block", "left")
    inner = W.partitionBy("_block").orderBy("ts", "trade_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    # exp(age) of a row undoes the scale of its block; the carry was counted from this block's beginning.
    y = F.sum(weight).over(inner) * F.exp("_age") + F.coalesce("_carry", F.lit(0.0)) * F.exp(F.col("_age") - SPANS)
    d = d.withColumn("intensity", y / F.lit(decay_seconds)).drop("_b", "_age", "_carry", "_block")
    d, w = in_row_blocks(d, over, rows)
    before = w.rowsBetween(-over, -1)
    full, std = F.count("intensity").over(before) == over, F.stddev_pop("intensity").over(before)
    d = d.withColumn("intensity_z", F.when(full & (std > 1e-12), (F.col("intensity") - F.avg("intensity").over(before)) / std)).where("_mine")
    return d.withColumn("burst", F.coalesce(F.col("intensity_z") > z, F.lit(False))).select(*ticks.columns, "intensity", "intensity_z", "burst")


def opened_windows(ticks: DataFrame, seconds: float, per_block: int = 64) -> DataFrame:
    """Ticks with window_id: a window begins with the first trade that the one before no longer holds, and holds all
    trades of less than ``seconds`` later. Windows follow the trades, not the clock; ticks without a time are left out.
    """
    width = int(seconds * 1_000_000)
    d = ticks.where(F.col("ts").isNotNull()).withColumn("_us", F.unix_micros("ts"))
    d = d.withColumn("_block", F.struct("symbol", F.floor(F.col("_us") / F.lit(width * per_block)).alias("n")))

    def begins(us: np.ndarray, at: int) -> list[int]:
        """Ticks at which windows begin, if one begins at the tick ``at``."""
        out = []
        while at < len(us):
            out.append(at)
            at = int(np.searchsorted(us, us[at] + width, "left"))
        return out

    # The state is how early the open window ends: minus its end, so that a later end is a smaller state.
    def pieces(t: pa.Table) -> list[tuple[int, int, int]]:
        us = t.column("_us").to_numpy()
        after = np.searchsorted(us, us + width, "left")
        # The first window begins at one of the ticks until a window after the block's beginning would have ended.
        at = np.flatnonzero(np.concatenate([[True], us[1:] > us[:-1]]) & (us < us[0] // (width * per_block) * (width * per_block) + width + 1))
        at = at if len(at) else np.array([0])
        first, links, now = at.copy(), np.ones(len(at), np.int64), at.copy()
        while True:
            go = after[now] < len(us)
            if not go.any():
                break
            now[go] = after[now[go]]
            links[go] += 1
        rows = [(-int(us[i]), int(k), -int(us[j] + width)) for i, k, j in zip(first.tolist(), links.tolist(), now.tolist())]
        later = int(np.searchsorted(us, us[0] // (width * per_block) * (width * per_block) + width + 1, "left"))
        if later < len(us) and later not in first:
            b = begins(us, later)
            rows.append((-int(us[later]), len(b), -int(us[b[-1]] + width)))
        return [(-(1 << 62), 0, 0), *sorted(rows)]

    def number(t: pa.Table, state: int) -> np.ndarray:
        us = t.column("_us").to_numpy()
        b = begins(us, int(np.searchsorted(us, -state, "left")))
        return np.searchsorted(np.array(b, np.int64), np.arange(len(us)), "right") - 1

    return chained(d, ["_us"], pieces, number, 1 << 61, "window_id").drop("_us")


def replay(ticks: DataFrame, seconds: float, metrics: list[Column], per_block: int = 64) -> DataFrame:
    """Metrics of the windows that trades open, with their number, first and last trade's time."""
    d = opened_windows(ticks, seconds, per_block)
    return d.groupBy("symbol", "window_id").agg(F.min("ts").alias("window_start"), F.max("ts").alias("window_last"), *metrics)
