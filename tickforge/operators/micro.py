"""Microstructure metrics per (symbol, window), as column expressions that batch and streaming share; order books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import bps, clamped_bin, dbl, ratio
from .selection import exact_quantiles
from .stats import buy, dollar_imbalance, sell, sum_if, vwap


def order_flow_metrics() -> list[Column]:
    """Side counts, volumes and dollars, three imbalances, mean sizes, ratios, and whether an imbalance is over 0.1."""
    q, d = F.col("quantity"), F.col("price") * F.col("quantity")
    trade = ratio(F.count_if(buy()) - F.count_if(sell()), F.count("*"))
    volume = ratio(sum_if(q, buy()) - sum_if(q, sell()), F.sum(q))
    return [
        F.count_if(buy()).alias("buys"), F.count_if(sell()).alias("sells"), dbl(sum_if(q, buy())).alias("buy_volume"), dbl(sum_if(q, sell())).alias("sell_volume"),
        dbl(sum_if(d, buy()), 4).alias("buy_dollars"), dbl(sum_if(d, sell()), 4).alias("sell_dollars"), dbl(trade).alias("trade_imbalance"), dbl(volume).alias("volume_imbalance"), dbl(dollar_imbalance()).alias("dollar_imbalance"),
        dbl(ratio(sum_if(q, buy()), F.count_if(buy()), 0)).alias("avg_buy_size"), dbl(ratio(sum_if(q, sell()), F.count_if(sell()), 0)).alias("avg_sell_size"),
        dbl(ratio(F.count_if(buy()), F.count_if(sell()))).alias("count_ratio"), (F.abs(volume) > 0.1).alias("significant_imbalance"),
    ]


def liquidity_metrics(seconds: float) -> list[Column]:
    """Trades, price moments (population), range, sizes, score trades / deviation, impact deviation / mean size, rate."""
    p, q = F.col("price").cast("double"), F.col("quantity").cast("double")
    std = F.stddev_pop(p)
    return [
        F.count("*").alias("trades"), dbl(F.avg(p)).alias("mean_price"), dbl(std).alias("price_std"), F.min(p).alias("min_price"), F.max(p).alias("max_price"), dbl(F.max(p) - F.min(p)).alias("price_range"), dbl(ratio(F.max(p) - F.min(p), F.avg(p)) * 100).alias("range_pct"),
        dbl(F.avg(q)).alias("mean_size"), dbl(F.stddev_pop(q)).alias("size_std"), dbl(F.sum(q)).alias("volume"), dbl(F.try_divide(F.count("*").cast("double"), F.when(std > 1e-9, std)), 4).alias("liquidity_score"),
        dbl(ratio(std, F.avg(q))).alias("price_impact"), dbl(F.count("*") / F.lit(float(seconds))).alias("arrival_rate"),
    ]


def volume_metrics() -> list[Column]:
    q = F.col("quantity")
    delta = sum_if(q, buy()) - sum_if(q, sell())
    return [F.count("*").alias("trades"), dbl(F.sum(q)).alias("volume"), dbl(vwap()).alias("vwap"), dbl(delta).alias("delta"), dbl(ratio(delta, F.sum(q)) * 100).alias("delta_pct")]


def size_metrics() -> list[Column]:
    q = F.col("quantity").cast("double")
    pc = lambda v: dbl(F.percentile(q, F.lit(v)))
    return [F.count("*").alias("trades"), dbl(F.sum(q)).alias("volume"), dbl(F.avg(q)).alias("mean"), pc(0.5).alias("median"), dbl(F.stddev_pop(q)).alias("std"), dbl(F.min(q)).alias("min"), dbl(F.max(q)).alias("max"), pc(0.25).alias("p25"), pc(0.75).alias("p75"), pc(0.95).alias("p95")]


def windowed(ticks: DataFrame, metrics: list[Column], seconds: int = 60) -> DataFrame:
    """Metrics per tumbling window and symbol; works on batch and streaming ticks alike."""
    return ticks.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "symbol").agg(*metrics).withColumn("bucket", F.col("w.start")).drop("w")


def with_bucket(ticks: DataFrame, seconds: int) -> DataFrame:
    return ticks.withColumn("bucket", F.window("ts", f"{seconds} seconds").start)


def _in_window() -> W:
    return W.partitionBy("symbol", "bucket").orderBy("ts", "trade_id")


def runs_test(ticks: DataFrame, seconds: int = 3600) -> DataFrame:
    """Direction persistence: z of the number of runs, sign-flipped; with more than 10 trades, 0 if one-sided."""
    d = with_bucket(ticks, seconds)
    d = d.withColumn("_c", (F.col("is_buyer_maker") != F.lag("is_buyer_maker").over(_in_window())).cast("long"))
    g = d.groupBy("symbol", "bucket").agg(F.count("*").cast("double").alias("n"), F.count_if(buy()).cast("double").alias("n1"), F.count_if(sell()).cast("double").alias("n2"), (F.coalesce(F.sum("_c"), F.lit(0)) + 1).cast("double").alias("runs"))
    mean = 2 * F.col("n1") * F.col("n2") / F.col("n") + 1
    var = 2 * F.col("n1") * F.col("n2") * (2 * F.col("n1") * F.col("n2") - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    z = -F.try_divide(F.col("runs") - mean, F.sqrt(F.when(var > 0, var)))
    p = F.when(F.col("n") > 10, F.when((F.col("n1") == 0) | (F.col("n2") == 0), 0.0).otherwise(z))
    return g.select("symbol", "bucket", F.col("runs").cast("long").alias("runs"), (dbl(p) + 0.0).alias("persistence"))


def tick_frequency(ticks: DataFrame, seconds: int = 3600) -> DataFrame:
    """Share of trades, after the first of a window, that change the price."""
    d = with_bucket(ticks, seconds).withColumn("_c", (F.col("price") != F.lag("price").over(_in_window())).cast("double"))
    return d.groupBy("symbol", "bucket").agg(dbl(F.avg("_c")).alias("tick_frequency"))


def toxicity(ticks: DataFrame, seconds: int = 86400, last: int = 100, least: int = 10) -> DataFrame:
    """(correlation of a trade's direction with the next price change + 1) / 2 over a window's last trades."""
    d = with_bucket(ticks, seconds)
    d = d.withColumn("_dp", (F.lead("price").over(_in_window()) - F.col("price")).cast("double")).withColumn("_dir", F.when(buy(), 1.0).otherwise(-1.0))
    k = F.row_number().over(W.partitionBy("symbol", "bucket").orderBy(F.desc("ts"), F.desc("trade_id")))
    d = d.where("_dp is not null").withColumn("_k", k).where(F.col("_k") <= last)
    # Too few trades count as none: corr() of a single pair divides by zero.
    enough = F.count("*").over(W.partitionBy("symbol", "bucket")) >= least
    d = d.withColumn("_dp", F.when(enough, F.col("_dp")))
    return d.groupBy("symbol", "bucket").agg(dbl((F.corr("_dir", "_dp") + 1) / 2).alias("toxicity"))


def profile(ticks: DataFrame, seconds: int = 86400, bins: int = 20) -> DataFrame:
    """(symbol, bucket, bin, volume, buy_volume, sell_volume): equal-width bins of each window's price range."""
    d = with_bucket(ticks, seconds)
    r = d.groupBy("symbol", "bucket").agg(F.min(F.col("price").cast("double")).alias("_lo"), F.max(F.col("price").cast("double")).alias("_hi"))
    d = d.join(r, ["symbol", "bucket"]).withColumn("bin", clamped_bin(F.col("price").cast("double"), F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins, bins))
    q = F.col("quantity")
    return d.groupBy("symbol", "bucket", "bin").agg(dbl(F.sum(q)).alias("volume"), dbl(sum_if(q, buy())).alias("buy_volume"), dbl(sum_if(q, sell())).alias("sell_volume"))


def value_area(prof: DataFrame, bins: int = 20, share: float = 0.7) -> DataFrame:
    """Per window: point of control (lowest on ties), concentration, and the value area grown from it.

    The area grows by the larger neighbour, the low side on ties, until it holds ``share`` of the volume: a fold over
    at most ``bins`` values of a histogram array.
    """
    m = F.map_from_entries(F.collect_list(F.struct("bin", "volume")))
    g = prof.groupBy("symbol", "bucket").agg(m.alias("_m"), F.sum("volume").alias("_t"), F.max_by("bin", F.struct("volume", -F.col("bin"))).alias("poc"))
    g = g.withColumn("_h", F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(0.0))))
    at = lambda i: F.coalesce(F.get("_h", i), F.lit(-1.0))
    start = F.struct(F.col("poc").alias("lo"), F.col("poc").alias("hi"), at(F.col("poc")).alias("v"))

    def step(s, _):
        low, high = at(s["lo"] - 1), at(s["hi"] + 1)
        down = (low >= high) & (s["lo"] > 0)
        grow = s["v"] < F.lit(share) * F.col("_t")
        up = ~down & (high >= 0)
        lo, hi = F.when(grow & down, s["lo"] - 1).otherwise(s["lo"]), F.when(grow & up, s["hi"] + 1).otherwise(s["hi"])
        return F.struct(lo.alias("lo"), hi.alias("hi"), (s["v"] + F.when(grow & down, low).when(grow & up, high).otherwise(0.0)).alias("v"))

    area = F.aggregate(F.sequence(F.lit(1), F.lit(bins)), start, step)
    hhi = F.aggregate("_h", F.lit(0.0), lambda s, v: s + (v / F.col("_t")) * (v / F.col("_t")))
    return g.withColumn("_a", area).select("symbol", "bucket", "poc", dbl(hhi).alias("concentration"), F.col("_a.lo").alias("va_low"), F.col("_a.hi").alias("va_high"))


def volume_clusters(ticks: DataFrame, seconds: int = 86400, piece: int = 3600) -> DataFrame:
    """Volumes of short pieces inside a window: mean, population deviation, extremes, bursts and quiet pieces (2 std),
    the share of bursts, and the means of the first and the second half of the pieces."""
    s = ticks.groupBy("symbol", F.window("ts", f"{seconds} seconds").start.alias("bucket"), F.floor(F.unix_seconds("ts") / F.lit(piece)).alias("piece")).agg(F.sum("quantity").cast("double").alias("v"))
    w = W.partitionBy("symbol", "bucket")
    s = s.withColumn("_m", F.avg("v").over(w)).withColumn("_s", F.stddev_pop("v").over(w)).withColumn("_k", F.row_number().over(w.orderBy("piece"))).withColumn("_n", F.count("*").over(w))
    bursts, early = F.count_if(F.col("v") > F.col("_m") + 2 * F.col("_s")), F.col("_k") <= F.floor(F.col("_n") / 2)
    return s.groupBy("symbol", "bucket").agg(
        F.count("*").alias("pieces"), dbl(F.avg("v")).alias("mean"), dbl(F.stddev_pop("v")).alias("std"), dbl(F.max("v")).alias("max"), dbl(F.min("v")).alias("min"), bursts.alias("bursts"), F.count_if(F.col("v") < F.col("_m") - 2 * F.col("_s")).alias("quiet"),
        dbl(bursts / F.count("*")).alias("burst_rate"), dbl(F.avg(F.when(early, F.col("v")))).alias("first_half"), dbl(F.avg(F.when(~early, F.col("v")))).alias("second_half"),
    )


def momentum(ticks: DataFrame, seconds: int = 86400, k: int = 10) -> DataFrame:
    """Relative price change over a window's last k trades, its difference to that of the k trades before, and the
    window's trades, vwap and the population deviation of its price changes."""
    d = with_bucket(ticks, seconds)
    late, p = W.partitionBy("symbol", "bucket").orderBy(F.desc("ts"), F.desc("trade_id")), F.col("price").cast("double")
    d = d.withColumn("_k", F.row_number().over(late)).withColumn("_r", ratio(p - F.lead(p).over(late), F.lead(p).over(late)))
    at = lambda i: F.max(F.when(F.col("_k") == i, p))
    now, before = ratio(at(1) - at(k), at(k)), ratio(at(k + 1) - at(2 * k), at(2 * k))
    return d.groupBy("symbol", "bucket").agg(dbl(now).alias("momentum"), dbl(now - before).alias("acceleration"), F.count("*").alias("trades"), dbl(vwap()).alias("vwap"), dbl(F.stddev_pop("_r")).alias("volatility"))


# Order books: symbol, ts, bids and asks as arrays of (price, quantity), best first.


def books_from_ticks(ticks: DataFrame, levels: int = 10) -> DataFrame:
    """A daily book per symbol made of trades: the cheapest prices as asks ascending, the highest as bids descending."""
    up, down = W.partitionBy("symbol", "date").orderBy("price", "trade_id"), W.partitionBy("symbol", "date").orderBy(F.desc("price"), "trade_id")
    d = ticks.withColumn("_a", F.row_number().over(up)).withColumn("_b", F.row_number().over(down)).where((F.col("_a") <= levels) | (F.col("_b") <= levels))
    side = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col(k) <= levels, F.struct(F.col(k).alias("k"), "price", "quantity")))), lambda s: F.struct(s["price"].alias("price"), s["quantity"].alias("quantity")))
    return d.groupBy("symbol", "date").agg(side("_b").alias("asks"), side("_a").alias("bids"), F.max("ts").alias("ts"))


def parse_levels(json: Column, n: int = 20) -> Column:
    """'[["1.0","2"], ...]' to an array of (price, quantity), the first n levels."""
    pairs = F.slice(F.from_json(json, "array<array<string>>"), 1, n)
    return F.transform(pairs, lambda p: F.struct(F.get(p, 0).cast("decimal(18,8)").alias("price"), F.get(p, 1).cast("decimal(18,8)").alias("quantity")))


def top_of_book(books: DataFrame) -> DataFrame:
    """Best bid and ask, spread (absolute, basis points), mid; books with an empty side are left out."""
    b, a = F.get("bids", F.lit(0))["price"].cast("double"), F.get("asks", F.lit(0))["price"].cast("double")
    d = books.where((F.size("bids") > 0) & (F.size("asks") > 0))
    return d.withColumn("best_bid", b).withColumn("best_ask", a).withColumn("spread", dbl(a - b)).withColumn("mid", dbl((a + b) / 2)).withColumn("spread_bps", dbl(bps(a - b, (a + b) / 2), 4))


def depth(books: DataFrame, n: int = 5) -> DataFrame:
    """Long form: cumulative bid and ask quantity and their imbalance at every level up to n and the shorter side."""
    m = F.least(F.lit(n), F.size("bids"), F.size("asks"))
    total = lambda c, i: F.aggregate(F.slice(c, 1, i), F.lit(0.0), lambda s, v: s + v["quantity"].cast("double"))
    d = books.withColumn("_n", m).where("_n > 0").withColumn("level", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    d = d.withColumn("bid_depth", total("bids", F.col("level"))).withColumn("ask_depth", total("asks", F.col("level")))
    return d.withColumn("imbalance", dbl(ratio(F.col("bid_depth") - F.col("ask_depth"), F.col("bid_depth") + F.col("ask_depth")))).drop("_n")


def weighted_spread(books: DataFrame, n: int = 5) -> DataFrame:
    """Volume-weighted ask minus bid price over the first n levels; the plain spread where there is no volume."""
    vol = lambda c: F.aggregate(F.slice(c, 1, n), F.lit(0.0), lambda s, v: s + v["quantity"].cast("double"))
    pv = lambda c: F.aggregate(F.slice(c, 1, n), F.lit(0.0), lambda s, v: s + v["quantity"].cast("double") * v["price"].cast("double"))
    w = F.try_divide(pv("asks"), vol("asks")) - F.try_divide(pv("bids"), vol("bids"))
    plain = F.get("asks", F.lit(0))["price"].cast("double") - F.get("bids", F.lit(0))["price"].cast("double")
    return books.withColumn("weighted_spread", dbl(F.coalesce(w, plain)))


def level_notionals(books: DataFrame, side: str = "bids") -> DataFrame:
    """One row per level: price, quantity, notional and running notional."""
    d = books.select("symbol", "ts", F.posexplode(side).alias("level", "l"))
    d = d.select("symbol", "ts", "level", F.col("l.price").cast("double").alias("price"), F.col("l.quantity").cast("double").alias("quantity"))
    run = F.sum(F.col("price") * F.col("quantity")).over(W.partitionBy("symbol", "ts").orderBy("level").rowsBetween(W.unboundedPreceding, 0))
    return d.withColumn("notional", dbl(F.col("price") * F.col("quantity"), 4)).withColumn("running", dbl(run, 4))


def spread_statistics(books: DataFrame, n: int = 1000) -> DataFrame:
    w = W.partitionBy("symbol").orderBy("ts").rowsBetween(-(n - 1), 0)
    t = top_of_book(books)
    return t.select("symbol", "ts", "spread_bps", dbl(F.avg("spread_bps").over(w), 4).alias("avg_bps"), F.min("spread_bps").over(w).alias("min_bps"), F.max("spread_bps").over(w).alias("max_bps"))


def last_book(books: DataFrame, seconds: int) -> DataFrame:
    """The newest snapshot of every window and symbol."""
    d = books.groupBy("symbol", F.window("ts", f"{seconds} seconds").start.alias("bucket")).agg(F.max_by(F.struct("ts", "bids", "asks"), "ts").alias("b"))
    return d.select("symbol", "bucket", "b.*")


def latest_book(books: DataFrame, levels: int = 10) -> DataFrame:
    """The newest snapshot per symbol with the first ``levels`` of either side."""
    b = books.groupBy("symbol").agg(F.max_by(F.struct("ts", "bids", "asks"), "ts").alias("b"))
    return b.select("symbol", "b.ts", F.slice("b.bids", 1, levels).alias("bids"), F.slice("b.asks", 1, levels).alias("asks"))


def book_liquidity(books: DataFrame, seconds: int, n: int = 5) -> DataFrame:
    """Per symbol and window, from its last snapshot: top of book, weighted spread, and depth and imbalance at level n."""
    last = weighted_spread(top_of_book(last_book(books, seconds)), n)
    total = lambda c: F.aggregate(F.slice(c, 1, n), F.lit(0.0), lambda s, v: s + v["quantity"].cast("double"))
    d = last.withColumn("bid_depth", dbl(total("bids"))).withColumn("ask_depth", dbl(total("asks")))
    d = d.withColumn("imbalance", dbl(ratio(F.col("bid_depth") - F.col("ask_depth"), F.col("bid_depth") + F.col("ask_depth"))))
    return d.select("symbol", "bucket", "best_bid", "best_ask", "spread_bps", "weighted_spread", "bid_depth", "ask_depth", "imbalance")


def large_and_small(ticks: DataFrame, seconds: int = 86400, small: float = 0.25, large: float = 0.95) -> DataFrame:
    """Per window: mean size by side, share of trades at or under the small percentile and over the large one, and
    how many trades are over two running deviations (expanding_outliers)."""
    d = with_bucket(ticks, seconds).withColumn("_q", F.col("quantity").cast("double"))
    w = W.partitionBy("symbol", "bucket")
    cuts = exact_quantiles(d, "_q", {"_a": small, "_z": large}, ("symbol", "bucket"))
    run = w.orderBy("ts", "trade_id").rowsBetween(W.unboundedPreceding, 0)
    z = F.try_divide(F.col("_q") - F.avg("_q").over(run), F.when(F.stddev_pop("_q").over(run) > 1e-9, F.stddev_pop("_q").over(run)))
    d = d.withColumn("_big", (F.abs(F.round(z, 5)) > 2) & (F.count("*").over(run) > 20)).join(cuts, ["symbol", "bucket"])
    pct = lambda c: dbl(F.count_if(c) * 100 / F.count("*"))
    return d.groupBy("symbol", "bucket").agg(
        F.count_if("_big").alias("large_count"), dbl(F.avg(F.when(buy(), F.col("_q")))).alias("avg_buy"), dbl(F.avg(F.when(sell(), F.col("_q")))).alias("avg_sell"),
        pct(F.col("_q") <= F.col("_a")).alias("small_pct"), pct(F.col("_q") > F.col("_z")).alias("large_pct"),
    )


def profile_shape(ticks: DataFrame, seconds: int = 86400, bins: int = 20) -> DataFrame:
    """Per window: lowest and highest price, point of control, Herfindahl concentration of the bins, weighted deviation."""
    p, q = F.col("price").cast("double"), F.col("quantity").cast("double")
    b = profile(ticks, seconds, bins).groupBy("symbol", "bucket").agg(
        F.max_by("bin", F.struct("volume", -F.col("bin"))).alias("poc_bin"), dbl(F.sum(F.col("volume") * F.col("volume")) / F.pow(F.sum("volume"), F.lit(2.0))).alias("concentration"),
    )
    mean = F.sum(p * q) / F.sum(q)
    var = F.sum(p * p * q) / F.sum(q) - mean * mean
    t = with_bucket(ticks, seconds).groupBy("symbol", "bucket").agg(F.min(p).alias("low"), F.max(p).alias("high"), dbl(F.sqrt(F.greatest(var, F.lit(0.0))), 4).alias("weighted_std"))
    return t.join(b, ["symbol", "bucket"])
