"""Windows over ordered series of one symbol: gaps, indicators, signals, and feature tables on candles or bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import dbl, ratio
from ..plans.prefix import blocks, previous, running_total


def over(order: str = "bucket") -> W:
    return W.partitionBy("symbol").orderBy(order)


def rolling(f: Column, n: int, order: str = "bucket", full: bool = True) -> Column:
    """An aggregate over the last n rows; null until n rows are there, unless partial frames are wanted."""
    w = over(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.lit(1)).over(w) == n, f.over(w)) if full else f.over(w)


def x(c: str) -> Column:
    return F.col(c).cast("double")


def gaps(ticks: DataFrame, min_seconds: float = 3600) -> DataFrame:
    """(symbol, gap_start, gap_end, hours, days) between neighbouring ticks further apart than min_seconds."""
    d = previous(ticks.select("symbol", "ts", "trade_id"), {"ts": "gap_start"})
    s = (F.unix_micros("ts") - F.unix_micros("gap_start")) / F.lit(1e6)
    return d.where(s > min_seconds).select("symbol", "gap_start", F.col("ts").alias("gap_end"), dbl(s / 3600).alias("hours"), dbl(s / 86400).alias("days"))


def top_gaps(g: DataFrame, n: int, per_symbol: bool = False) -> DataFrame:
    if not per_symbol:
        return g.orderBy(F.desc("hours"), "symbol", "gap_start").limit(n)
    w = W.partitionBy("symbol").orderBy(F.desc("hours"), "gap_start")
    return g.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def islands(ticks: DataFrame, gap: str = "1 hour", unit: str = "day") -> DataFrame:
    """Stretches of data without a gap of ``gap`` or more.

    Ticks are shuffled once, by symbol and time block, and become one row for each stretch inside a block; only these
    rows meet by symbol, where stretches that go on in the next block are joined. Ticks without a time are left out.
    """
    d = ticks.where(F.col("ts").isNotNull()).select("symbol", "ts", "trade_id").withColumn("_grp", F.struct("symbol", blocks("ts", unit).alias("b")))
    apart = lambda p, at: F.when(F.col(p).isNull() | (F.col(p) + F.expr(f"interval {gap}") <= F.col(at)), 1).otherwise(0).cast("long")
    inner = W.partitionBy("_grp").orderBy("ts", "trade_id")
    d = d.withColumn("_p", F.lag("ts").over(inner)).withColumn("_part", F.sum(apart("_p", "ts")).over(inner.rowsBetween(W.unboundedPreceding, 0)))
    parts = d.groupBy("_grp", "_part").agg(F.min("ts").alias("a"), F.max("ts").alias("z"), F.count("*").alias("c"))
    of = W.partitionBy("_grp.symbol").orderBy("a")
    parts = parts.withColumn("_p", F.lag("z").over(of)).withColumn("_island", F.sum(apart("_p", "a")).over(of.rowsBetween(W.unboundedPreceding, 0)))
    out = parts.groupBy(F.col("_grp.symbol").alias("symbol"), "_island").agg(F.min("a").alias("island_start"), F.max("z").alias("island_end"), F.sum("c").alias("n"))
    return out.drop("_island")


def missing_ranges(islands_: DataFrame, start, end, min_hours: float = 0.1) -> DataFrame:
    """What [start, end] holds beside the islands of each symbol, pieces of at most min_hours left out."""
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    i = islands_.where((F.col("island_end") >= s) & (F.col("island_start") <= e)).select("symbol", "island_start", "island_end")
    sym = islands_.select("symbol").distinct()
    edge = sym.select("symbol", s.alias("island_start"), s.alias("island_end")).unionByName(sym.select("symbol", e.alias("island_start"), e.alias("island_end")))
    d = i.unionByName(edge).withColumn("upto", F.max("island_end").over(W.partitionBy("symbol").orderBy("island_start", "island_end").rowsBetween(W.unboundedPreceding, 0)))
    d = d.withColumn("nxt", F.lead("island_start").over(W.partitionBy("symbol").orderBy("island_start", "island_end")))
    hours = (F.unix_micros("nxt") - F.unix_micros("upto")) / F.lit(3.6e9)
    return d.where(hours > min_hours).select("symbol", F.col("upto").alias("missing_start"), F.col("nxt").alias("missing_end"), dbl(hours).alias("hours"))


def moving_averages(c: DataFrame, fast: int = 20, slow: int = 50) -> DataFrame:
    return c.withColumn("sma_fast", dbl(rolling(F.avg(x("close")), fast))).withColumn("sma_slow", dbl(rolling(F.avg(x("close")), slow)))


def returns(c: DataFrame, k: int = 1) -> DataFrame:
    """diff, pct_change, log_return over k rows."""
    prev = F.lag(x("close"), k).over(over())
    return c.withColumn("diff", dbl(x("close") - prev)).withColumn("pct_change", ratio(x("close"), prev) - 1).withColumn("log_return", F.log(ratio(x("close"), prev)))


def volatility(c: DataFrame, n: int = 24) -> DataFrame:
    return returns(c).withColumn("volatility", dbl(F.when(F.count("pct_change").over(over().rowsBetween(-(n - 1), 0)) == n, F.stddev_samp("pct_change").over(over().rowsBetween(-(n - 1), 0)))))


def bollinger(c: DataFrame, n: int = 20, k: float = 2.0) -> DataFrame:
    m, s = rolling(F.avg(x("close")), n), rolling(F.stddev_samp(x("close")), n)
    return c.withColumn("middle", dbl(m)).withColumn("upper", dbl(m + k * s)).withColumn("lower", dbl(m - k * s))


def rsi(c: DataFrame, n: int = 14) -> DataFrame:
    """Simple-mean RSI; no loss gives 100, neither gain nor loss null. The first difference counts as 0."""
    d = F.coalesce(x("close") - F.lag(x("close")).over(over()), F.lit(0.0))
    c = c.withColumn("_g", F.greatest(d, F.lit(0.0))).withColumn("_l", F.greatest(-d, F.lit(0.0)))
    g, l_ = rolling(F.avg("_g"), n), rolling(F.avg("_l"), n)
    return c.withColumn("rsi", dbl(F.when(l_ > 0, 100 - 100 / (1 + g / l_)).when(g > 0, 100.0), 5)).drop("_g", "_l")


def zscore(c: DataFrame, n: int = 20, column: str = "close", min_periods: bool = False) -> DataFrame:
    m, s = rolling(F.avg(x(column)), n, full=not min_periods), rolling(F.stddev_samp(x(column)), n, full=not min_periods)
    return c.withColumn("zscore", dbl(F.try_divide(x(column) - m, F.when(s > 1e-12, s)), 5))


def volume_features(c: DataFrame, n: int = 20) -> DataFrame:
    m = rolling(F.avg(x("volume")), n)
    return c.withColumn("volume_ma", dbl(m)).withColumn("volume_ratio", dbl(F.try_divide(x("volume"), m)))


def crossings(c: DataFrame, fast: int = 5, slow: int = 20) -> DataFrame:
    """signal (1 fast above slow, -1 below), position change, and cross (golden or death)."""
    d = moving_averages(c, fast, slow)
    s = F.when(F.col("sma_fast") > F.col("sma_slow"), 1).when(F.col("sma_fast") < F.col("sma_slow"), -1).otherwise(0)
    d = d.withColumn("signal", s).withColumn("position", F.col("signal") - F.lag("signal").over(over()))
    pf, ps = F.lag("sma_fast").over(over()), F.lag("sma_slow").over(over())
    return d.withColumn("cross", F.when((pf <= ps) & (F.col("sma_fast") > F.col("sma_slow")), "golden").when((pf >= ps) & (F.col("sma_fast") < F.col("sma_slow")), "death"))


def drawdown(c: DataFrame) -> DataFrame:
    """Cumulative return, its running maximum and the drawdown from it."""
    w = over().rowsBetween(W.unboundedPreceding, 0)
    d = returns(c).withColumn("cumulative", F.exp(F.coalesce(F.sum(F.log1p("pct_change")).over(w), F.lit(0.0))))
    d = d.withColumn("peak", F.max("cumulative").over(w))
    return d.withColumn("drawdown", F.col("cumulative") / F.col("peak") - 1)


def autocorrelation(c: DataFrame, k: int = 1) -> DataFrame:
    d = returns(c).withColumn("_lag", F.lag("pct_change", k).over(over()))
    return d.groupBy("symbol").agg(dbl(F.corr("pct_change", "_lag"), 5).alias("autocorrelation"))


def mean_reversion(c: DataFrame, n: int = 20, entry: float = -1.0, exit_: float = 0.0) -> DataFrame:
    """entry and exit rows of a long-only strategy: in when z crosses below ``entry`` while flat, out when it crosses
    above ``exit_`` while long. An event counts if it differs from the event before it, and the first must be an entry."""
    d = zscore(c, n)
    p = F.lag("zscore").over(over())
    event = F.when((p >= entry) & (F.col("zscore") < entry), "entry").when((p <= exit_) & (F.col("zscore") > exit_), "exit")
    e = d.withColumn("event", event).where("event is not null")
    before = F.lag("event").over(over())
    return e.withColumn("_b", before).where((F.col("event") != F.coalesce("_b", F.lit("exit")))).drop("_b")


def round_trips(signals: DataFrame, buy: Column, sell: Column) -> DataFrame:
    """Each buy row with the first later sell row: (symbol, entry_time, entry_price, exit_time, exit_price, pnl, pnl_pct)."""
    nxt = F.first(F.when(sell, F.struct("bucket", "close")), ignorenulls=True).over(over().rowsBetween(1, W.unboundedFollowing))
    d = signals.withColumn("_x", nxt).where(buy & F.col("_x").isNotNull())
    pnl = x("_x.close") - x("close")
    return d.select("symbol", F.col("bucket").alias("entry_time"), x("close").alias("entry_price"), F.col("_x.bucket").alias("exit_time"), x("_x.close").alias("exit_price"), dbl(pnl).alias("pnl"), dbl(F.try_divide(pnl, x("close")) * 100).alias("pnl_pct"))


def trip_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("symbol").agg(F.count("*").alias("n"), dbl(F.sum("pnl_pct")).alias("total_pct"), dbl(F.avg("pnl_pct")).alias("avg_pct"), dbl(F.count_if(F.col("pnl") > 0) * 100 / F.count("*")).alias("win_rate"), F.max("pnl").alias("best"), F.min("pnl").alias("worst"))


def best_and_worst(trips: DataFrame) -> DataFrame:
    """Per symbol the round trip with the largest and the one with the smallest P&L, the earlier one on ties."""
    early = -F.unix_micros("entry_time")
    best, worst = F.max_by(F.struct("entry_time", "pnl"), F.struct(F.col("pnl"), early)), F.max_by(F.struct("entry_time", "pnl"), F.struct(-F.col("pnl"), early))
    d = trips.groupBy("symbol").agg(best.alias("b"), worst.alias("w"))
    return d.select("symbol", F.col("b.entry_time").alias("best_entry"), F.col("b.pnl").alias("best"), F.col("w.entry_time").alias("worst_entry"), F.col("w.pnl").alias("worst"))


def trade_costs(trips: DataFrame, slippage: float = 0.001) -> DataFrame:
    """Round trips with entries that cost ``slippage`` more and exits that bring so much less: net P&L and %."""
    buy, sell = F.col("entry_price") * (1 + slippage), F.col("exit_price") * (1 - slippage)
    d = trips.withColumn("net_entry", dbl(buy)).withColumn("net_exit", dbl(sell)).withColumn("net_pnl", dbl(sell - buy))
    return d.withColumn("net_pct", dbl(F.try_divide(sell - buy, buy) * 100))


def performance(equity: DataFrame, per_year: float = 365.0) -> DataFrame:
    """Total return, volatility, Sharpe, Sortino, Calmar and maximum drawdown of an equity curve (symbol, bucket, close).

    Sortino divides by the deviation of the negative returns, Calmar the mean return of a year by the worst drawdown.
    """
    d = drawdown(equity)
    r, year = F.col("pct_change"), F.lit(per_year)
    down = F.stddev_samp(F.when(r < 0, r))
    return d.groupBy("symbol").agg(
        dbl(ratio(F.max_by(x("close"), "bucket"), F.min_by(x("close"), "bucket")) - 1, 4).alias("total_return"), dbl(F.stddev_samp(r) * F.sqrt(year), 4).alias("volatility"),
        dbl(F.try_divide(F.avg(r), F.stddev_samp(r)) * F.sqrt(year), 4).alias("sharpe"), dbl(F.min("drawdown"), 4).alias("max_drawdown"),
        dbl(F.try_divide(F.avg(r), down) * F.sqrt(year), 4).alias("sortino"), dbl(F.try_divide(F.avg(r) * year, F.abs(F.min("drawdown"))), 4).alias("calmar"),
    )


def feature_table(c: DataFrame) -> DataFrame:
    """Returns, rolling volatility, volume ratio, calendar features; rows with a null feature are dropped."""
    d = volume_features(volatility(c, 20))
    d = d.select("symbol", "bucket", dbl("pct_change").alias("pct_change"), dbl("log_return").alias("log_return"), "volatility", "volume_ratio", F.hour("bucket").alias("hour"), F.weekday("bucket").alias("weekday"))
    return d.na.drop()


def activity_regimes(b: DataFrame, column: str = "trades") -> DataFrame:
    """Rows per regime: above the 75th percentile high, below the 25th low, else normal; with mean sizes."""
    q = b.groupBy("symbol").agg(F.percentile(x(column), F.lit(0.25)).alias("_a"), F.percentile(x(column), F.lit(0.75)).alias("_z"))
    d = b.join(q, "symbol").withColumn("regime", F.when(x(column) > F.col("_z"), "high").when(x(column) < F.col("_a"), "low").otherwise("normal"))
    return d.groupBy("symbol", "regime").agg(F.count("*").alias("n"), dbl(F.avg(x(column))).alias("mean_activity"), dbl(F.avg(x("volume"))).alias("mean_volume"))


def fractional_weights(d: float, threshold: float = 1e-5, most: int = 10_000) -> list[float]:
    """w_0 = 1, w_k = -w_{k-1} (d - k + 1) / k, until a weight is at most the threshold."""
    w = [1.0]
    while len(w) < most:
        nxt = -w[-1] * (d - len(w) + 1) / len(w)
        if abs(nxt) <= threshold:
            break
        w.append(nxt)
    return w


def fractional_difference(c: DataFrame, d: float, threshold: float = 1e-3, column: str = "close") -> DataFrame:
    """Causal fractional differences: weight 1 on the newest value; null until all weights have a value.

    The frame is a bounded halo of len(weights) rows: values of the frame are folded with the literal weights.
    """
    w = fractional_weights(d, threshold)
    n = len(w)
    frame = over().rowsBetween(-(n - 1), 0)
    arr = F.collect_list(x(column)).over(frame)
    weights = F.array(*[F.lit(v) for v in reversed(w)])
    value = F.aggregate(F.zip_with("_v", weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return c.withColumn("_v", arr).withColumn("frac_diff", dbl(F.when(F.size("_v") == n, value))).drop("_v")


def asof_backward(probes: DataFrame, facts: DataFrame, columns: list[str], unit: str = "day") -> DataFrame:
    """For each probe (symbol, ts) the facts' columns of the latest row at or before it: one sort of the union.

    The sort is within time blocks; a block's last fact is carried over to the blocks after it, so a symbol that holds
    most rows is many tasks.
    """
    f = facts.select("symbol", "ts", F.lit(0).alias("_k"), F.struct("ts", *columns).alias("_f"), *[F.lit(None).cast(t).alias(c) for c, t in probes.dtypes if c not in ("symbol", "ts")])
    p = probes.select("symbol", "ts", F.lit(1).alias("_k"), F.lit(None).cast(f.schema["_f"].dataType).alias("_f"), *[c for c in probes.columns if c not in ("symbol", "ts")])
    d = f.unionByName(p).withColumn("_blk", blocks("ts", unit))
    w = W.partitionBy("symbol", "_blk").orderBy("ts", "_k").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("symbol").orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    carry = d.groupBy("symbol", "_blk").agg(F.max_by("_f", F.when(F.col("_k") == 0, F.col("ts"))).alias("_last"))
    carry = carry.withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    same = d["symbol"].eqNullSafe(carry["symbol"]) & d["_blk"].eqNullSafe(carry["_blk"])
    d = d.join(carry, same).select(d["*"], "_carry")
    d = d.withColumn("_m", F.coalesce(F.last("_f", ignorenulls=True).over(w), "_carry")).where("_k = 1")
    return d.select(*probes.columns, F.col("_m.ts").alias("fact_ts"), *[F.col(f"_m.{c}").alias(c) for c in columns])


#: Values of the left side of a band join (rows times columns) that are broadcast, at most.
MAX_VALUES = 4_000_000


def time_band_join(left: DataFrame, right: DataFrame, seconds: int) -> DataFrame:
    """Pairs of rows of one symbol at most ``seconds`` apart: equal buckets of that width and their neighbours.

    A left side of at most MAX_VALUES values is counted, gathered by bucket and broadcast, so that right rows pass by
    without a shuffle or sort; a larger one is shuffled with them.
    """
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(seconds * 1_000_000)).cast("long")
    around = lambda c: F.explode(F.sequence(bucket(c) - 1, bucket(c) + 1))
    r = right.withColumnsRenamed({c: f"r_{c}" for c in right.columns if c != "symbol"})
    mine, theirs = [c for c in left.columns if c != "symbol"], [c for c in r.columns if c != "symbol"]
    most = MAX_VALUES // len(mine)
    if left.limit(most + 1).count() <= most:
        cells = left.groupBy("symbol", bucket("ts").alias("_b")).agg(F.collect_list(F.struct(*mine)).alias("_l"))
        pairs = r.withColumn("_b", around("r_ts")).join(F.broadcast(cells), ["symbol", "_b"]).select("symbol", *theirs, F.inline("_l"))
    else:
        pairs = left.withColumn("_b", around("ts")).join(r.withColumn("_b", bucket("r_ts")), ["symbol", "_b"])
    near = F.abs(F.unix_micros("ts") - F.unix_micros("r_ts")) <= seconds * 1_000_000
    return pairs.where(near).select("symbol", *mine, *theirs)


def compare(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [d.withColumn("kind", F.lit(k)) for k, d in parts.items()])


def align(parts: dict[str, DataFrame], column: str, keys: tuple = ("symbol", "bucket")) -> DataFrame:
    """Outer alignment of series on their keys: one row per key, one column per part, null where a part has no row.

    A union and one aggregate instead of a chain of full joins: one shuffle, whatever the number of series.
    """
    rows = [d.select(*keys, F.lit(n).alias("_n"), F.col(column).alias("_v")) for n, d in parts.items()]
    one = reduce(DataFrame.unionByName, rows)
    return one.groupBy(*keys).agg(*[F.max(F.when(F.col("_n") == n, F.col("_v"))).alias(n) for n in parts])


def fractional_study(c: DataFrame, orders: tuple = (0.2, 0.3, 0.4), threshold: float = 1e-2) -> DataFrame:
    """Moments of the fractional differences of some orders and of the plain returns, one row per symbol and series."""
    from .stats import moments

    parts = [moments(fractional_difference(c, d, threshold).where("frac_diff is not null"), "frac_diff").withColumn("series", F.lit(f"d={d}")) for d in orders]
    plain = moments(returns(c).where("pct_change is not null"), "pct_change").withColumn("series", F.lit("returns"))
    return reduce(DataFrame.unionByName, [*parts, plain])
