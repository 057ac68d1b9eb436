"""Further signals, features and windowed metrics on ticks, candles and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import dbl, ratio, trend
from ..plans.prefix import decayed_sum, previous
from .micro import with_bucket
from .series import over, returns, rolling, rsi, x, zscore


def ema_momentum(ticks: DataFrame, alpha: float = 0.1) -> DataFrame:
    """m_t = alpha * change_t + (1 - alpha) * m_{t-1} over each symbol's ticks: an affine scan by blocks."""
    d = previous(ticks, {"price": "_p"})
    change = ratio(F.col("price") - F.col("_p"), F.col("_p"), 0.0)
    return decayed_sum(d, change * alpha, 1 - alpha, "momentum").drop("_p")


def expanding_outliers(ticks: DataFrame, seconds: int = 86400, least: int = 20, limit: float = 2.0) -> DataFrame:
    """Trades whose size is over ``limit`` running population deviations from the window's running mean, from the
    first trade after ``least`` on; the trade itself is included in both."""
    w = W.partitionBy("symbol", "bucket").orderBy("ts", "trade_id").rowsBetween(W.unboundedPreceding, 0)
    d = with_bucket(ticks, seconds)
    q = F.col("quantity").cast("double")
    d = d.withColumn("_n", F.count("*").over(w)).withColumn("_m", F.avg(q).over(w)).withColumn("_s", F.stddev_pop(q).over(w))
    z = F.try_divide(q - F.col("_m"), F.when(F.col("_s") > 1e-9, F.col("_s")))
    return d.withColumn("zscore", dbl(z, 5)).where((F.col("_n") > least) & (F.abs(F.col("zscore")) > limit)).select("symbol", "bucket", "trade_id", "zscore")


def effective_spread(ticks: DataFrame, seconds: int = 86400, last: int = 5, least: int = 2) -> DataFrame:
    """Per window: mean, population deviation, minimum, maximum, median and volatility (deviation by mean) of the relative gap between the means of the last
    buys and the last sells, taken after every trade once both sides have ``least`` trades; gaps under 1e-4 don't count."""
    d = with_bucket(ticks, seconds)
    p = F.col("price").cast("double")
    side = W.partitionBy("symbol", "bucket", "is_buyer_maker").orderBy("ts", "trade_id").rowsBetween(-(last - 1), 0)
    d = d.withColumn("_m", F.when(F.count("*").over(side) >= least, F.avg(p).over(side)))
    run = W.partitionBy("symbol", "bucket").orderBy("ts", "trade_id").rowsBetween(W.unboundedPreceding, 0)
    hold = lambda cond: F.last(F.when(cond, F.col("_m")), ignorenulls=True).over(run)
    d = d.withColumn("_b", hold(~F.col("is_buyer_maker"))).withColumn("_s", hold(F.col("is_buyer_maker")))
    d = d.withColumn("spread", F.abs(F.col("_b") - F.col("_s")) / ((F.col("_b") + F.col("_s")) / 2)).where("spread >= 0.0001")
    return d.groupBy("symbol", "bucket").agg(F.count("*").alias("n"), dbl(F.avg("spread")).alias("mean"), dbl(F.stddev_pop("spread")).alias("std"), dbl(F.min("spread")).alias("min"), dbl(F.max("spread")).alias("max"), dbl(F.median("spread")).alias("median"), dbl(F.try_divide(F.stddev_pop("spread"), F.avg("spread")), 5).alias("volatility"))


def halves(ticks: DataFrame, seconds: int = 86400) -> DataFrame:
    """Mean size in the first and second half of a window's trades (the second is longer), change in %, label at 20."""
    d = with_bucket(ticks, seconds)
    w = W.partitionBy("symbol", "bucket")
    d = d.withColumn("_k", F.row_number().over(w.orderBy("ts", "trade_id"))).withColumn("_n", F.count("*").over(w))
    first, q = F.col("_k") <= F.floor(F.col("_n") / 2), F.col("quantity").cast("double")
    g = d.groupBy("symbol", "bucket").agg(F.avg(F.when(first, q)).alias("a"), F.avg(F.when(~first, q)).alias("z"))
    c = ratio(F.col("z") - F.col("a"), F.col("a")) * 100
    return g.select("symbol", "bucket", dbl("a").alias("first_half"), dbl("z").alias("second_half"), dbl(c).alias("change_pct"), F.when(c > 20, "accelerating").when(c < -20, "decelerating").otherwise("stable").alias("label"))


def price_movement(ticks: DataFrame, seconds: int = 86400) -> DataFrame:
    at, p = F.struct("ts", "trade_id"), F.col("price").cast("double")
    d = with_bucket(ticks, seconds).groupBy("symbol", "bucket").agg(F.min_by(p, at).alias("start"), F.max_by(p, at).alias("end"), dbl(F.stddev_pop(p)).alias("std"), dbl(F.max(p) - F.min(p)).alias("range"))
    c = ratio(F.col("end") - F.col("start"), F.col("start")) * 100
    return d.withColumn("change_pct", dbl(c)).withColumn("trend", trend(c))


def long_metrics(wide: DataFrame, names: list[str]) -> DataFrame:
    """(symbol, bucket, metric, value) of finite values only."""
    d = wide.select("symbol", "bucket", *[F.col(n).cast("double").alias(n) for n in names]).unpivot(["symbol", "bucket"], names, "metric", "value")
    return d.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")))


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Per metric and symbol: values, the latest one, and the hours they span."""
    hours = (F.unix_micros(F.max("bucket")) - F.unix_micros(F.min("bucket"))) / F.lit(3.6e9)
    return metrics.groupBy("symbol", "metric").agg(F.count("*").alias("n"), F.max_by("value", "bucket").alias("latest"), dbl(hours).alias("hours"))


def intensity_signals(b: DataFrame, n: int = 20) -> DataFrame:
    """Entry when trades, volume and close are all above their means and the close rises; exit under 0.7 of the mean."""
    ma = lambda c: rolling(F.avg(x(c)), n)
    d = b.withColumn("_t", ma("trades")).withColumn("_v", ma("volume")).withColumn("_c", ma("close"))
    enter = (x("trades") > F.col("_t")) & (x("volume") > F.col("_v")) & (x("close") > F.col("_c")) & (x("close") > F.lag(x("close")).over(over()))
    return d.withColumn("signal", F.when(x("trades") < 0.7 * F.col("_t"), "exit").when(enter, "entry")).drop("_t", "_v", "_c")


def indicator_table(c: DataFrame) -> DataFrame:
    return returns(rsi(zscore(c))).select("symbol", "bucket", "zscore", "rsi", dbl("pct_change").alias("pct_change"))


def busy_rows(b: DataFrame, column: str = "trades", share: float = 0.95) -> DataFrame:
    """Per symbol: rows above the percentile, their mean absolute move in % and mean volume."""
    q = b.groupBy("symbol").agg(F.percentile(x(column), F.lit(share)).alias("_q"))
    d = b.join(q, "symbol").where(x(column) > F.col("_q"))
    return d.groupBy("symbol").agg(F.count("*").alias("n"), dbl(F.avg(F.abs(ratio(x("close") - x("open"), x("open")) * 100))).alias("mean_move_pct"), dbl(F.avg(x("volume"))).alias("mean_volume"))


def liquidity_labels(b: DataFrame, n: int = 20) -> DataFrame:
    """Rows whose volume is under 0.5 or over 1.5 of the mean of the last n (partial frames allowed), counted."""
    s = F.try_divide(x("volume"), rolling(F.avg(x("volume")), n, full=False))
    d = b.withColumn("score", s).withColumn("label", F.when(F.col("score") < 0.5, "low").when(F.col("score") > 1.5, "high").otherwise("normal"))
    return d.groupBy("symbol", "label").agg(F.count("*").alias("n"), dbl(F.avg("score"), 5).alias("mean_score"))


def daily_last(equity: DataFrame, limit: float = -200.0) -> DataFrame:
    """Last value a day, its change on the day before times 10,000, and whether that is under the loss limit."""
    d = equity.groupBy("symbol", F.to_date("bucket").alias("day")).agg(F.max_by(x("close"), "bucket").alias("value"))
    p = F.lag("value").over(W.partitionBy("symbol").orderBy("day"))
    d = d.withColumn("pnl", dbl((ratio(F.col("value"), p) - 1) * 10_000, 4))
    return d.withColumn("breach", F.coalesce(F.col("pnl") < limit, F.lit(False)))


def movement_levels(ticks: DataFrame, seconds: int = 86400, alpha: float = 0.1) -> DataFrame:
    """Per window: the momentum after its last trade, and the level of its price deviation by mean: above 0.1 high,
    above 0.05 medium, else low."""
    d = with_bucket(ema_momentum(ticks, alpha), seconds)
    p = F.col("price").cast("double")
    g = d.groupBy("symbol", "bucket").agg(dbl(F.max_by("momentum", F.struct("ts", "trade_id"))).alias("momentum"), dbl(F.try_divide(F.stddev_pop(p), F.avg(p)), 5).alias("variation"))
    return g.withColumn("volatility_level", F.when(F.col("variation") > 0.1, "high").when(F.col("variation") > 0.05, "medium").otherwise("low"))


def buy_share(bars: DataFrame) -> DataFrame:
    """Adds buy_share: buys of all volume of a bar with side volumes."""
    return bars.withColumn("buy_share", dbl(ratio(F.col("buy_volume"), F.col("buy_volume") + F.col("sell_volume"))))


def liquidity_detail(b: DataFrame, n: int = 20, share: float = 0.95) -> DataFrame:
    """Per symbol: mean impact (absolute move by volume), volatility of the returns, and bars whose distance in time
    to the one before is over the percentile."""
    t = F.unix_micros("bucket") / F.lit(1e6)
    d = returns(b).withColumn("_gap", t - F.lag(t).over(over())).withColumn("_impact", F.try_divide(F.abs(x("close") - x("open")), x("volume")))
    q = d.groupBy("symbol").agg(F.percentile("_gap", F.lit(share)).alias("_q"))
    return d.join(q, "symbol").groupBy("symbol").agg(dbl(F.avg("_impact")).alias("mean_impact"), dbl(F.stddev_samp("pct_change"), 5).alias("volatility"), F.count_if(F.col("_gap") > F.col("_q")).alias("long_gaps"))


def vwap_deviation(c: DataFrame) -> DataFrame:
    """Adds (close - vwap) / vwap in %, for candles or bars with a vwap."""
    return c.withColumn("vwap_deviation", dbl(ratio(x("close") - x("vwap"), x("vwap")) * 100))
