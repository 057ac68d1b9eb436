"""Time bars, symbol statistics, profiles and other aggregates over ticks. All symbols run in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bucket_start, dbl, ratio, side
from .selection import exact_quantiles


def _at() -> Column:
    return F.struct("ts", "trade_id")


def sell() -> Column:
    return F.col("is_buyer_maker")


def buy() -> Column:
    return ~F.col("is_buyer_maker")


def sum_if(value: Column | str, cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(value) if isinstance(value, str) else value)), F.lit(0))


def ohlcv(ticks: DataFrame, interval: str) -> DataFrame:
    """(symbol, bucket, open, high, low, close, volume, trades): first and last by the total order."""
    return ticks.groupBy("symbol", bucket_start("ts", interval).alias("bucket")).agg(
        F.min_by("price", _at()).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", _at()).alias("close"),
        F.sum("quantity").alias("volume"), F.count("*").alias("trades"),
    )


def symbol_stats(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(
        F.count("*").alias("trade_count"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), dbl(F.avg("price")).alias("avg_price"), F.sum("quantity").alias("total_volume"),
        F.count_if(sell()).alias("sell_count"), F.count_if(buy()).alias("buy_count"), F.min("ts").alias("first_trade_time"), F.max("ts").alias("last_trade_time"),
    )


def derived_stats(stats: DataFrame) -> DataFrame:
    """Adds buy_sell_ratio, price_range, price_change_pct, net_flow and imbalance to symbol_stats()."""
    b, s = F.col("buy_count"), F.col("sell_count")
    return stats.select(
        "symbol", dbl(ratio(b, s)).alias("buy_sell_ratio"), (F.col("max_price") - F.col("min_price")).alias("price_range"),
        dbl(ratio(F.col("max_price") - F.col("min_price"), F.col("min_price")) * 100).alias("price_change_pct"), (b - s).alias("net_flow"), dbl(ratio(b - s, b + s)).alias("imbalance"),
    )


def volume_profile(ticks: DataFrame, bins: int = 50) -> DataFrame:
    """(symbol, bin, min/max/avg price, volume, trades); bins 0 to ``bins``, the maximum alone in the last one."""
    r = ticks.groupBy("symbol").agg(F.min("price").alias("_lo"), F.max("price").alias("_hi"))
    p = F.col("price").cast("double")
    d = ticks.join(r, "symbol").withColumn("bin", F.coalesce(F.floor(F.try_divide(p - F.col("_lo").cast("double"), (F.col("_hi") - F.col("_lo")).cast("double") / bins)), F.lit(0)).cast("long"))
    return d.groupBy("symbol", "bin").agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"), dbl(F.avg("price")).alias("avg_price"), F.sum("quantity").alias("volume"), F.count("*").alias("trades"))


def high_volume_nodes(profile: DataFrame, n: int = 5) -> DataFrame:
    """The n bins of all symbols with the most volume; ties by symbol and bin."""
    return profile.orderBy(F.desc("volume"), "symbol", "bin").limit(n)


def point_of_control(profile: DataFrame) -> DataFrame:
    """Per symbol the bin with the most volume, the lowest on ties."""
    return profile.groupBy("symbol").agg(F.max_by("bin", F.struct("volume", -F.col("bin"))).alias("poc_bin"), F.max("volume").alias("poc_volume"))


def table_summary(tables: dict[str, DataFrame], time_column: str = "ts") -> DataFrame:
    parts = [d.agg(F.lit(n).alias("table_name"), F.count("*").alias("records"), F.count_distinct("symbol").alias("symbols"), F.min(time_column).alias("first_time"), F.max(time_column).alias("last_time")) for n, d in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def list_data(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and symbol: count, time range, whole days and about 100 bytes a row."""
    parts = []
    for n, d in tables.items():
        s = F.col("symbol") if "symbol" in d.columns else F.lit(n)
        parts.append(d.groupBy(s.alias("symbol")).agg(F.count("*").alias("records"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time")).select(F.lit(n).alias("table_name"), "symbol", "records", "first_time", "last_time", F.datediff("last_time", "first_time").alias("days"), (F.col("records") * 100).alias("est_bytes")))
    return reduce(DataFrame.unionByName, parts)


def daily_summary(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol", "date").agg(F.count("*").alias("trades"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.sum("quantity").alias("volume"))


def hourly_change(ticks: DataFrame, newest: int = 24) -> DataFrame:
    """Open, close and change in percent by hour; the newest hours of each symbol."""
    from pyspark.sql import Window as W

    h = ticks.groupBy("symbol", F.date_trunc("hour", "ts").alias("hour")).agg(F.min_by("price", _at()).alias("open"), F.max_by("price", _at()).alias("close"))
    h = h.withColumn("change_pct", dbl(ratio(F.col("close") - F.col("open"), F.col("open")) * 100))
    return h.withColumn("_rn", F.row_number().over(W.partitionBy("symbol").orderBy(F.desc("hour")))).where(F.col("_rn") <= newest).drop("_rn")


def pressure_summary(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(F.count_if(sell()).alias("sells"), F.count_if(buy()).alias("buys"), F.round(ratio(F.count_if(buy()), F.count("*")) * 100, 2).alias("buy_pct"))


def progress(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(F.count("*").alias("trades"), F.max("ts").alias("latest"), F.max_by("trade_id", _at()).alias("latest_id"))


def streaming_stats(ticks: DataFrame) -> DataFrame:
    """One row per symbol of a window of ticks: sample deviation, side counts and volumes, ratios (null without sells), vwap."""
    q = F.col("quantity")
    return ticks.groupBy("symbol").agg(
        F.count("*").alias("trades"), F.sum("quantity").alias("volume"), dbl(F.avg("price")).alias("mean_price"), dbl(F.stddev_samp(F.col("price").cast("double"))).alias("std_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"), (F.max("price") - F.min("price")).alias("price_range"),
        F.count_if(buy()).alias("buys"), F.count_if(sell()).alias("sells"), sum_if(q, buy()).alias("buy_volume"), sum_if(q, sell()).alias("sell_volume"),
        dbl(ratio(F.count_if(buy()), F.count_if(sell()))).alias("count_ratio"), dbl(ratio(sum_if(q, buy()), sum_if(q, sell()))).alias("volume_ratio"), dbl(vwap()).alias("vwap"),
    )


def vwap() -> Column:
    return ratio(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity"))


def side_summary(ticks: DataFrame) -> DataFrame:
    d = F.col("price") * F.col("quantity")
    return ticks.groupBy("symbol", side().alias("side")).agg(
        F.count("*").alias("trades"), F.sum("quantity").alias("volume"), dbl(F.avg("quantity")).alias("mean_quantity"), dbl(F.sum(d), 4).alias("dollars"), dbl(F.avg(d.cast("double"))).alias("mean_dollars"),
        dbl(F.avg("price")).alias("mean_price"), dbl(F.stddev_samp(F.col("price").cast("double"))).alias("std_price"),
    )


def dollar_imbalance() -> Column:
    d = F.col("price") * F.col("quantity")
    return ratio(sum_if(d, buy()) - sum_if(d, sell()), F.sum(d))


def order_flow_windows(ticks: DataFrame, interval: str = "5m") -> DataFrame:
    q, d = F.col("quantity"), F.col("price") * F.col("quantity")
    return ticks.groupBy("symbol", bucket_start("ts", interval).alias("bucket")).agg(
        F.count_if(buy()).alias("buys"), F.count_if(sell()).alias("sells"), sum_if(q, buy()).alias("buy_volume"), sum_if(q, sell()).alias("sell_volume"),
        dbl(sum_if(d, buy()), 4).alias("buy_dollars"), dbl(sum_if(d, sell()), 4).alias("sell_dollars"), dbl(vwap()).alias("vwap"),
        dbl(ratio(sum_if(q, buy()) - sum_if(q, sell()), F.sum(q))).alias("order_imbalance"), dbl(ratio(F.count_if(buy()) - F.count_if(sell()), F.count("*"))).alias("trade_imbalance"), dbl(dollar_imbalance()).alias("dollar_imbalance"),
    )


def liquidity_windows(ticks: DataFrame, interval: str = "5m") -> DataFrame:
    """Trades, mean size, deviation, range, mean price and trades / (deviation, 1 if null, + 1e-6)."""
    std = F.stddev_samp(F.col("price").cast("double"))
    return ticks.groupBy("symbol", bucket_start("ts", interval).alias("bucket")).agg(
        F.count("*").alias("trades"), dbl(F.avg("quantity")).alias("mean_size"), dbl(std).alias("price_std"), (F.max("price") - F.min("price")).alias("price_range"), dbl(F.avg("price")).alias("mean_price"),
        dbl(F.count("*") / (F.coalesce(std, F.lit(1.0)) + F.lit(1e-6)), 4).alias("liquidity"),
    )


def price_tracker(ticks: DataFrame) -> DataFrame:
    o, c = F.min_by("price", _at()), F.max_by("price", _at())
    return ticks.groupBy("symbol").agg(c.alias("last"), o.alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), dbl(ratio(c - o, o) * 100).alias("change_pct"))


def price_alert(ticks: DataFrame, target: float) -> DataFrame:
    last = F.max_by("price", _at())
    return ticks.groupBy("symbol").agg(last.alias("last"), (last > target).alias("above"), ((F.min("price") <= target) & (F.max("price") >= target)).alias("touched"), dbl((last.cast("double") - target) / F.lit(target) * 100).alias("distance_pct"))


def multi_timeframe_trend(ticks: DataFrame, intervals: tuple = ("1h", "4h", "1d")) -> DataFrame:
    parts = []
    for i in intervals:
        b = ohlcv(ticks, i)
        change = ratio(F.max_by("close", "bucket"), F.min_by("open", "bucket")) * 100 - 100
        parts.append(b.groupBy("symbol").agg(F.lit(i).alias("interval"), dbl(change, 4).alias("change_pct"), F.when(change > 0, "bullish").otherwise("bearish").alias("trend")))
    return reduce(DataFrame.unionByName, parts)


def data_density(ticks: DataFrame) -> DataFrame:
    """Records per hour between the first and the last tick."""
    hours = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(3.6e9)
    return ticks.groupBy("symbol").agg(F.count("*").alias("records"), dbl(ratio(F.count("*"), hours), 4).alias("per_hour"))


def describe(df: DataFrame, column: str, key: str = "symbol") -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles with linear interpolation, maximum."""
    x = F.col(column).cast("double")
    d = df.groupBy(key).agg(F.count(x).alias("n"), dbl(F.avg(x)).alias("mean"), dbl(F.stddev_samp(x)).alias("std"), dbl(F.min(x)).alias("min"), dbl(F.max(x)).alias("max"))
    at = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    return _with_quantiles(d, df, column, key, at).select(key, "n", "mean", "std", "min", *at, "max")


def series_stats(df: DataFrame, column: str, key: str = "symbol") -> DataFrame:
    """Count, mean, population deviation, extremes, sum and exact quartiles."""
    x = F.col(column).cast("double")
    d = df.groupBy(key).agg(F.count(x).alias("n"), dbl(F.avg(x)).alias("mean"), dbl(F.stddev_pop(x)).alias("std_pop"), dbl(F.min(x)).alias("min"), dbl(F.max(x)).alias("max"), dbl(F.sum(x), 4).alias("sum"))
    return _with_quantiles(d, df, column, key, {"median": 0.5, "p25": 0.25, "p75": 0.75})


def _with_quantiles(stats: DataFrame, df: DataFrame, column: str, key: str, at: dict[str, float]) -> DataFrame:
    q = exact_quantiles(df, column, at, (key,)).select(F.col(key).alias("_k"), *[dbl(n).alias(n) for n in at])
    return stats.join(q, stats[key].eqNullSafe(q["_k"]), "left").drop("_k")


def correlations(df: DataFrame, columns: list[str], key: str = "symbol") -> DataFrame:
    """(key, a, b, corr) of every pair, a before b in the list; all in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    d = df.groupBy(key).agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), dbl(F.col(f"`{a}|{b}`"), 5).alias("corr")) for a, b in pairs]))
    return d.select(key, rows.alias("x")).select(key, "x.*")


def moments(df: DataFrame, column: str, key: str = "symbol") -> DataFrame:
    """Mean, sample deviation, bias-corrected skewness and excess kurtosis; null below 3 and 4 values."""
    x = F.col(column).cast("double")
    n = F.count(x).cast("double")
    g1, g2 = F.skewness(x), F.kurtosis(x)
    skew = F.when((n > 2) & (F.stddev_pop(x) > 0), g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when((n > 3) & (F.stddev_pop(x) > 0), ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return df.groupBy(key).agg(F.count(x).alias("n"), dbl(F.avg(x)).alias("mean"), dbl(F.stddev_samp(x)).alias("std"), dbl(skew, 5).alias("skew"), dbl(kurt, 4).alias("kurtosis"))


def jarque_bera(df: DataFrame, column: str, key: str = "symbol") -> DataFrame:
    """The statistic and its chi-squared p-value with two degrees of freedom."""
    x = F.col(column).cast("double")
    jb = F.count(x) / F.lit(6.0) * (F.pow(F.skewness(x), F.lit(2.0)) + F.pow(F.kurtosis(x), F.lit(2.0)) / 4)
    return df.groupBy(key).agg(F.count(x).alias("n"), dbl(jb, 3).alias("jb"), dbl(F.exp(-jb / 2), 5).alias("p_value"))


def dagostino(df: DataFrame, column: str, key: str = "symbol") -> DataFrame:
    """D'Agostino and Pearson's K2 of skewness and kurtosis and its p-value, by the published normal transforms."""
    x = F.col(column).cast("double")
    d = df.groupBy(key).agg(F.count(x).cast("double").alias("n"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))
    n = F.col("n")
    y = F.col("g1") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    delta, alpha = 1 / F.sqrt(0.5 * F.log(w2)), F.sqrt(2 / (w2 - 1))
    z1 = delta * F.log(y / alpha + F.sqrt((y / alpha) * (y / alpha) + 1))
    mean, var = 3 * (n - 1) / (n + 1) - 3, 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    u = (F.col("g2") - mean) / F.sqrt(var)
    beta = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / beta * (2 / beta + F.sqrt(1 + 4 / (beta * beta)))
    t = (1 - 2 / a) / (1 + u * F.sqrt(2 / (a - 4)))
    z2 = (1 - 2 / (9 * a) - F.signum(t) * F.pow(F.abs(t), F.lit(1 / 3))) / F.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return d.select(key, n.cast("long").alias("n"), dbl(k2, 3).alias("k2"), dbl(F.exp(-k2 / 2), 5).alias("p_value"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    c = df.groupBy(column).agg(F.count("*").alias("n"))
    # The total is one row.
    total = c.agg(F.sum("n").alias("_total")).withColumn("_one", F.lit(1))
    d = c.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return d.select(column, "n", dbl(F.col("n") * 100 / F.col("_total")).alias("pct"))


def chunk_counts(ticks: DataFrame, interval: str = "1h") -> DataFrame:
    return ticks.groupBy("symbol", bucket_start("ts", interval).alias("bucket")).agg(F.count("*").alias("n"))


def null_and_duplicate_counts(ticks: DataFrame) -> DataFrame:
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("price", "quantity", "ts")]
    return ticks.agg(F.count("*").alias("records"), *nulls, (F.count("*") - F.count_distinct("symbol", "trade_id")).alias("duplicate_ids"))


def table_info(df: DataFrame, time_column: str) -> DataFrame:
    """One row per column: its name and type, with the table's rows and time range."""
    s = df.agg(F.count("*").alias("records"), F.min(time_column).alias("first_time"), F.max(time_column).alias("last_time"))
    cols = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("column_type")) for n, t in df.dtypes]))
    return s.select(cols.alias("c"), "records", "first_time", "last_time").select("c.*", "records", "first_time", "last_time")
