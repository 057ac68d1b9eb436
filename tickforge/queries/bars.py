"""Queries on event-driven bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..operators import bars as B
from ..registry import query
from ..schema import table, ticks, ticks_from_lineitem


def _bars_sql(measure: str, threshold: int) -> str:
    return f""", c AS (SELECT *, sum({measure}) OVER (PARTITION BY symbol ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING) // {threshold} AS bar FROM t),
 o AS (SELECT *, row_number() OVER (PARTITION BY symbol, bar ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol, bar ORDER BY ts DESC, trade_id DESC) AS z FROM c),
 b AS (SELECT symbol, CAST(bar AS BIGINT) AS bar_id, min(ts) AS t0, max(ts) AS t1, max(CASE WHEN a = 1 THEN price END) AS open, max(price) AS high, min(price) AS low, max(CASE WHEN z = 1 THEN price END) AS close,
  CAST(sum(q) AS DOUBLE) AS volume, sum(cents * q) / 100.0 AS dollar_volume, count(*) AS tick_count, round(stddev_samp(cents / 100.0), 6) AS price_std,
  CAST(coalesce(sum(q) FILTER (WHERE NOT is_buyer_maker), 0) AS DOUBLE) AS buy_volume, CAST(coalesce(sum(q) FILTER (WHERE is_buyer_maker), 0) AS DOUBLE) AS sell_volume FROM o GROUP BY symbol, bar),
 d AS (SELECT *, (epoch_us(t1) - epoch_us(t0)) / 1000000.0 AS secs FROM b)
SELECT symbol, bar_id, t0 AS timestamp, t1 AS timestamp_close, open, high, low, close, volume, round(dollar_volume, 4) AS dollar_volume, tick_count, price_std, buy_volume, sell_volume, close - open AS price_change,
 round(dollar_volume / volume, 6) AS vwap, round(secs, 6) AS duration_seconds, round(tick_count / CASE WHEN secs = 0 THEN 1.0 ELSE secs END, 6) AS ticks_per_second,
 round(dollar_volume / CASE WHEN secs = 0 THEN 1.0 ELSE secs END, 4) AS dollar_volume_per_second,
 round((epoch_us(t0) - epoch_us(lag(t0) OVER (PARTITION BY symbol ORDER BY bar_id))) / 1000000.0, 6) AS time_since_last_bar FROM d"""


def _out(bars):
    return bars.withColumns({"volume": F.col("volume").cast("double"), "dollar_volume": dbl("dollar_volume", 4), "buy_volume": F.col("buy_volume").cast("double"), "sell_volume": F.col("sell_volume").cast("double")})


@query("bar02_dollar_bars", _bars_sql("cents * q", 1_000_000))
def bar02(spark, d):
    return _out(B.dollar_bars(ticks(spark, d), 10_000))


@query("bar01_dollar_bars_basic", _bars_sql("cents * q", 250_000).rsplit("SELECT symbol, bar_id", 1)[0] + "SELECT symbol, bar_id, open, high, low, close, tick_count, price_std FROM d")
def bar01(spark, d):
    return B.dollar_bars(ticks(spark, d), 2_500).select("symbol", "bar_id", "open", "high", "low", "close", "tick_count", "price_std")


@query("bar08_volume_bars", _bars_sql("q", 500))
def bar08(spark, d):
    return _out(B.volume_bars(ticks(spark, d), 500))


@query("bar09_tick_bars", _bars_sql("1", 25))
def bar09(spark, d):
    return _out(B.tick_bars(ticks(spark, d), 25))


@query("bar03_auto_threshold", "SELECT symbol, round(avg(cents * q) / 100 * 50, 6) AS threshold FROM t GROUP BY symbol")
def bar03(spark, d):
    return B.auto_threshold(ticks(spark, d), 50)


@query("bar04_optimal_threshold", "SELECT symbol, round(sum(cents * q) / 100.0 / 100, 6) AS threshold FROM t GROUP BY symbol")
def bar04(spark, d):
    return B.optimal_threshold(ticks(spark, d), target_bars=100)


@query("bar04_optimal_threshold_per_day", "SELECT symbol, round(sum(cents * q) / 100.0 / floor(5.0 * ((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0)), 6) AS threshold FROM t GROUP BY symbol")
def bar04_day(spark, d):
    return B.optimal_threshold(ticks(spark, d), target_bars_per_day=5.0)


#: Adaptive bars tick by tick: l holds the sizes of the last 20 bars, lim the threshold of the open one.
ADAPTIVE_SQL = """, k AS (SELECT symbol, ts, cents, q, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i FROM t),
 z AS (SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, ts, cents, q, i, CAST(0 AS BIGINT) AS bar_id, CAST(cents * q AS BIGINT) AS acc, CAST([] AS DOUBLE[]) AS l, CAST(5000 AS DOUBLE) AS lim, cents * q / 100.0 >= 5000 AS done FROM k WHERE i = 1
   UNION ALL SELECT symbol, ts, cents, q, i, bar_id, acc, l, lim, acc / 100.0 >= lim FROM (
     SELECT *, CASE WHEN was AND len(l) >= 5 THEN list_sum(list_transform(l, lambda v, j: v * exp((j - len(l)) / CAST(len(l) - 1 AS DOUBLE)))) / list_sum(list_transform(l, lambda v, j: exp((j - len(l)) / CAST(len(l) - 1 AS DOUBLE)))) ELSE lim0 END AS lim FROM (
       SELECT k.symbol, k.ts, k.cents, k.q, k.i, s.bar_id + CASE WHEN s.done THEN 1 ELSE 0 END AS bar_id, CAST(CASE WHEN s.done THEN 0 ELSE s.acc END + k.cents * k.q AS BIGINT) AS acc, s.done AS was, s.lim AS lim0,
         CASE WHEN s.done THEN list_append(s.l, s.acc / 100.0)[-20:] ELSE s.l END AS l FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1))) SELECT * FROM s)),
 n AS (SELECT *, row_number() OVER (PARTITION BY symbol, bar_id ORDER BY i) AS a, row_number() OVER (PARTITION BY symbol, bar_id ORDER BY i DESC) AS z FROM z),
 d AS (SELECT symbol, bar_id, min(ts) AS t0, max(ts) AS t1, max(CASE WHEN a = 1 THEN cents END) / 100.0 AS open, max(cents) / 100.0 AS high, min(cents) / 100.0 AS low, max(CASE WHEN z = 1 THEN cents END) / 100.0 AS close, CAST(sum(q) AS DOUBLE) AS volume,
   sum(cents * q) / 100.0 AS dollar_volume, count(*) AS tick_count, stddev_samp(cents / 100.0) AS price_std, max(lim) AS threshold_used, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS secs FROM n GROUP BY symbol, bar_id HAVING bool_or(done))
"""


@query("bar05_adaptive_bars", ADAPTIVE_SQL + """SELECT symbol, bar_id, t0 AS timestamp, t1 AS timestamp_close, open, high, low, close, volume, round(dollar_volume, 4) AS dollar_volume, tick_count, round(dollar_volume / volume, 6) AS vwap, round(price_std, 6) AS price_std, round(close - open, 6) AS price_change,
 round(secs, 6) AS duration_seconds, round(tick_count / greatest(secs, 1.0), 6) AS ticks_per_second, round(dollar_volume / greatest(secs, 1.0), 4) AS dollar_volume_per_second, round((epoch_us(t0) - epoch_us(lag(t0) OVER (PARTITION BY symbol ORDER BY bar_id))) / 1000000.0, 6) AS time_since_last_bar, round(threshold_used, 4) AS threshold_used FROM d""")
def bar05(spark, d):
    b = B.adaptive_bars(ticks(spark, d), 5_000.0)
    tidy = {c: dbl(F.nanvl(c, F.lit(None).cast("double")), 4 if c in ("dollar_volume", "dollar_volume_per_second", "threshold_used") else 6) for c in ("dollar_volume", "vwap", "price_std", "price_change", "duration_seconds", "ticks_per_second", "dollar_volume_per_second", "time_since_last_bar", "threshold_used")}
    return b.withColumns(tidy)


#: Bars that close on the crossing tick, tick by tick in cents; the shape of what comes out of both forms.
RESET_SQL = """, k AS (SELECT symbol, ts, cents, q, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i FROM t),
 b AS (SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, ts, cents, q, i, CAST(0 AS BIGINT) AS bar_id, CAST(cents * q AS BIGINT) AS acc FROM k WHERE i = 1
   UNION ALL SELECT k.symbol, k.ts, k.cents, k.q, k.i, s.bar_id + CASE WHEN s.acc >= 500000 THEN 1 ELSE 0 END, CAST(CASE WHEN s.acc >= 500000 THEN 0 ELSE s.acc END + k.cents * k.q AS BIGINT) FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1) SELECT * FROM s)),
 n AS (SELECT *, row_number() OVER (PARTITION BY symbol, bar_id ORDER BY i) AS a, row_number() OVER (PARTITION BY symbol, bar_id ORDER BY i DESC) AS z FROM b)
SELECT symbol, bar_id, min(ts) AS timestamp, max(CASE WHEN a = 1 THEN cents END) / 100.0 AS open, max(cents) / 100.0 AS high, min(cents) / 100.0 AS low, max(CASE WHEN z = 1 THEN cents END) / 100.0 AS close, round(CAST(sum(q) AS DOUBLE), 6) AS volume, round(sum(cents * q) / 100.0, 4) AS dollar_volume, count(*) AS tick_count FROM n GROUP BY symbol, bar_id"""


def reset_columns(b):
    return b.select("symbol", "bar_id", "timestamp", "open", "high", "low", "close", dbl("volume").alias("volume"), dbl("dollar_volume", 4).alias("dollar_volume"), "tick_count")


@query("bar06_reset_bars", RESET_SQL)
def bar06(spark, d):
    return reset_columns(B.reset_bars(ticks(spark, d), 5_000.0))


STATS_SQL = """, r AS (SELECT *, CAST(close AS DOUBLE) / CAST(lag(close) OVER (PARTITION BY symbol ORDER BY bar_id) AS DOUBLE) - 1 AS r FROM d)
SELECT symbol, count(*) AS n_bars, round(avg(tick_count), 6) AS mean_ticks, round(stddev_samp(tick_count), 6) AS std_ticks, round(avg(volume), 6) AS mean_volume, round(avg(dollar_volume), 4) AS mean_dollars,
 round(avg(r), 6) AS mean_return, round(stddev_samp(r), 6) AS std_return, round(skewness(r), 4) AS skew_return, round(kurtosis(r), 3) AS kurtosis_return FROM r GROUP BY symbol"""
HEAD_SQL = _bars_sql("cents * q", 1_000_000).rsplit("\nSELECT symbol, bar_id, t0", 1)[0]


@query("bar10_bar_statistics", HEAD_SQL + STATS_SQL)
def bar10(spark, d):
    return B.bar_statistics(B.dollar_bars(ticks(spark, d), 10_000))


_FIXED = """, x AS (SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, cents, q, i, CAST(0 AS BIGINT) AS bar_id, CAST(cents * q AS BIGINT) AS acc FROM k WHERE i = 1
   UNION ALL SELECT k.symbol, k.cents, k.q, k.i, s.bar_id + CASE WHEN s.acc >= 500000 THEN 1 ELSE 0 END, CAST(CASE WHEN s.acc >= 500000 THEN 0 ELSE s.acc END + k.cents * k.q AS BIGINT) FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1) SELECT * FROM s)),
 f AS (SELECT symbol, bar_id, count(*) AS tick_count FROM x GROUP BY symbol, bar_id HAVING sum(cents * q) >= 500000)
"""


@query("bar12_adaptive_stability", ADAPTIVE_SQL.rstrip() + _FIXED + """SELECT symbol, 'fixed' AS kind, count(*) AS n, round(stddev_samp(tick_count), 6) AS std_ticks FROM f GROUP BY symbol UNION ALL SELECT symbol, 'adaptive', count(*), round(stddev_samp(tick_count), 6) FROM d GROUP BY symbol""")
def bar12(spark, d):
    t = ticks(spark, d)
    kinds = [("fixed", B.reset_bars(t, 5_000.0, keep_tail=False)), ("adaptive", B.adaptive_bars(t, 5_000.0))]
    a, b = (x.groupBy("symbol").agg(F.lit(k).alias("kind"), F.count("*").alias("n"), dbl(F.stddev_samp("tick_count")).alias("std_ticks")) for k, x in kinds)
    return a.unionByName(b)


@query("bar13_bars_by_symbol_threshold", _bars_sql("cents * q", 1).replace("// 1 AS bar", "// CASE symbol WHEN 'click' THEN 500000 WHEN 'view' THEN 2000000 ELSE 1000000 END AS bar").rsplit("SELECT symbol, bar_id", 1)[0] + "SELECT symbol, bar_id, open, high, low, close, tick_count FROM d")
def bar13(spark, d):
    own = spark.createDataFrame([("click", 5_000), ("view", 20_000), ("default", 10_000)], "symbol string, threshold long").withColumn("threshold", F.col("threshold").cast("decimal(38,0)"))
    return B.dollar_bars(ticks(spark, d), own).select("symbol", "bar_id", "open", "high", "low", "close", "tick_count")


@query("bar14_validate_ticks", "SELECT count(*) AS records, CAST(0 AS BIGINT) AS null_price, CAST(0 AS BIGINT) AS null_quantity, count(*) FILTER (WHERE price <= 0) AS bad_price, count(*) FILTER (WHERE quantity < 0) AS bad_quantity, count(*) > 0 AS valid FROM t")
def bar14(spark, d):
    return B.validate_ticks(ticks(spark, d))


@query("bar_lineitem_dollar_bars", """WITH c AS (SELECT l_returnflag AS symbol, CAST(round(l_extendedprice * 100) AS BIGINT) AS m,
 sum(CAST(round(l_extendedprice * 100) AS BIGINT)) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS s FROM lineitem)
SELECT symbol, CAST(s // 1000000000 AS BIGINT) AS bar_id, count(*) AS tick_count, CAST(sum(m) AS BIGINT) AS cents FROM c GROUP BY 1, 2""", raw=True)
def bar_lineitem(spark, d):
    t = ticks_from_lineitem(table(spark, d, "lineitem"))
    b = B.floor_bars(t, F.col("notional_cents"), 1_000_000_000)
    return b.groupBy("symbol", "bar_id").agg(F.count("*").alias("tick_count"), F.sum("notional_cents").alias("cents"))
