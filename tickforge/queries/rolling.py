"""Queries on values over the last rows or seconds of a symbol, and joins of all ticks with all ticks in time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..operators import micro as M
from ..operators import rolling as L
from ..operators import series as R
from ..registry import query
from ..schema import ticks
from .quality import _win

_O = "(PARTITION BY symbol ORDER BY ts, trade_id"

_PANES = """, e AS (SELECT TIMESTAMP '2024-01-20 12:00:00' AS e), w AS (SELECT t.*, {x} AS p, s FROM t, e, (SELECT unnest([{sizes}]) AS s) WHERE ts <= e AND epoch_us(ts) >= epoch_us(e) - s * 1000000::BIGINT),
 k AS (SELECT *, row_number() OVER (PARTITION BY symbol, s ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol, s ORDER BY ts DESC, trade_id DESC) AS z FROM w),
 g AS (SELECT symbol, CAST(s AS INTEGER) AS window_s, count(*) AS n, avg(p) AS mean, stddev_pop(p) AS std, min(p) AS min, max(p) AS max, quantile_cont(p, 0.5) AS median, quantile_cont(p, 0.25) AS p25, quantile_cont(p, 0.75) AS p75, quantile_cont(p, 0.95) AS p95,
   max(CASE WHEN a = 1 THEN p END) AS first, max(CASE WHEN z = 1 THEN p END) AS last FROM k GROUP BY symbol, s)
SELECT symbol, window_s, n, round(mean, 6) AS mean, round(std, 6) AS std, min, max, round(median, 6) AS median, round(p25, 6) AS p25, round(p75, 6) AS p75, round(p95, 6) AS p95, round(max - min, 6) AS range, first, last, round(last - first, 6) AS change, round((last - first) / nullif(first, 0) * 100, 6) AS change_pct FROM g"""


@query("mic15_pane_statistics", _PANES.format(x="CAST(cents AS DOUBLE) / 100", sizes="1800, 7200, 43200, 259200"))
def mic15(spark, d):
    return L.trailing_statistics(ticks(spark, d), datetime(2024, 1, 20, 12), "price", (1800, 7200, 43_200, 259_200))


@query("mic15_pane_sizes", _PANES.format(x="CAST(q AS DOUBLE)", sizes="3600, 5400, 86400"))
def mic15_sizes(spark, d):
    return L.trailing_statistics(ticks(spark, d), datetime(2024, 1, 20, 12), "quantity", (3600, 5400, 86_400))


@query("mic11_burst_rates", _win(86400) + """, s AS (SELECT symbol, bucket, date_trunc('hour', ts) AS h, CAST(sum(q) AS DOUBLE) AS v FROM w GROUP BY 1, 2, 3),
 m AS (SELECT *, avg(v) OVER (PARTITION BY symbol, bucket) AS mu, stddev_pop(v) OVER (PARTITION BY symbol, bucket) AS sd, row_number() OVER (PARTITION BY symbol, bucket ORDER BY h) AS k, count(*) OVER (PARTITION BY symbol, bucket) AS n FROM s)
SELECT symbol, bucket, round(CAST(count(*) FILTER (WHERE v > mu + 2 * sd) AS DOUBLE) / count(*), 6) AS burst_rate, round(avg(v) FILTER (WHERE k <= n // 2), 6) AS first_half, round(avg(v) FILTER (WHERE k > n // 2), 6) AS second_half FROM m GROUP BY symbol, bucket""")
def mic11(spark, d):
    return M.volume_clusters(ticks(spark, d)).select("symbol", "bucket", "burst_rate", "first_half", "second_half")


@query("mic13_window_moves", _win(86400) + """, r AS (SELECT *, cents / 100.0 / lag(cents / 100.0) OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) - 1 AS r FROM w)
SELECT symbol, bucket, count(*) AS trades, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap, round(stddev_pop(r), 6) AS volatility FROM r GROUP BY symbol, bucket""")
def mic13(spark, d):
    return M.momentum(ticks(spark, d)).select("symbol", "bucket", "trades", "vwap", "volatility")


@query("mic18_price_impact", f""", y AS (SELECT *, CAST(CASE WHEN is_buyer_maker THEN -q ELSE q END AS DOUBLE) AS x, cents / 100.0 - lag(cents / 100.0) OVER {_O}) AS y FROM t),
 r AS (SELECT *, regr_slope(y, x) OVER {_O} ROWS 49 PRECEDING) AS b, regr_r2(y, x) OVER {_O} ROWS 49 PRECEDING) AS r2, count(y) OVER {_O} ROWS 49 PRECEDING) AS n FROM y)
SELECT symbol, trade_id, round(CASE WHEN n = 50 THEN b END, 6) AS impact, round(CASE WHEN n = 50 THEN r2 END, 6) AS r_squared FROM r""")
def mic18(spark, d):
    i = L.price_impact(ticks(spark, d), 50, rows=128)
    return i.select("symbol", "trade_id", dbl("impact").alias("impact"), dbl("r_squared").alias("r_squared"))


@query("mic18_impact_decay", ", l AS (SELECT symbol, k AS lag, CASE WHEN lag(is_buyer_maker, k) OVER w THEN -1 ELSE 1 END * (cents - lag(cents, k) OVER w) / 100.0 AS m FROM t, (SELECT unnest(range(1, 11)) AS k) WINDOW w AS (PARTITION BY symbol, k ORDER BY ts, trade_id)) SELECT symbol, CAST(lag AS INTEGER) AS lag, count(m) AS n, round(avg(m), 6) AS mean_move FROM l WHERE m IS NOT NULL GROUP BY symbol, lag")
def mic18_decay(spark, d):
    return L.impact_decay(ticks(spark, d), 10, rows=128)


@query("mic19_trade_intensity", f""", k AS (SELECT symbol, trade_id, epoch_us(ts) / 1000000.0 AS s, row_number() OVER {_O}) AS i FROM t),
 y AS (SELECT a.symbol, a.trade_id, a.i, sum(exp(-(a.s - b.s) / 3600.0)) / 3600.0 AS y FROM k a JOIN k b ON a.symbol = b.symbol AND b.i <= a.i GROUP BY 1, 2, 3),
 z AS (SELECT *, CASE WHEN count(y) OVER w = 40 AND stddev_pop(y) OVER w > 1e-12 THEN (y - avg(y) OVER w) / stddev_pop(y) OVER w END AS z FROM y WINDOW w AS (PARTITION BY symbol ORDER BY i ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING))
SELECT symbol, trade_id, round(y, 8) AS intensity, round(z, 4) AS intensity_z, coalesce(round(z, 4) > 3, false) AS burst FROM z""")
def mic19(spark, d):
    i = L.trade_intensity(ticks(spark, d), 3600.0, 40, rows=128)
    z = dbl("intensity_z", 4)
    return i.select("symbol", "trade_id", dbl("intensity", 8).alias("intensity"), z.alias("intensity_z"), F.coalesce(z > 3, F.lit(False)).alias("burst"))


@query("mic17_replayed_windows", """, k AS (SELECT symbol, ts, cents, q, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i FROM t),
 b AS (SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, ts, cents, q, i, CAST(0 AS BIGINT) AS window_id, ts AS opened FROM k WHERE i = 1
   UNION ALL SELECT k.symbol, k.ts, k.cents, k.q, k.i, s.window_id + CASE WHEN k.ts >= s.opened + INTERVAL 1 HOUR THEN 1 ELSE 0 END, CASE WHEN k.ts >= s.opened + INTERVAL 1 HOUR THEN k.ts ELSE s.opened END FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1) SELECT * FROM s))
SELECT symbol, window_id, min(ts) AS window_start, max(ts) AS window_last, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap FROM b GROUP BY symbol, window_id""")
def mic17(spark, d):
    return L.replay(ticks(spark, d), 3600, M.volume_metrics(), per_block=8).drop("delta", "delta_pct")


@query("jn02_asof_all", """ SELECT p.symbol, p.trade_id, f.ts AS fact_ts, f.price AS fact_price FROM (SELECT symbol, trade_id, ts FROM t) p ASOF LEFT JOIN (SELECT symbol, ts + INTERVAL 1 MINUTE AS at, max(ts) AS ts, arg_max(price, trade_id) AS price FROM t GROUP BY symbol, ts) f ON p.symbol = f.symbol AND p.ts >= f.at""")
def jn02_all(spark, d):
    """For every tick the newest one of its symbol that is a minute older at least, over all ticks."""
    t = ticks(spark, d)
    facts = t.groupBy("symbol", "ts").agg(F.max_by("price", "trade_id").alias("fact_price"))
    facts = facts.select("symbol", (F.col("ts") + F.expr("interval 1 minute")).alias("ts"), "fact_price", F.col("ts").alias("at"))
    a = R.asof_backward(t.select("symbol", "ts", "trade_id"), facts, ["fact_price", "at"])
    return a.select("symbol", "trade_id", F.col("at").alias("fact_ts"), "fact_price")


@query("jn09_band_all", "SELECT a.trade_id, count(*) AS near, min(b.trade_id) AS least_id, max(b.trade_id) AS largest_id FROM t a JOIN t b ON a.symbol = b.symbol AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 300000000 GROUP BY a.trade_id")
def jn09_all(spark, d):
    """All ticks within five minutes of each tick, counted."""
    t = ticks(spark, d).select("symbol", "ts", "trade_id")
    return R.time_band_join(t, t, 300).groupBy("trade_id").agg(F.count("*").alias("near"), F.min("r_trade_id").alias("least_id"), F.max("r_trade_id").alias("largest_id"))
