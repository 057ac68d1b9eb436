"""Queries on further signals, features and windowed metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..operators import bars as B
from ..operators import micro as M
from ..operators import series as R
from ..operators import stats as S
from ..operators import strategy as G
from ..registry import query
from ..schema import ticks
from ..streaming import streams
from .bars import HEAD_SQL, STATS_SQL
from .quality import _win
from .series import _C, _R, _W, _roll


def candles(spark, d):
    return S.ohlcv(ticks(spark, d), "4h")


@query("win18_ema_momentum", """, k AS (SELECT symbol, trade_id, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i, (cents - lag(cents) OVER (PARTITION BY symbol ORDER BY ts, trade_id)) / CAST(lag(cents) OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS DOUBLE) AS ch FROM t)
SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, trade_id, i, CAST(0.0 AS DOUBLE) AS m FROM k WHERE i = 1 UNION ALL SELECT k.symbol, k.trade_id, k.i, 0.1 * coalesce(k.ch, 0) + 0.9 * s.m FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1) SELECT symbol, trade_id, round(m, 6) AS momentum FROM s)""")
def win18(spark, d):
    return G.ema_momentum(ticks(spark, d)).select("symbol", "trade_id", dbl("momentum").alias("momentum"))


@query("win21_expanding_outliers", _win(86400) + """, r AS (SELECT symbol, bucket, trade_id, q, count(*) OVER o AS n, avg(q) OVER o AS m, stddev_pop(q) OVER o AS s FROM w WINDOW o AS (PARTITION BY symbol, bucket ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING)),
 z AS (SELECT symbol, bucket, trade_id, n, round((q - m) / CASE WHEN s > 0.000000001 THEN s END, 5) AS zscore FROM r) SELECT symbol, bucket, trade_id, zscore FROM z WHERE n > 20 AND abs(zscore) > 2""")
def win21(spark, d):
    return G.expanding_outliers(ticks(spark, d))


@query("win22_mic05_effective_spread", _win(86400) + """, m AS (SELECT *, CASE WHEN count(*) OVER s >= 2 THEN avg(p) OVER s END AS m FROM w WINDOW s AS (PARTITION BY symbol, bucket, is_buyer_maker ORDER BY ts, trade_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
 g AS (SELECT *, count(CASE WHEN NOT is_buyer_maker THEN m END) OVER r AS gb, count(CASE WHEN is_buyer_maker THEN m END) OVER r AS gs FROM m WINDOW r AS (PARTITION BY symbol, bucket ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING)),
 h AS (SELECT symbol, bucket, max(CASE WHEN NOT is_buyer_maker THEN m END) OVER (PARTITION BY symbol, bucket, gb) AS b, max(CASE WHEN is_buyer_maker THEN m END) OVER (PARTITION BY symbol, bucket, gs) AS s FROM g),
 x AS (SELECT symbol, bucket, abs(b - s) / ((b + s) / 2) AS sp FROM h) SELECT symbol, bucket, count(*) AS n, round(avg(sp), 6) AS mean, round(stddev_pop(sp), 6) AS std, round(min(sp), 6) AS min, round(max(sp), 6) AS max, round(quantile_cont(sp, 0.5), 6) AS median, round(stddev_pop(sp) / avg(sp), 5) AS volatility FROM x WHERE sp >= 0.0001 GROUP BY symbol, bucket""")
def win22(spark, d):
    return G.effective_spread(ticks(spark, d))


@query("win27_halves", _win(86400) + """, k AS (SELECT symbol, bucket, q, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) AS k, count(*) OVER (PARTITION BY symbol, bucket) AS n FROM w),
 g AS (SELECT symbol, bucket, avg(CASE WHEN k <= n // 2 THEN q END) AS a, avg(CASE WHEN k > n // 2 THEN q END) AS z FROM k GROUP BY symbol, bucket)
SELECT symbol, bucket, round(a, 6) AS first_half, round(z, 6) AS second_half, round((z - a) / a * 100, 6) AS change_pct, CASE WHEN (z - a) / a * 100 > 20 THEN 'accelerating' WHEN (z - a) / a * 100 < -20 THEN 'decelerating' ELSE 'stable' END AS label FROM g""")
def win27(spark, d):
    return G.halves(ticks(spark, d))


_PM = _win(86400) + """, k AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC, trade_id DESC) AS z FROM w),
 g AS (SELECT symbol, bucket, max(CASE WHEN a = 1 THEN p END) AS s, max(CASE WHEN z = 1 THEN p END) AS e, round(stddev_pop(p), 6) AS std, round(max(p) - min(p), 6) AS range FROM k GROUP BY symbol, bucket) """


@query("mic09_price_movement", _PM + "SELECT symbol, bucket, s AS start, e AS \"end\", std, range, round((e - s) / s * 100, 6) AS change_pct, CASE WHEN (e - s) / s * 100 > 0.01 THEN 'up' WHEN (e - s) / s * 100 < -0.01 THEN 'down' ELSE 'flat' END AS trend FROM g")
def mic09(spark, d):
    return G.price_movement(ticks(spark, d))


@query("mic16_flt08_metric_summary", _PM + """, l AS (SELECT symbol, bucket, 'std' AS metric, std AS value FROM g UNION ALL SELECT symbol, bucket, 'range', range FROM g)
SELECT symbol, metric, count(*) AS n, arg_max(value, bucket) AS latest, round((epoch_us(max(bucket)) - epoch_us(min(bucket))) / 3600000000.0, 6) AS hours FROM l GROUP BY symbol, metric""")
def mic16(spark, d):
    return G.metric_summary(G.long_metrics(G.price_movement(ticks(spark, d)), ["std", "range"]))


@query("stg04_intensity_signals", _C + f""", m AS (SELECT *, {_roll('avg(trades)', 20)} AS t, {_roll('avg(volume)', 20)} AS v, {_roll('avg(close)', 20)} AS c, lag(close) OVER {_W} AS p FROM c)
SELECT symbol, bucket, CASE WHEN trades < 0.7 * t THEN 'exit' WHEN trades > t AND volume > v AND close > c AND close > p THEN 'entry' END AS signal FROM m""")
def stg04(spark, d):
    return G.intensity_signals(candles(spark, d)).select("symbol", "bucket", "signal")


@query("stg09_indicator_table", _R + f""", g AS (SELECT symbol, bucket, close, pct, greatest(coalesce(diff, 0), 0) AS g, greatest(-coalesce(diff, 0), 0) AS l FROM r),
 m AS (SELECT symbol, bucket, close, pct, {_roll('avg(g)', 14)} AS g, {_roll('avg(l)', 14)} AS l, {_roll('avg(close)', 20)} AS mu, {_roll('stddev_samp(close)', 20)} AS sd FROM g)
SELECT symbol, bucket, round(CASE WHEN sd > 0.000000000001 THEN (close - mu) / sd END, 5) AS zscore, round(CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100.0 END, 5) AS rsi, round(pct, 6) AS pct_change FROM m""")
def stg09(spark, d):
    return G.indicator_table(candles(spark, d))


@query("stg11_busy_rows", _C + ", q AS (SELECT symbol, quantile_cont(trades, 0.95) AS q FROM c GROUP BY symbol) SELECT c.symbol, count(*) AS n, round(avg(abs((close - open) / open * 100)), 6) AS mean_move_pct, round(avg(volume), 6) AS mean_volume FROM c JOIN q ON c.symbol = q.symbol WHERE trades > q GROUP BY c.symbol")
def stg11(spark, d):
    return G.busy_rows(candles(spark, d))


@query("stg12_liquidity_labels", _C + """, s AS (SELECT symbol, volume / avg(volume) OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS s FROM c), l AS (SELECT *, CASE WHEN s < 0.5 THEN 'low' WHEN s > 1.5 THEN 'high' ELSE 'normal' END AS label FROM s)
SELECT symbol, label, count(*) AS n, round(avg(s), 5) AS mean_score FROM l GROUP BY symbol, label""")
def stg12(spark, d):
    return G.liquidity_labels(candles(spark, d))


@query("agg31_stg07_daily_last", _C + """, k AS (SELECT *, CAST(bucket AS DATE) AS day, row_number() OVER (PARTITION BY symbol, CAST(bucket AS DATE) ORDER BY bucket DESC) AS k FROM c), v AS (SELECT symbol, day, close AS value FROM k WHERE k = 1),
 p AS (SELECT *, round((value / lag(value) OVER (PARTITION BY symbol ORDER BY day) - 1) * 10000, 4) AS pnl FROM v) SELECT symbol, day, value, pnl, coalesce(pnl < -200, false) AS breach FROM p""")
def agg31(spark, d):
    return G.daily_last(candles(spark, d))


_OF_BARS, _STATISTICS = STATS_SQL.split("\nSELECT ", 1)
_OF_CANDLES = """, cw AS (SELECT *, to_timestamp(CAST(floor(epoch(ts) / 14400) * 14400 AS BIGINT))::TIMESTAMP AS bucket, row_number() OVER (PARTITION BY symbol, floor(epoch(ts) / 14400) ORDER BY ts DESC, trade_id DESC) AS last FROM t),
 cc AS (SELECT symbol, bucket, CAST(max(CASE WHEN last = 1 THEN price END) AS DOUBLE) AS close, CAST(sum(q) AS DOUBLE) AS volume, count(*) AS tick_count FROM cw GROUP BY 1, 2),
 cr AS (SELECT *, close * volume AS dollar_volume, close / lag(close) OVER (PARTITION BY symbol ORDER BY bucket) - 1 AS r FROM cc)
"""


@query("bar11_bars_against_candles", HEAD_SQL + _OF_BARS + _OF_CANDLES + f"SELECT 'dollar' AS kind, {_STATISTICS} UNION ALL SELECT 'time' AS kind, {_STATISTICS.replace('FROM r ', 'FROM cr ')}")
def bar11(spark, d):
    t = ticks(spark, d)
    c = candles(spark, d).withColumnsRenamed({"bucket": "bar_id", "trades": "tick_count"}).withColumn("dollar_volume", F.col("close") * F.col("volume"))
    return R.compare({"dollar": B.bar_statistics(B.dollar_bars(t, 10_000)), "time": B.bar_statistics(c)})


@query("str02_sliding", """, b AS (SELECT symbol, q, cents, is_buyer_maker, to_timestamp(CAST((floor(epoch(ts) / 1800) - k) * 1800 AS BIGINT))::TIMESTAMP AS bucket FROM t, (SELECT unnest([0, 1]) AS k))
SELECT symbol, bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume FROM b GROUP BY symbol, bucket HAVING bucket + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 SECOND FROM t)""")
def str02(spark, d):
    s = streams.sliding(streams.stream_ticks(spark, d), M.volume_metrics(), 3600, 1800)
    return streams.run_to_files(s, "sliding").select("symbol", "bucket", "trades", "volume")
