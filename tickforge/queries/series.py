"""Queries on gaps, indicators, signals and features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..operators import series as R
from ..operators import stats as S
from ..plans import prefix
from ..registry import query
from ..schema import ticks

_GAPS = """, g AS (SELECT symbol, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS gap_start, ts AS gap_end FROM t),
 h AS (SELECT *, (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000.0 AS s FROM g),
 gaps AS (SELECT symbol, gap_start, gap_end, round(s / 3600, 6) AS hours, round(s / 86400, 6) AS days FROM h WHERE s > {limit}) """


@query("win01_gaps", _GAPS.format(limit=3600) + "SELECT * FROM gaps")
def win01(spark, d):
    return R.gaps(ticks(spark, d))


@query("win02_largest_gap", _GAPS.format(limit=0) + "SELECT symbol, max(hours) AS hours FROM gaps GROUP BY symbol")
def win02(spark, d):
    return R.gaps(ticks(spark, d), 0).groupBy("symbol").agg(F.max("hours").alias("hours"))


@query("top06_top_gaps", _GAPS.format(limit=60) + "SELECT symbol, gap_start, hours FROM gaps ORDER BY hours DESC, symbol, gap_start LIMIT 10")
def top06(spark, d):
    return R.top_gaps(R.gaps(ticks(spark, d), 60), 10).select("symbol", "gap_start", "hours")


@query("top07_top_gaps_per_symbol", _GAPS.format(limit=60) + "SELECT symbol, gap_start, hours FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY hours DESC, gap_start) AS k FROM gaps) WHERE k <= 3")
def top07(spark, d):
    return R.top_gaps(R.gaps(ticks(spark, d), 60), 3, per_symbol=True).select("symbol", "gap_start", "hours")


_ISLANDS = """, g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY symbol ORDER BY ts, trade_id) > ts - INTERVAL 1 HOUR THEN 0 ELSE 1 END AS f FROM t),
 i AS (SELECT *, sum(f) OVER (PARTITION BY symbol ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING) AS k FROM g),
 isl AS (SELECT symbol, min(ts) AS island_start, max(ts) AS island_end, count(*) AS n FROM i GROUP BY symbol, k) """


@query("win16_islands", _ISLANDS + "SELECT * FROM isl")
def win16(spark, d):
    return R.islands(ticks(spark, d))


#: m holds the missing ranges between 5 and 20 January.
MISSING_SQL = _ISLANDS + """, e AS (SELECT symbol, island_start, island_end FROM isl WHERE island_end >= TIMESTAMP '2024-01-05' AND island_start <= TIMESTAMP '2024-01-20'
 UNION ALL SELECT DISTINCT symbol, TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-05' FROM isl UNION ALL SELECT DISTINCT symbol, TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-20' FROM isl),
 u AS (SELECT symbol, max(island_end) OVER (PARTITION BY symbol ORDER BY island_start, island_end ROWS UNBOUNDED PRECEDING) AS upto, lead(island_start) OVER (PARTITION BY symbol ORDER BY island_start, island_end) AS nxt FROM e),
 m AS (SELECT symbol, upto AS missing_start, nxt AS missing_end, round((epoch_us(nxt) - epoch_us(upto)) / 3600000000.0, 6) AS hours FROM u WHERE (epoch_us(nxt) - epoch_us(upto)) / 3600000000.0 > 0.1) """


@query("set07_missing_ranges", MISSING_SQL + "SELECT symbol, missing_start, missing_end, hours FROM m")
def set07(spark, d):
    return R.missing_ranges(R.islands(ticks(spark, d)), datetime(2024, 1, 5), datetime(2024, 1, 20))


#: Four-hour candles of the ticks, as doubles.
_C = """, o AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC, trade_id DESC) AS z
  FROM (SELECT *, to_timestamp(CAST(floor(epoch(ts) / 14400) * 14400 AS BIGINT))::TIMESTAMP AS bucket FROM t)),
 c AS (SELECT symbol, bucket, max(CASE WHEN a = 1 THEN cents END) / 100.0 AS open, max(cents) / 100.0 AS high, min(cents) / 100.0 AS low, max(CASE WHEN z = 1 THEN cents END) / 100.0 AS close, CAST(sum(q) AS DOUBLE) AS volume, count(*) AS trades FROM o GROUP BY symbol, bucket) """
_W = "(PARTITION BY symbol ORDER BY bucket)"


def _roll(f: str, n: int) -> str:
    w = f"OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(*) {w} = {n} THEN {f} {w} END"


def candles(spark, d):
    return S.ohlcv(ticks(spark, d), "4h")


@query("win03_sma", _C + f"SELECT symbol, bucket, round({_roll('avg(close)', 20)}, 6) AS sma_fast, round({_roll('avg(close)', 50)}, 6) AS sma_slow FROM c")
def win03(spark, d):
    return R.moving_averages(candles(spark, d)).select("symbol", "bucket", "sma_fast", "sma_slow")


_R = _C + f", r AS (SELECT *, close - lag(close) OVER {_W} AS diff, close / lag(close) OVER {_W} - 1 AS pct FROM c) "


@query("win04_volatility", _R + "SELECT symbol, bucket, round(CASE WHEN count(pct) OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) = 24 THEN stddev_samp(pct) OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END, 6) AS volatility FROM r")
def win04(spark, d):
    return R.volatility(candles(spark, d)).select("symbol", "bucket", "volatility")


@query("win05_bollinger", _C + f", b AS (SELECT symbol, bucket, {_roll('avg(close)', 20)} AS m, {_roll('stddev_samp(close)', 20)} AS s FROM c) SELECT symbol, bucket, round(m, 6) AS middle, round(m + 2 * s, 6) AS upper, round(m - 2 * s, 6) AS lower FROM b")
def win05(spark, d):
    return R.bollinger(candles(spark, d)).select("symbol", "bucket", "middle", "upper", "lower")


@query("win06_rsi", _R + f""", g AS (SELECT symbol, bucket, greatest(coalesce(diff, 0), 0) AS g, greatest(-coalesce(diff, 0), 0) AS l FROM r),
 m AS (SELECT symbol, bucket, {_roll('avg(g)', 14)} AS g, {_roll('avg(l)', 14)} AS l FROM g) SELECT symbol, bucket, round(CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100.0 END, 5) AS rsi FROM m""")
def win06(spark, d):
    return R.rsi(candles(spark, d)).select("symbol", "bucket", "rsi")


_Z = _C + f", z AS (SELECT *, ({_roll('avg(close)', 20)}) AS m, ({_roll('stddev_samp(close)', 20)}) AS s FROM c), zz AS (SELECT symbol, bucket, close, round(CASE WHEN s > 0.000000000001 THEN (close - m) / s END, 5) AS zscore FROM z) "


@query("win07_zscore", _Z + "SELECT symbol, bucket, zscore FROM zz")
def win07(spark, d):
    return R.zscore(candles(spark, d)).select("symbol", "bucket", "zscore")


@query("win08_returns", _R + "SELECT symbol, bucket, round(diff, 6) AS diff, round(pct, 6) AS pct_change, round(ln(pct + 1), 6) AS log_return FROM r")
def win08(spark, d):
    return R.returns(candles(spark, d)).select("symbol", "bucket", "diff", dbl("pct_change").alias("pct_change"), dbl("log_return").alias("log_return"))


@query("win09_volume_features", _C + f", v AS (SELECT symbol, bucket, volume, {_roll('avg(volume)', 20)} AS m FROM c) SELECT symbol, bucket, round(m, 6) AS volume_ma, round(volume / m, 6) AS volume_ratio FROM v")
def win09(spark, d):
    return R.volume_features(candles(spark, d)).select("symbol", "bucket", "volume_ma", "volume_ratio")


@query("win10_partial_mean", _C + "SELECT symbol, bucket, round(avg(close) OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS mean FROM c")
def win10(spark, d):
    return candles(spark, d).select("symbol", "bucket", dbl(R.rolling(F.avg(R.x("close")), 20, full=False)).alias("mean"))


@query("win12_drawdown", _C + f""", p AS (SELECT symbol, bucket, close / first_value(close) OVER {_W} AS cu FROM c), k AS (SELECT *, max(cu) OVER (PARTITION BY symbol ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS pk FROM p)
SELECT symbol, bucket, round(cu, 4) AS cumulative, round(cu / pk - 1, 5) AS drawdown FROM k""")
def win12(spark, d):
    return R.drawdown(candles(spark, d)).select("symbol", "bucket", F.round("cumulative", 4).alias("cumulative"), F.round("drawdown", 5).alias("drawdown"))


@query("win13_cumulative_dollar_volume", "SELECT symbol, trade_id, CAST(sum(cents * q) OVER (PARTITION BY symbol ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents FROM t")
def win13(spark, d):
    c = prefix.running_total(ticks(spark, d), F.col("price") * F.col("quantity"), "c")
    return c.select("symbol", "trade_id", F.round(F.col("c") * 100).cast("long").alias("cents"))


_S = _C + f", s AS (SELECT symbol, bucket, round({_roll('avg(close)', 5)}, 6) AS f, round({_roll('avg(close)', 20)}, 6) AS l FROM c), g AS (SELECT *, CASE WHEN f > l THEN 1 WHEN f < l THEN -1 ELSE 0 END AS signal FROM s) "


@query("win14_stg01_crossings", _S + f"""SELECT symbol, bucket, signal, signal - lag(signal) OVER {_W} AS position, CASE WHEN lag(f) OVER {_W} <= lag(l) OVER {_W} AND f > l THEN 'golden' WHEN lag(f) OVER {_W} >= lag(l) OVER {_W} AND f < l THEN 'death' END AS cross_kind FROM g""")
def win14(spark, d):
    return R.crossings(candles(spark, d)).select("symbol", "bucket", "signal", "position", F.col("cross").alias("cross_kind"))


_EV = _Z + f""", e AS (SELECT symbol, bucket, close, zscore, lag(zscore) OVER {_W} AS p FROM zz), f AS (SELECT *, CASE WHEN p >= -1 AND zscore < -1 THEN 'entry' WHEN p <= 0 AND zscore > 0 THEN 'exit' END AS event FROM e),
 n AS (SELECT *, coalesce(lag(event) OVER {_W}, 'exit') AS b FROM f WHERE event IS NOT NULL), ev AS (SELECT symbol, bucket, close, event FROM n WHERE event <> b) """


@query("win15_stg03_mean_reversion", _EV + "SELECT symbol, bucket, event FROM ev")
def win15(spark, d):
    return R.mean_reversion(candles(spark, d)).select("symbol", "bucket", "event")


_TRIPS = _EV + """, tr AS (SELECT symbol, bucket AS entry_time, close AS entry_price, lead(bucket) OVER (PARTITION BY symbol ORDER BY bucket) AS exit_time, lead(close) OVER (PARTITION BY symbol ORDER BY bucket) AS exit_price, event FROM ev),
 trips AS (SELECT symbol, entry_time, entry_price, exit_time, exit_price, round(exit_price - entry_price, 6) AS pnl, round((exit_price - entry_price) / entry_price * 100, 6) AS pnl_pct FROM tr WHERE event = 'entry' AND exit_time IS NOT NULL) """


@query("jn03_stg02_round_trips", _TRIPS + "SELECT * FROM trips")
def jn03(spark, d):
    e = R.mean_reversion(candles(spark, d))
    return R.round_trips(e, F.col("event") == "entry", F.col("event") == "exit")


@query("stg02_trip_summary", _TRIPS + "SELECT symbol, count(*) AS n, round(sum(pnl_pct), 6) AS total_pct, round(avg(pnl_pct), 6) AS avg_pct, round(count(*) FILTER (WHERE pnl > 0) * 100.0 / count(*), 6) AS win_rate, max(pnl) AS best, min(pnl) AS worst FROM trips GROUP BY symbol")
def stg02(spark, d):
    e = R.mean_reversion(candles(spark, d))
    return R.trip_summary(R.round_trips(e, F.col("event") == "entry", F.col("event") == "exit"))


@query("win20_autocorrelation", _R + f"SELECT symbol, round(corr(pct, l), 5) AS autocorrelation FROM (SELECT symbol, pct, lag(pct) OVER {_W} AS l FROM r) GROUP BY symbol")
def win20(spark, d):
    return R.autocorrelation(candles(spark, d))


@query("agg22_annualised_volatility", _R + "SELECT symbol, round(stddev_samp(pct) * sqrt(2190.0), 5) AS volatility FROM r GROUP BY symbol")
def agg22(spark, d):
    return R.returns(candles(spark, d)).groupBy("symbol").agg(dbl(F.stddev_samp("pct_change") * F.sqrt(F.lit(2190.0)), 5).alias("volatility"))


@query("stg05_performance", _R + f""", p AS (SELECT *, close / first_value(close) OVER {_W} AS cu FROM r), k AS (SELECT *, cu / max(cu) OVER (PARTITION BY symbol ORDER BY bucket ROWS UNBOUNDED PRECEDING) - 1 AS dd, row_number() OVER (PARTITION BY symbol ORDER BY bucket DESC) AS z FROM p)
SELECT symbol, round(max(CASE WHEN z = 1 THEN cu END) - 1, 4) AS total_return, round(stddev_samp(pct) * sqrt(365.0), 4) AS volatility, round(avg(pct) / stddev_samp(pct) * sqrt(365.0), 4) AS sharpe, round(min(dd), 4) AS max_drawdown,
 round(avg(pct) / stddev_samp(CASE WHEN pct < 0 THEN pct END) * sqrt(365.0), 4) AS sortino, round(avg(pct) * 365.0 / abs(min(dd)), 4) AS calmar FROM k GROUP BY symbol""")
def stg05(spark, d):
    return R.performance(candles(spark, d))


@query("stg08_feature_table", _R + f""", f AS (SELECT symbol, bucket, round(pct, 6) AS pct_change, round(ln(pct + 1), 6) AS log_return,
 round(CASE WHEN count(pct) OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20 THEN stddev_samp(pct) OVER (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END, 6) AS volatility,
 round(volume / ({_roll('avg(volume)', 20)}), 6) AS volume_ratio, CAST(hour(bucket) AS INTEGER) AS hour, CAST(isodow(bucket) - 1 AS INTEGER) AS weekday FROM r) SELECT * FROM f WHERE pct_change IS NOT NULL AND volatility IS NOT NULL AND volume_ratio IS NOT NULL""")
def stg08(spark, d):
    return R.feature_table(candles(spark, d))


@query("stg10_activity_regimes", _C + """, q AS (SELECT symbol, quantile_cont(trades, 0.25) AS a, quantile_cont(trades, 0.75) AS z FROM c GROUP BY symbol),
 g AS (SELECT c.*, CASE WHEN trades > z THEN 'high' WHEN trades < a THEN 'low' ELSE 'normal' END AS regime FROM c JOIN q ON c.symbol = q.symbol)
SELECT symbol, regime, count(*) AS n, round(avg(trades), 6) AS mean_activity, round(avg(volume), 6) AS mean_volume FROM g GROUP BY symbol, regime""")
def stg10(spark, d):
    return R.activity_regimes(candles(spark, d))


@query("win17_decayed_vwap", """, k AS (SELECT symbol, trade_id, CAST(q AS DOUBLE) AS q, cents / 100.0 * q AS d, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i FROM t)
SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, trade_id, i, CAST(d AS DOUBLE) AS n, q AS v FROM k WHERE i = 1 UNION ALL SELECT k.symbol, k.trade_id, k.i, k.d + 0.99 * s.n, k.q + 0.99 * s.v FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1) SELECT symbol, trade_id, round(n / v, 6) AS decayed_vwap FROM s)""")
def win17(spark, d):
    t = ticks(spark, d)
    n = prefix.decayed_sum(t, F.col("price") * F.col("quantity"), 0.99, "n")
    n = prefix.decayed_sum(n, F.col("quantity"), 0.99, "v")
    return n.select("symbol", "trade_id", dbl(F.col("n") / F.col("v")).alias("decayed_vwap"))


def _frac_sql(order: float, threshold: float) -> str:
    """The weighted sum of a close and those before it; null until all of them are there."""
    return " + ".join(f"{w!r} * lag(close, {i}) OVER {_W}" for i, w in enumerate(R.fractional_weights(order, threshold)))


@query("win19_fractional_difference", _C + f"SELECT symbol, bucket, round({_frac_sql(0.4, 1e-2)}, 6) AS frac_diff FROM c")
def win19(spark, d):
    return R.fractional_difference(candles(spark, d), 0.4, 1e-2).select("symbol", "bucket", "frac_diff")


@query("jn02_asof_backward", """, p AS (SELECT symbol, trade_id, ts FROM t WHERE trade_id % 50 = 0), f AS (SELECT symbol, ts, price FROM t WHERE trade_id % 3 = 0),
 j AS (SELECT p.symbol, p.trade_id, f.ts AS fact_ts, f.price AS fact_price, row_number() OVER (PARTITION BY p.trade_id ORDER BY f.ts DESC) AS k FROM p LEFT JOIN f ON p.symbol = f.symbol AND f.ts <= p.ts)
SELECT symbol, trade_id, fact_ts, fact_price FROM j WHERE k = 1""")
def jn02(spark, d):
    t = ticks(spark, d)
    facts = t.where("trade_id % 3 = 0").select("symbol", "ts", F.col("price").alias("fact_price"))
    return R.asof_backward(t.where("trade_id % 50 = 0").select("symbol", "ts", "trade_id"), facts, ["fact_price"]).select("symbol", "trade_id", "fact_ts", "fact_price")


@query("jn09_time_band_join", ", a AS (SELECT * FROM t WHERE trade_id % 20 = 0) SELECT a.trade_id, t.trade_id AS near_id FROM a JOIN t ON a.symbol = t.symbol AND abs(epoch_us(a.ts) - epoch_us(t.ts)) <= 7200000000")
def jn09(spark, d):
    t = ticks(spark, d).select("symbol", "ts", "trade_id")
    return R.time_band_join(t.where("trade_id % 20 = 0"), t, 7200).select("trade_id", F.col("r_trade_id").alias("near_id"))
