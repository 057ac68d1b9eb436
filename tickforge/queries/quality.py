"""Queries on data quality, microstructure and order books."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import micro as M
from ..operators import quality as Q
from ..operators import rolling as L
from ..operators import series as R
from ..operators import stats as S
from ..operators import ticks as K
from ..registry import query
from ..schema import table, ticks
from .series import _C, _GAPS, MISSING_SQL

AS_OF = datetime(2024, 1, 31)


def damaged(spark, d):
    """Ticks with every seventh row twice."""
    t = ticks(spark, d)
    return t.unionByName(t.where("trade_id % 7 = 0"))


_DAMAGED = ", dd AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE trade_id % 7 = 0) "


@query("dq01_duplicate_count", _DAMAGED + "SELECT count(*) AS records, count(*) - count(DISTINCT (symbol, trade_id)) AS duplicates FROM dd")
def dq01(spark, d):
    return damaged(spark, d).agg(F.count("*").alias("records"), (F.count("*") - F.count_distinct("symbol", "trade_id")).alias("duplicates"))


@query("dq02_duplicate_breakdown", _DAMAGED + "SELECT symbol, CAST(sum(c - 1) AS BIGINT) AS duplicates, count(*) AS ids FROM (SELECT symbol, trade_id, count(*) AS c FROM dd GROUP BY 1, 2) WHERE c > 1 GROUP BY symbol")
def dq02(spark, d):
    return Q.duplicate_breakdown(damaged(spark, d))


@query("dq03_dedup_report", _DAMAGED + "SELECT (SELECT count(*) FROM dd) AS records_before, count(*) AS records_after, (SELECT count(*) FROM dd) - count(*) AS removed, CAST(0 AS BIGINT) AS duplicates_left FROM t")
def dq03(spark, d):
    t = damaged(spark, d)
    return Q.dedup_report(t, K.deduplicate(t))


@query("dq04_gap_report", _GAPS.format(limit=3600) + "SELECT symbol, count(*) AS gap_count, round(sum(days), 4) AS total_days, max(hours) AS largest_hours FROM gaps GROUP BY symbol")
def dq04(spark, d):
    return Q.gap_report(ticks(spark, d))


@query("dq05_duplicate_timestamps", "SELECT l_returnflag AS symbol, l_shipdate AS ts, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", raw=True)
def dq05(spark, d):
    t = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("symbol"), F.col("l_shipdate").alias("ts"))
    return Q.duplicate_timestamps(t)


_FRESH = "SELECT symbol, max(ts) AS last_time, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3600000000.0, 6) AS age_hours, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3600000000.0 > 2 AS stale FROM t GROUP BY symbol"


@query("dq06_freshness", _FRESH)
def dq06(spark, d):
    return Q.freshness(ticks(spark, d), AS_OF)


@query("dq07_invalid_values", "SELECT event_type AS symbol, count(*) FILTER (WHERE value IS NULL OR value <= 50) AS bad_price, CAST(0 AS BIGINT) AS bad_quantity, CAST(0 AS BIGINT) AS null_time FROM events WHERE value > 0 GROUP BY 1", raw=True)
def dq07(spark, d):
    return Q.invalid_values(ticks(spark, d).withColumn("price", F.col("price") - 50))


@query("dq08_dq11_assessment", _DAMAGED + """, b AS (SELECT symbol, count(*) AS records, min(ts) AS first_time, max(ts) AS last_time, count(*) - count(DISTINCT trade_id) AS duplicates FROM dd GROUP BY symbol),
 g0 AS (SELECT symbol, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY symbol ORDER BY ts, trade_id))) / 1000000.0 AS s FROM dd), g AS (SELECT symbol, count(*) AS gap_count, round(sum(round(s / 86400, 6)), 4) AS total_days, max(round(s / 3600, 6)) AS largest_hours FROM g0 WHERE s > 3600 GROUP BY symbol)
SELECT b.symbol, records, first_time, last_time, duplicates, coalesce(gap_count, 0) AS gap_count, coalesce(total_days, 0) AS total_days, coalesce(largest_hours, 0) AS largest_hours,
 round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_time)) / 3600000000.0, 6) AS age_hours, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_time)) / 3600000000.0 > 2 AS stale, CAST(0 AS BIGINT) AS bad_price, CAST(0 AS BIGINT) AS bad_quantity, CAST(0 AS BIGINT) AS null_time,
 duplicates + coalesce(gap_count, 0) AS issues, round(greatest(0.0, 100 * (1 - (duplicates + coalesce(gap_count, 0)) / CAST(records AS DOUBLE))), 4) AS quality_score FROM b LEFT JOIN g ON b.symbol = g.symbol""")
def dq08(spark, d):
    return Q.assessment(damaged(spark, d), AS_OF)


@query("dq10_recommendations", _GAPS.format(limit=3600) + """SELECT symbol, 'fill_gap' AS action, 'HIGH' AS priority, hours AS detail FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY hours DESC, gap_start) AS k FROM gaps) WHERE k <= 3
 UNION ALL SELECT symbol, 'refresh', 'MEDIUM', age_hours FROM (""" + _FRESH + ") WHERE stale")
def dq10(spark, d):
    return Q.recommendations(ticks(spark, d), AS_OF)


@query("dq10_overall_status", _DAMAGED + """, b AS (SELECT symbol, count(*) AS records, max(ts) AS last_time, count(*) - count(DISTINCT trade_id) AS duplicates FROM dd GROUP BY symbol),
 g0 AS (SELECT symbol, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY symbol ORDER BY ts, trade_id)) AS s FROM dd), g AS (SELECT count(*) AS gaps FROM g0 WHERE s > 3600000000),
 a AS (SELECT count(*) AS symbols, CAST(sum(records) AS BIGINT) AS records, CAST(sum(duplicates) AS BIGINT) AS duplicates, count(*) FILTER (WHERE epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_time) > 7200000000) AS stale_symbols FROM b)
SELECT symbols, records, duplicates, gaps, stale_symbols, duplicates + gaps AS issues, CASE WHEN duplicates + gaps = 0 AND stale_symbols = 0 THEN 'healthy' ELSE 'issues_found' END AS status FROM a, g""")
def dq10_status(spark, d):
    return Q.overall_status(damaged(spark, d), AS_OF)


@query("dq19_maintenance_triggers", _GAPS.format(limit=3600) + ", m AS (SELECT symbol, max(hours) AS h FROM gaps GROUP BY symbol), f AS (" + _FRESH + ") SELECT f.symbol, false AS dedupe, coalesce(h, 0) > 6 AS backfill, age_hours > 2 AS refresh FROM f LEFT JOIN m ON f.symbol = m.symbol")
def dq19(spark, d):
    return Q.maintenance_triggers(ticks(spark, d), AS_OF)


def candles(spark, d):
    return S.ohlcv(ticks(spark, d), "4h")


_SPIKE = _C + """, sp AS (SELECT symbol, bucket, 'price_spike' AS kind, (close - open) / open * 100 AS ch, close FROM c),
 s AS (SELECT symbol, bucket, kind, CASE WHEN abs(ch) > 20 THEN 'critical' WHEN abs(ch) > 15 THEN 'high' ELSE 'medium' END AS severity, round(ch, 6) AS change_pct, close AS price FROM sp WHERE abs(ch) > 10),
 z AS (SELECT *, avg(close) OVER w AS m, stddev_samp(close) OVER w AS sd FROM c WINDOW w AS (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
 zz AS (SELECT symbol, bucket, round(CASE WHEN sd > 0.000000000001 THEN (close - m) / sd END, 5) AS zs, close FROM z),
 outl AS (SELECT symbol, bucket, 'outlier' AS kind, CASE WHEN abs(zs) > 5 THEN 'critical' WHEN abs(zs) > 4 THEN 'high' ELSE 'medium' END AS severity, CAST(0 AS DOUBLE) AS change_pct, close AS price FROM zz WHERE abs(zs) > 3) """


@query("dq12_spikes", _SPIKE + "SELECT * FROM s")
def dq12(spark, d):
    return Q.spikes(candles(spark, d))


@query("dq13_outliers", _SPIKE + "SELECT * FROM outl")
def dq13(spark, d):
    return Q.outliers(candles(spark, d))


_ANOM = _SPIKE + ", an AS (SELECT * FROM s UNION ALL SELECT * FROM outl WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.symbol = outl.symbol AND s.bucket = outl.bucket)) "


@query("dq15_jn04_anomalies", _ANOM + "SELECT * FROM an")
def dq15(spark, d):
    return Q.anomalies(candles(spark, d))


@query("dq16_anomaly_report", _ANOM + "SELECT symbol, kind, severity, count(*) AS n, min(bucket) AS first_time, max(bucket) AS last_time FROM an GROUP BY 1, 2, 3")
def dq16(spark, d):
    return Q.anomaly_report(Q.anomalies(candles(spark, d)))


@query("dq14_market_wide", _SPIKE + """, p AS (SELECT DISTINCT bucket AS ts FROM s), mv AS (SELECT symbol, bucket FROM sp WHERE abs(ch) > 5), n AS (SELECT count(DISTINCT symbol) AS n FROM c)
SELECT ts, count(DISTINCT mv.symbol) AS affected, count(DISTINCT mv.symbol) > 0.5 * max(n) AS market_wide FROM p LEFT JOIN mv ON abs(epoch_us(mv.bucket) - epoch_us(p.ts)) <= 300000000, n GROUP BY ts""")
def dq14(spark, d):
    c = candles(spark, d)
    return Q.market_wide(Q.spikes(c), c)


@query("dq20_backfill_plan", MISSING_SQL + """, h AS (SELECT symbol, count(*) AS c FROM t GROUP BY symbol, date_trunc('hour', ts)), y AS (SELECT symbol, quantile_cont(CAST(c AS DOUBLE), 0.9) AS density FROM h GROUP BY symbol),
 p AS (SELECT m.symbol, missing_start, epoch_us(missing_start) AS a, epoch_us(missing_end) AS z, CAST(floor(least(CAST(6 AS DOUBLE), greatest(CAST(0.5 AS DOUBLE), CAST(12 AS DOUBLE) / coalesce(density, 4000))) * CAST(3600000000 AS DOUBLE)) AS BIGINT) AS us FROM m LEFT JOIN y ON m.symbol = y.symbol),
 x AS (SELECT *, unnest(range(0, (z - a - 1) // us + 1)) AS piece FROM p WHERE z > a)
SELECT symbol, missing_start, piece, make_timestamp(a + piece * us) AS piece_start, make_timestamp(least(a + (piece + 1) * us, z)) AS piece_end FROM x""")
def dq20(spark, d):
    t = ticks(spark, d)
    ranges = R.missing_ranges(R.islands(t), datetime(2024, 1, 5), datetime(2024, 1, 20))
    return Q.backfill_plan(t, ranges, 20)


@query("dq21_latest_window", "SELECT symbol, greatest(max(ts), TIMESTAMP '2024-01-30') AS fetch_start, TIMESTAMP '2024-01-31' AS fetch_end FROM t GROUP BY symbol")
def dq21(spark, d):
    return Q.latest_window(ticks(spark, d), AS_OF)


@query("dq18_file_sanity", "SELECT 'events.parquet' AS file_name, count(*) AS records, count(DISTINCT CAST(ts AS DATE)) AS dates, count(DISTINCT event_type) AS symbols, count(*) > 0 AS non_empty FROM events", raw=True)
def dq18(spark, d):
    return Q.file_sanity(table(spark, d, "events"), "ts", "event_type").drop("file_bytes")


def _win(seconds: int) -> str:
    return f", w AS (SELECT *, cents / 100.0 AS p, to_timestamp(CAST(floor(epoch(ts) / {seconds}) * {seconds} AS BIGINT))::TIMESTAMP AS bucket FROM t) "


_SB = "count(*) FILTER (WHERE NOT is_buyer_maker)"
_SS = "count(*) FILTER (WHERE is_buyer_maker)"
_VB = "coalesce(sum(q) FILTER (WHERE NOT is_buyer_maker), 0)"
_VS = "coalesce(sum(q) FILTER (WHERE is_buyer_maker), 0)"
_DB = "coalesce(sum(cents * q) FILTER (WHERE NOT is_buyer_maker), 0)"
_DS = "coalesce(sum(cents * q) FILTER (WHERE is_buyer_maker), 0)"


@query("mic01_order_flow", _win(3600) + f"""SELECT symbol, bucket, {_SB} AS buys, {_SS} AS sells, CAST({_VB} AS DOUBLE) AS buy_volume, CAST({_VS} AS DOUBLE) AS sell_volume, round({_DB} / 100.0, 4) AS buy_dollars, round({_DS} / 100.0, 4) AS sell_dollars,
 round(CAST({_SB} - {_SS} AS DOUBLE) / count(*), 6) AS trade_imbalance, round(CAST({_VB} - {_VS} AS DOUBLE) / sum(q), 6) AS volume_imbalance, round(CAST({_DB} - {_DS} AS DOUBLE) / sum(cents * q), 6) AS dollar_imbalance,
 round(coalesce(CAST({_VB} AS DOUBLE) / nullif({_SB}, 0), 0), 6) AS avg_buy_size, round(coalesce(CAST({_VS} AS DOUBLE) / nullif({_SS}, 0), 0), 6) AS avg_sell_size, round(CAST({_SB} AS DOUBLE) / nullif({_SS}, 0), 6) AS count_ratio,
 abs(CAST({_VB} - {_VS} AS DOUBLE) / sum(q)) > 0.1 AS significant_imbalance FROM w GROUP BY symbol, bucket""")
def mic01(spark, d):
    return M.windowed(ticks(spark, d), M.order_flow_metrics(), 3600)


@query("mic02_win23_runs_test", _win(86400) + f""", l AS (SELECT *, CASE WHEN is_buyer_maker <> lag(is_buyer_maker) OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) THEN 1 ELSE 0 END AS c FROM w),
 g AS (SELECT symbol, bucket, CAST(count(*) AS DOUBLE) AS n, CAST({_SB} AS DOUBLE) AS n1, CAST({_SS} AS DOUBLE) AS n2, sum(c) + 1 AS runs FROM l GROUP BY symbol, bucket),
 v AS (SELECT *, 2 * n1 * n2 / n + 1 AS mu, CASE WHEN n > 1 THEN 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1)) END AS va FROM g)
SELECT symbol, bucket, CAST(runs AS BIGINT) AS runs, round(CASE WHEN n > 10 THEN CASE WHEN n1 = 0 OR n2 = 0 THEN 0.0 WHEN va > 0 THEN -(runs - mu) / sqrt(va) END END, 6) + 0.0 AS persistence FROM v""")
def mic02(spark, d):
    return M.runs_test(ticks(spark, d), 86400)


@query("mic03_toxicity", _win(86400) + """, l AS (SELECT *, lead(p) OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) - p AS dp FROM w), k AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC, trade_id DESC) AS k FROM l WHERE dp IS NOT NULL)
SELECT symbol, bucket, round(CASE WHEN count(*) >= 10 THEN (corr(CASE WHEN is_buyer_maker THEN -1.0 ELSE 1.0 END, dp) + 1) / 2 END, 6) AS toxicity FROM k WHERE k <= 100 GROUP BY symbol, bucket""")
def mic03(spark, d):
    return M.toxicity(ticks(spark, d))


@query("mic04_liquidity", _win(3600) + """SELECT symbol, bucket, count(*) AS trades, round(avg(p), 6) AS mean_price, round(stddev_pop(p), 6) AS price_std, min(p) AS min_price, max(p) AS max_price, round(max(p) - min(p), 6) AS price_range, round((max(p) - min(p)) / avg(p) * 100, 6) AS range_pct, round(avg(q), 6) AS mean_size,
 round(stddev_pop(q), 6) AS size_std, CAST(sum(q) AS DOUBLE) AS volume, round(count(*) / CASE WHEN stddev_pop(p) > 0.000000001 THEN stddev_pop(p) END, 4) AS liquidity_score, round(stddev_pop(p) / avg(q), 6) AS price_impact, round(count(*) / 3600.0, 6) AS arrival_rate FROM w GROUP BY symbol, bucket""")
def mic04(spark, d):
    return M.windowed(ticks(spark, d), M.liquidity_metrics(3600), 3600)


@query("mic07_volume_metrics", _win(3600) + f"SELECT symbol, bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap, CAST({_VB} - {_VS} AS DOUBLE) AS delta, round(CAST({_VB} - {_VS} AS DOUBLE) / sum(q) * 100, 6) AS delta_pct FROM w GROUP BY symbol, bucket")
def mic07(spark, d):
    return M.windowed(ticks(spark, d), M.volume_metrics(), 3600)


_PROF = _win(86400) + """, r AS (SELECT symbol, bucket, min(p) AS lo, max(p) AS hi FROM w GROUP BY symbol, bucket),
 b AS (SELECT w.*, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((p - lo) / ((hi - lo) / 20)) AS INTEGER), 19) END AS bin FROM w JOIN r ON w.symbol = r.symbol AND w.bucket = r.bucket) """


@query("mic07_scl08_profile", _PROF + f"SELECT symbol, bucket, bin, CAST(sum(q) AS DOUBLE) AS volume, CAST({_VB} AS DOUBLE) AS buy_volume, CAST({_VS} AS DOUBLE) AS sell_volume FROM b GROUP BY symbol, bucket, bin")
def mic07p(spark, d):
    return M.profile(ticks(spark, d))


@query("mic08_value_area", _PROF + """, p AS (SELECT symbol, bucket, CAST(bin AS INTEGER) AS bin, CAST(sum(q) AS DOUBLE) AS volume FROM b GROUP BY symbol, bucket, bin),
 m AS (SELECT symbol, bucket, sum(volume) AS t, arg_max(bin, volume * 1000 - bin) AS poc, map_from_entries(list({'k': bin, 'v': volume})) AS m FROM p GROUP BY symbol, bucket),
 g AS (SELECT symbol, bucket, t, poc, list_transform(range(0, 20), lambda i: coalesce(m[CAST(i AS INTEGER)], 0)) AS h FROM m),
 a AS (SELECT * FROM (WITH RECURSIVE s AS (SELECT *, poc AS lo, poc AS hi, h[poc + 1] AS v, 0 AS k FROM g
   UNION ALL SELECT symbol, bucket, t, poc, h, CASE WHEN grow AND down THEN lo - 1 ELSE lo END, CASE WHEN grow AND up THEN hi + 1 ELSE hi END, v + CASE WHEN grow AND down THEN low WHEN grow AND up THEN high ELSE 0 END, k + 1
   FROM (SELECT *, low >= high AND lo > 0 AS down, NOT (low >= high AND lo > 0) AND high >= 0 AS up FROM (SELECT *, v < CAST(0.7 AS DOUBLE) * t AS grow, CASE WHEN lo > 0 THEN h[lo] ELSE -1 END AS low, CASE WHEN hi < 19 THEN h[hi + 2] ELSE -1 END AS high FROM s WHERE k < 20))) SELECT * FROM s))
SELECT symbol, bucket, poc, round(list_sum(list_transform(h, lambda v: (v / t) * (v / t))), 6) AS concentration, lo AS va_low, hi AS va_high FROM a WHERE k = 20""")
def mic08(spark, d):
    return M.value_area(M.profile(ticks(spark, d)))


@query("mic10_trade_sizes", _win(86400) + """SELECT symbol, bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume, round(avg(q), 6) AS mean, round(quantile_cont(CAST(q AS DOUBLE), 0.5), 6) AS median, round(stddev_pop(q), 6) AS std, CAST(min(q) AS DOUBLE) AS min, CAST(max(q) AS DOUBLE) AS max,
 round(quantile_cont(CAST(q AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST(q AS DOUBLE), 0.75), 6) AS p75, round(quantile_cont(CAST(q AS DOUBLE), 0.95), 6) AS p95 FROM w GROUP BY symbol, bucket""")
def mic10(spark, d):
    return M.windowed(ticks(spark, d), M.size_metrics(), 86400)


@query("mic11_volume_clusters", _win(86400) + """, s AS (SELECT symbol, bucket, date_trunc('hour', ts) AS h, CAST(sum(q) AS DOUBLE) AS v FROM w GROUP BY 1, 2, 3), m AS (SELECT *, avg(v) OVER (PARTITION BY symbol, bucket) AS mu, stddev_pop(v) OVER (PARTITION BY symbol, bucket) AS sd FROM s)
SELECT symbol, bucket, count(*) AS pieces, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, max(v) AS max, min(v) AS min, count(*) FILTER (WHERE v > mu + 2 * sd) AS bursts, count(*) FILTER (WHERE v < mu - 2 * sd) AS quiet FROM m GROUP BY symbol, bucket""")
def mic11(spark, d):
    return M.volume_clusters(ticks(spark, d)).drop("burst_rate", "first_half", "second_half")


@query("mic13_win26_momentum", _win(86400) + """, k AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC, trade_id DESC) AS k FROM w), a AS (SELECT symbol, bucket, max(CASE WHEN k = 1 THEN p END) AS a, max(CASE WHEN k = 10 THEN p END) AS b, max(CASE WHEN k = 11 THEN p END) AS c, max(CASE WHEN k = 20 THEN p END) AS e FROM k GROUP BY symbol, bucket)
SELECT symbol, bucket, round((a - b) / b, 6) AS momentum, round((a - b) / b - (c - e) / e, 6) AS acceleration FROM a""")
def mic13(spark, d):
    return M.momentum(ticks(spark, d)).select("symbol", "bucket", "momentum", "acceleration")


@query("win24_tick_frequency", _win(3600) + """, l AS (SELECT symbol, bucket, CAST(p <> lag(p) OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) AS INTEGER) AS c FROM w) SELECT symbol, bucket, round(avg(c), 6) AS tick_frequency FROM l GROUP BY symbol, bucket""")
def win24(spark, d):
    return M.tick_frequency(ticks(spark, d))


@query("mic15_trailing_windows", """, w AS (SELECT t.*, cents / 100.0 AS p, s FROM t, (SELECT unnest([3600, 21600, 86400]) AS s) WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' AND epoch_us(ts) >= epoch_us(TIMESTAMP '2024-01-20 12:00:00') - s * 1000000::BIGINT),
 k AS (SELECT *, row_number() OVER (PARTITION BY symbol, s ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol, s ORDER BY ts DESC, trade_id DESC) AS z FROM w)
SELECT symbol, CAST(s AS INTEGER) AS window_s, count(*) AS n, round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS std, min(p) AS min, max(p) AS max, round(quantile_cont(p, 0.5), 6) AS median, max(CASE WHEN a = 1 THEN p END) AS first, max(CASE WHEN z = 1 THEN p END) AS last,
 round(max(CASE WHEN z = 1 THEN p END) - max(CASE WHEN a = 1 THEN p END), 6) AS change FROM k GROUP BY symbol, s""")
def mic15(spark, d):
    w = L.trailing_statistics(ticks(spark, d), datetime(2024, 1, 20, 12), sizes=(3600, 21600, 86400))
    return w.select("symbol", "window_s", "n", "mean", "std", "min", "max", "median", "first", "last", "change")


_BOOK = """, ba AS (SELECT symbol, date, cents / 100.0 AS p, CAST(q AS DOUBLE) AS q, ts, row_number() OVER (PARTITION BY symbol, date ORDER BY price DESC, trade_id) AS a, row_number() OVER (PARTITION BY symbol, date ORDER BY price, trade_id) AS b FROM t) """


def books(spark, d):
    return M.books_from_ticks(ticks(spark, d))


@query("obk01_top_of_book", _BOOK + """, x AS (SELECT symbol, date, max(CASE WHEN b = 1 THEN p END) AS best_bid, max(CASE WHEN a = 1 THEN p END) AS best_ask FROM ba GROUP BY symbol, date)
SELECT symbol, date, best_bid, best_ask, round(best_ask - best_bid, 6) AS spread, round((best_ask + best_bid) / 2, 6) AS mid, round((best_ask - best_bid) / ((best_ask + best_bid) / 2) * 10000, 4) AS spread_bps FROM x""")
def obk01(spark, d):
    return M.top_of_book(books(spark, d)).select("symbol", "date", "best_bid", "best_ask", "spread", "mid", "spread_bps")


@query("obk02_depth", _BOOK + """, n AS (SELECT symbol, date, least(5, count(*)) AS n FROM ba GROUP BY symbol, date), l AS (SELECT symbol, date, unnest(range(1, CAST(n AS BIGINT) + 1)) AS level FROM n),
 x AS (SELECT l.symbol, l.date, level, sum(CASE WHEN b <= level THEN q ELSE 0 END) AS bid_depth, sum(CASE WHEN a <= level THEN q ELSE 0 END) AS ask_depth FROM l JOIN ba ON l.symbol = ba.symbol AND l.date = ba.date GROUP BY 1, 2, 3)
SELECT symbol, date, CAST(level AS INTEGER) AS level, bid_depth, ask_depth, round((bid_depth - ask_depth) / (bid_depth + ask_depth), 6) AS imbalance FROM x""")
def obk02(spark, d):
    return M.depth(books(spark, d)).select("symbol", "date", "level", "bid_depth", "ask_depth", "imbalance")


@query("obk03_weighted_spread", _BOOK + "SELECT symbol, date, round(sum(CASE WHEN a <= 5 THEN p * q END) / sum(CASE WHEN a <= 5 THEN q END) - sum(CASE WHEN b <= 5 THEN p * q END) / sum(CASE WHEN b <= 5 THEN q END), 6) AS weighted_spread FROM ba GROUP BY symbol, date")
def obk03(spark, d):
    return M.weighted_spread(books(spark, d)).select("symbol", "date", "weighted_spread")


@query("obk04_level_notionals", _BOOK + ", m AS (SELECT symbol, date, max(ts) FILTER (WHERE a <= 10 OR b <= 10) AS ts FROM ba GROUP BY symbol, date) SELECT ba.symbol, m.ts, CAST(b - 1 AS INTEGER) AS level, p AS price, q AS quantity, round(p * q, 4) AS notional, round(sum(p * q) OVER (PARTITION BY ba.symbol, ba.date ORDER BY b), 4) AS running FROM ba JOIN m ON ba.symbol = m.symbol AND ba.date = m.date WHERE b <= 10")
def obk04(spark, d):
    return M.level_notionals(books(spark, d))


@query("obk05_spread_statistics", _BOOK + """, x AS (SELECT symbol, max(ts) FILTER (WHERE a <= 10 OR b <= 10) AS ts, max(CASE WHEN b = 1 THEN p END) AS bb, max(CASE WHEN a = 1 THEN p END) AS aa FROM ba GROUP BY symbol, date), s AS (SELECT symbol, ts, round((aa - bb) / ((aa + bb) / 2) * 10000, 4) AS spread_bps FROM x)
SELECT symbol, ts, spread_bps, round(avg(spread_bps) OVER w, 4) AS avg_bps, min(spread_bps) OVER w AS min_bps, max(spread_bps) OVER w AS max_bps FROM s WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""")
def obk05(spark, d):
    return M.spread_statistics(books(spark, d))


@query("obk06_last_book_per_week", _BOOK + ", m AS (SELECT symbol, date, max(ts) FILTER (WHERE a <= 10 OR b <= 10) AS ts, count(*) AS n FROM ba GROUP BY symbol, date), k AS (SELECT *, date_trunc('week', ts) AS wk, row_number() OVER (PARTITION BY symbol, to_timestamp(CAST(floor(epoch(ts) / 604800) * 604800 AS BIGINT)) ORDER BY ts DESC) AS k FROM m) SELECT symbol, ts, CAST(least(10, n) AS INTEGER) AS levels FROM k WHERE k = 1")
def obk06(spark, d):
    return M.last_book(books(spark, d), 604800).select("symbol", "ts", F.size("bids").alias("levels"))
