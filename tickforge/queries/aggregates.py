"""Queries on retrieval, aggregates, top-k and sets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..operators import stats as S
from ..operators import ticks as K
from ..operators.selection import exact_quantiles
from ..registry import query
from ..schema import table, ticks

START, END = datetime(2024, 1, 5), datetime(2024, 1, 20, 12)
RANGE = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'"


@query("flt01_ticks_range", f"SELECT trade_id, ts, price, quantity FROM t WHERE symbol = 'click' AND {RANGE} ORDER BY ts, trade_id LIMIT 100")
def flt01(spark, d):
    return K.select_ticks(ticks(spark, d), "click", start=START, end=END, limit=100, columns=["trade_id", "ts", "price", "quantity"])


@query("flt02_last_days", f"SELECT symbol, count(*) AS n FROM t WHERE {RANGE.replace('2024-01-05 00:00:00', '2024-01-13 12:00:00')} GROUP BY symbol")
def flt02(spark, d):
    return K.last_days(ticks(spark, d), END).groupBy("symbol").agg(F.count("*").alias("n"))


@query("flt03_recent_window", "SELECT symbol, trade_id, price FROM t WHERE ts >= TIMESTAMP '2024-01-20 11:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'")
def flt03(spark, d):
    return K.recent_window(ticks(spark, d), END, 3600).select("symbol", "trade_id", "price")


@query("flt04_symbols_in", "SELECT symbol, date, count(*) AS n FROM t WHERE symbol IN ('click', 'view') AND date <= DATE '2024-01-20' GROUP BY symbol, date")
def flt04(spark, d):
    return K.select_ticks(ticks(spark, d), symbols=["click", "view"]).where("date <= date'2024-01-20'").groupBy("symbol", "date").agg(F.count("*").alias("n"))


@query("flt05_typed_projection", "SELECT trade_id, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms FROM t")
def flt05(spark, d):
    return ticks(spark, d).select("trade_id", F.col("price").cast("double"), F.col("quantity").cast("double"), F.unix_millis("ts").alias("ms"))


@query("flt06_dollar_volume_side", "SELECT trade_id, CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS side, cents * q / 100.0 AS dollar_volume FROM t")
def flt06(spark, d):
    return K.with_dollar_volume(ticks(spark, d)).select("trade_id", "side", F.col("dollar_volume").cast("double").alias("dollar_volume"))


@query("flt07_predicate", "SELECT count(*) AS n FROM t WHERE price > 100 AND quantity < 5")
def flt07(spark, d):
    return K.where(ticks(spark, d), "price > 100 and quantity < 5").agg(F.count("*").alias("n"))


@query("flt12_page_since", f"SELECT trade_id, ts FROM t WHERE symbol = 'view' AND (ts > TIMESTAMP '2024-01-05 00:00:00') ORDER BY ts, trade_id LIMIT 50")
def flt12(spark, d):
    return K.since(ticks(spark, d), "view", START, 1 << 62, 50).select("trade_id", "ts")


@query("src13_new_since_cursor", "SELECT symbol, count(*) AS n FROM t WHERE trade_id > 500 OR symbol NOT IN ('click', 'view') GROUP BY symbol")
def src13(spark, d):
    t = ticks(spark, d)
    cursors = t.where("trade_id <= 500 and symbol in ('click', 'view')").groupBy("symbol").agg(F.lit(500).cast("long").alias("last_id"))
    return K.new_since(t, cursors).groupBy("symbol").agg(F.count("*").alias("n"))


@query("src14_drop_tail", f"SELECT count(*) AS n, max(trade_id) AS last_id FROM t WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def src14(spark, d):
    return K.drop_incomplete_tail(ticks(spark, d), END).agg(F.count("*").alias("n"), F.max("trade_id").alias("last_id"))


_OHLCV = """SELECT symbol, {b} AS bucket, arg_min(price, (ts, trade_id)) AS open, max(price) AS high, min(price) AS low,
 arg_max(price, (ts, trade_id)) AS close, sum(quantity) AS volume, count(*) AS trades FROM t GROUP BY 1, 2"""


def _bucket(width: int) -> str:
    return f"make_timestamp(CAST(epoch_us(ts) // {width * 10**6} * {width * 10**6} AS BIGINT))"


def _ohlcv_query(interval: str, sql_bucket: str) -> None:
    sql = f"""SELECT symbol, bucket, min(CASE WHEN a = 1 THEN price END) AS open, max(price) AS high, min(price) AS low, min(CASE WHEN z = 1 THEN price END) AS close,
 sum(quantity) AS volume, count(*) AS trades FROM (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts, trade_id) AS a,
 row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC, trade_id DESC) AS z FROM (SELECT *, {sql_bucket} AS bucket FROM t)) GROUP BY symbol, bucket"""

    @query(f"agg01_ohlcv_{interval}", sql)
    def run(spark, d):
        return S.ohlcv(ticks(spark, d), interval)


for _i, _w in (("1m", 60), ("5m", 300), ("15m", 900), ("30m", 1800), ("1h", 3600), ("4h", 14400), ("1d", 86400)):
    _ohlcv_query(_i, f"to_timestamp(CAST(floor(epoch(ts) / {_w}) * {_w} AS BIGINT))::TIMESTAMP")
_ohlcv_query("1w", "date_trunc('week', ts)::TIMESTAMP")
_ohlcv_query("1M", "date_trunc('month', ts)::TIMESTAMP")


@query("agg03_symbol_stats", """SELECT symbol, count(*) AS trade_count, min(price) AS min_price, max(price) AS max_price, round(avg(cents) / 100, 6) AS avg_price, sum(quantity) AS total_volume,
 count(*) FILTER (WHERE is_buyer_maker) AS sell_count, count(*) FILTER (WHERE NOT is_buyer_maker) AS buy_count, min(ts) AS first_trade_time, max(ts) AS last_trade_time FROM t GROUP BY symbol""")
def agg03(spark, d):
    return S.symbol_stats(ticks(spark, d))


@query("agg04_derived_stats", """, s AS (SELECT symbol, min(price) lo, max(price) hi, count(*) FILTER (WHERE is_buyer_maker) AS sells, count(*) FILTER (WHERE NOT is_buyer_maker) AS buys FROM t GROUP BY symbol)
SELECT symbol, round(CAST(buys AS DOUBLE) / nullif(sells, 0), 6) AS buy_sell_ratio, hi - lo AS price_range, round(CAST(hi - lo AS DOUBLE) / CAST(lo AS DOUBLE) * 100, 6) AS price_change_pct,
 buys - sells AS net_flow, round(CAST(buys - sells AS DOUBLE) / (buys + sells), 6) AS imbalance FROM s""")
def agg04(spark, d):
    return S.derived_stats(S.symbol_stats(ticks(spark, d)))


_PROFILE = """, r AS (SELECT symbol, min(price) AS lo, max(price) AS hi FROM t GROUP BY symbol),
 b AS (SELECT t.*, CASE WHEN hi = lo THEN 0 ELSE CAST(floor((CAST(price AS DOUBLE) - CAST(lo AS DOUBLE)) / (CAST(hi - lo AS DOUBLE) / 50)) AS BIGINT) END AS bin FROM t JOIN r ON t.symbol = r.symbol),
 p AS (SELECT symbol, bin, min(price) AS min_price, max(price) AS max_price, round(avg(cents) / 100, 6) AS avg_price, sum(quantity) AS volume, count(*) AS trades FROM b GROUP BY symbol, bin)
"""


@query("agg06_volume_profile", _PROFILE + "SELECT * FROM p")
def agg06(spark, d):
    return S.volume_profile(ticks(spark, d))


@query("top05_high_volume_nodes", _PROFILE + "SELECT symbol, bin, volume FROM p ORDER BY volume DESC, symbol, bin LIMIT 5")
def top05(spark, d):
    return S.high_volume_nodes(S.volume_profile(ticks(spark, d))).select("symbol", "bin", "volume")


@query("top09_point_of_control", _PROFILE + "SELECT symbol, bin AS poc_bin, volume AS poc_volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, bin) AS k FROM p) WHERE k = 1")
def top09(spark, d):
    return S.point_of_control(S.volume_profile(ticks(spark, d)))


@query("agg07_data_summary", "SELECT 'ticks' AS table_name, count(*) AS records, count(DISTINCT symbol) AS symbols, min(ts) AS first_time, max(ts) AS last_time FROM t")
def agg07(spark, d):
    return S.table_summary({"ticks": ticks(spark, d)})


@query("agg08_list_data", """SELECT 'ticks' AS table_name, symbol, count(*) AS records, min(ts) AS first_time, max(ts) AS last_time, CAST(date_diff('day', min(ts), max(ts)) AS INTEGER) AS days, count(*) * 100 AS est_bytes FROM t GROUP BY symbol""")
def agg08(spark, d):
    return S.list_data({"ticks": ticks(spark, d)})


@query("agg09_daily_summary", "SELECT symbol, date, count(*) AS trades, min(price) AS min_price, max(price) AS max_price, sum(quantity) AS volume FROM t GROUP BY symbol, date")
def agg09(spark, d):
    return S.daily_summary(ticks(spark, d))


@query("agg10_hourly_change", """, x AS (SELECT *, date_trunc('hour', ts) AS hour FROM t),
 y AS (SELECT *, row_number() OVER (PARTITION BY symbol, hour ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol, hour ORDER BY ts DESC, trade_id DESC) AS z FROM x),
 h AS (SELECT symbol, hour, max(CASE WHEN a = 1 THEN price END) AS open, max(CASE WHEN z = 1 THEN price END) AS close FROM y GROUP BY symbol, hour)
SELECT symbol, hour, open, close, round(CAST(close - open AS DOUBLE) / CAST(open AS DOUBLE) * 100, 6) AS change_pct FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY hour DESC) AS k FROM h) WHERE k <= 24""")
def agg10(spark, d):
    return S.hourly_change(ticks(spark, d))


@query("agg11_pressure", """SELECT symbol, count(*) FILTER (WHERE is_buyer_maker) AS sells, count(*) FILTER (WHERE NOT is_buyer_maker) AS buys,
 round(CAST(count(*) FILTER (WHERE NOT is_buyer_maker) AS DOUBLE) / count(*) * 100, 2) AS buy_pct FROM t GROUP BY symbol""")
def agg11(spark, d):
    return S.pressure_summary(ticks(spark, d))


@query("agg12_progress", "SELECT symbol, count(*) AS trades, max(ts) AS latest, max(CASE WHEN z = 1 THEN trade_id END) AS latest_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS z FROM t) GROUP BY symbol")
def agg12(spark, d):
    return S.progress(ticks(spark, d))


_SIDES = """coalesce(sum(q) FILTER (WHERE NOT is_buyer_maker), 0) AS bv, coalesce(sum(q) FILTER (WHERE is_buyer_maker), 0) AS sv,
 coalesce(sum(cents * q) FILTER (WHERE NOT is_buyer_maker), 0) AS bd, coalesce(sum(cents * q) FILTER (WHERE is_buyer_maker), 0) AS sd,
 count(*) FILTER (WHERE NOT is_buyer_maker) AS b, count(*) FILTER (WHERE is_buyer_maker) AS s, sum(cents * q) AS dv, sum(q) AS v, count(*) AS n, avg(cents) / 100 AS m,
 stddev_samp(cents / 100.0) AS sd_p, min(price) AS lo, max(price) AS hi"""


@query("agg13_streaming_stats", f""", x AS (SELECT symbol, {_SIDES} FROM t GROUP BY symbol)
SELECT symbol, n AS trades, CAST(v AS DOUBLE) AS volume, round(m, 6) AS mean_price, round(sd_p, 6) AS std_price, lo AS min_price, hi AS max_price, hi - lo AS price_range, b AS buys, s AS sells,
 CAST(bv AS DOUBLE) AS buy_volume, CAST(sv AS DOUBLE) AS sell_volume, round(CAST(b AS DOUBLE) / nullif(s, 0), 6) AS count_ratio, round(CAST(bv AS DOUBLE) / nullif(sv, 0), 6) AS volume_ratio, round(dv / 100.0 / v, 6) AS vwap FROM x""")
def agg13(spark, d):
    s = S.streaming_stats(ticks(spark, d))
    return s.withColumns({c: F.col(c).cast("double") for c in ("volume", "buy_volume", "sell_volume")})


@query("agg14_vwap", "SELECT symbol, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap FROM t GROUP BY symbol")
def agg14(spark, d):
    return ticks(spark, d).groupBy("symbol").agg(dbl(S.vwap()).alias("vwap"))


@query("agg15_side_summary", """SELECT symbol, CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS side, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume, round(avg(q), 6) AS mean_quantity, round(sum(cents * q) / 100.0, 4) AS dollars,
 round(avg(cents * q) / 100, 6) AS mean_dollars, round(avg(cents) / 100, 6) AS mean_price, round(stddev_samp(cents / 100.0), 6) AS std_price FROM t GROUP BY 1, 2""")
def agg15(spark, d):
    return S.side_summary(ticks(spark, d)).withColumn("volume", F.col("volume").cast("double"))


@query("agg16_dollar_imbalance", f", x AS (SELECT symbol, {_SIDES} FROM t GROUP BY symbol) SELECT symbol, round(CAST(bd - sd AS DOUBLE) / dv, 6) AS dollar_imbalance FROM x")
def agg16(spark, d):
    return ticks(spark, d).groupBy("symbol").agg(dbl(S.dollar_imbalance()).alias("dollar_imbalance"))


_B = "to_timestamp(CAST(floor(epoch(ts) / {w}) * {w} AS BIGINT))::TIMESTAMP AS bucket"


@query("agg17_order_flow_windows", f""", x AS (SELECT symbol, bucket, {_SIDES} FROM (SELECT *, {_B.format(w=300)} FROM t) GROUP BY symbol, bucket)
SELECT symbol, bucket, b AS buys, s AS sells, CAST(bv AS DOUBLE) AS buy_volume, CAST(sv AS DOUBLE) AS sell_volume, round(bd / 100.0, 4) AS buy_dollars, round(sd / 100.0, 4) AS sell_dollars, round(dv / 100.0 / v, 6) AS vwap,
 round(CAST(bv - sv AS DOUBLE) / v, 6) AS order_imbalance, round(CAST(b - s AS DOUBLE) / n, 6) AS trade_imbalance, round(CAST(bd - sd AS DOUBLE) / dv, 6) AS dollar_imbalance FROM x""")
def agg17(spark, d):
    s = S.order_flow_windows(ticks(spark, d))
    return s.withColumns({c: F.col(c).cast("double") for c in ("buy_volume", "sell_volume")})


@query("agg18_liquidity_windows", f""", x AS (SELECT symbol, bucket, avg(q) AS mq, {_SIDES} FROM (SELECT *, {_B.format(w=3600)} FROM t) GROUP BY symbol, bucket)
SELECT symbol, bucket, n AS trades, round(mq, 6) AS mean_size, round(sd_p, 6) AS price_std, hi - lo AS price_range, round(m, 6) AS mean_price, round(n / (coalesce(sd_p, 1.0) + 0.000001), 4) AS liquidity FROM x""")
def agg18(spark, d):
    return S.liquidity_windows(ticks(spark, d), "1h")


_FL = ", y AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS a, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS z FROM t), x AS (SELECT symbol, max(CASE WHEN z = 1 THEN price END) AS last, max(CASE WHEN a = 1 THEN price END) AS open, max(price) AS high, min(price) AS low FROM y GROUP BY symbol) "


@query("agg19_price_tracker", _FL + "SELECT *, round(CAST(last - open AS DOUBLE) / CAST(open AS DOUBLE) * 100, 6) AS change_pct FROM x")
def agg19(spark, d):
    return S.price_tracker(ticks(spark, d))


@query("agg20_price_alert", _FL + "SELECT symbol, last, last > 100 AS above, low <= 100 AND high >= 100 AS touched, round((CAST(last AS DOUBLE) - 100) / 100 * 100, 6) AS distance_pct FROM x")
def agg20(spark, d):
    return S.price_alert(ticks(spark, d), 100.0)


@query("agg21_multi_timeframe_trend", _FL + """, c AS (SELECT symbol, CAST(last AS DOUBLE) / CAST(open AS DOUBLE) * 100 - 100 AS ch FROM x)
SELECT symbol, i AS interval, round(ch, 4) AS change_pct, CASE WHEN ch > 0 THEN 'bullish' ELSE 'bearish' END AS trend FROM c, (SELECT unnest(['1h', '4h', '1d']) AS i)""")
def agg21(spark, d):
    return S.multi_timeframe_trend(ticks(spark, d))


@query("agg23_data_density", "SELECT symbol, count(*) AS records, round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0), 4) AS per_hour FROM t GROUP BY symbol")
def agg23(spark, d):
    return S.data_density(ticks(spark, d))


@query("agg24_null_duplicate_counts", "SELECT count(*) AS records, count(*) - count(price) AS null_price, count(*) - count(quantity) AS null_quantity, count(*) - count(ts) AS null_ts, count(*) - count(DISTINCT (symbol, trade_id)) AS duplicate_ids FROM t")
def agg24(spark, d):
    return S.null_and_duplicate_counts(ticks(spark, d))


@query("agg25_describe", """SELECT symbol, count(*) AS n, round(avg(cents) / 100, 6) AS mean, round(stddev_samp(cents / 100.0), 6) AS std, round(min(cents) / 100.0, 6) AS min, round(quantile_cont(cents / 100.0, 0.25), 6) AS p25,
 round(quantile_cont(cents / 100.0, 0.5), 6) AS p50, round(quantile_cont(cents / 100.0, 0.75), 6) AS p75, round(quantile_cont(cents / 100.0, 0.95), 6) AS p95, round(max(cents) / 100.0, 6) AS max FROM t GROUP BY symbol""")
def agg25(spark, d):
    return S.describe(ticks(spark, d), "price")


@query("agg26_correlations", """, c AS (SELECT symbol, cents / 100.0 AS p, CAST(q AS DOUBLE) AS q, cents * q / 100.0 AS dv FROM t)
SELECT symbol, 'price' AS a, 'quantity' AS b, round(corr(p, q), 5) AS corr FROM c GROUP BY symbol UNION ALL SELECT symbol, 'price', 'dollar_volume', round(corr(p, dv), 5) FROM c GROUP BY symbol
UNION ALL SELECT symbol, 'quantity', 'dollar_volume', round(corr(q, dv), 5) FROM c GROUP BY symbol""")
def agg26(spark, d):
    return S.correlations(K.with_dollar_volume(ticks(spark, d)), ["price", "quantity", "dollar_volume"])


@query("agg27_moments", "SELECT symbol, count(*) AS n, round(avg(cents) / 100, 6) AS mean, round(stddev_samp(cents / 100.0), 6) AS std, round(skewness(cents / 100.0), 5) AS skew, round(kurtosis(cents / 100.0), 4) AS kurtosis FROM t GROUP BY symbol")
def agg27(spark, d):
    return S.moments(ticks(spark, d), "price")


@query("agg28_jarque_bera", """, m AS (SELECT symbol, avg(cents / 100.0) AS mu, count(*) AS n FROM t GROUP BY symbol),
 c AS (SELECT t.symbol, n, avg((cents / 100.0 - mu) ** 2) AS m2, avg((cents / 100.0 - mu) ** 3) AS m3, avg((cents / 100.0 - mu) ** 4) AS m4 FROM t JOIN m ON t.symbol = m.symbol GROUP BY t.symbol, n),
 j AS (SELECT symbol, n, n / 6.0 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4) AS jb FROM c) SELECT symbol, n, round(jb, 3) AS jb, round(exp(-jb / 2), 5) AS p_value FROM j""")
def agg28(spark, d):
    return S.jarque_bera(ticks(spark, d), "price")


@query("agg30_value_counts", "SELECT symbol, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM t GROUP BY symbol")
def agg30(spark, d):
    return S.value_counts(ticks(spark, d), "symbol")


@query("agg32_table_info", """SELECT c AS column_name, y AS column_type, records, first_time, last_time FROM (SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS c,
 unnest(['bigint', 'timestamp_ntz', 'bigint', 'string', 'double', 'string']) AS y), (SELECT count(*) AS records, min(ts) AS first_time, max(ts) AS last_time FROM events)""", raw=True)
def agg32(spark, d):
    return S.table_info(table(spark, d, "events"), "ts")


@query("agg34_chunk_counts", f"SELECT symbol, bucket, count(*) AS n FROM (SELECT *, {_B.format(w=3600)} FROM t) GROUP BY 1, 2")
def agg34(spark, d):
    return S.chunk_counts(ticks(spark, d))


@query("agg35_series_stats", "SELECT symbol, count(*) AS n, round(avg(cents) / 100, 6) AS mean, round(stddev_pop(cents / 100.0), 6) AS std_pop, round(min(cents) / 100.0, 6) AS min, round(max(cents) / 100.0, 6) AS max, round(sum(cents) / 100.0, 4) AS sum, round(quantile_cont(cents / 100.0, 0.5), 6) AS median FROM t GROUP BY symbol")
def agg35(spark, d):
    return S.series_stats(ticks(spark, d), "price").drop("p25", "p75")


@query("agg29_exact_quantiles", "SELECT symbol, date, round(quantile_cont(CAST(price AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST(price AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST(price AS DOUBLE), 0.75), 6) AS p75, round(quantile_cont(CAST(price AS DOUBLE), 0.95), 6) AS p95 FROM t GROUP BY symbol, date")
def agg29(spark, d):
    q = exact_quantiles(ticks(spark, d), "price", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}, ("symbol", "date"))
    return q.select("symbol", "date", *[dbl(c).alias(c) for c in ("p25", "p50", "p75", "p95")])


@query("agg29_refined_quantiles", "SELECT l_returnflag AS flag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1", raw=True)
def agg29_refined(spark, d):
    """Large groups: buckets are refined until 1,000 rows are left of each."""
    t = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    q = exact_quantiles(t, "l_extendedprice", {"p01": 0.01, "p50": 0.5, "p99": 0.99}, ("flag",), small=1000)
    return q.select("flag", *[dbl(c).alias(c) for c in ("p01", "p50", "p99")])


@query("agg35_series_quartiles", "SELECT symbol, round(quantile_cont(cents * q / 100.0, 0.25), 6) AS p25, round(quantile_cont(cents * q / 100.0, 0.5), 6) AS median, round(quantile_cont(cents * q / 100.0, 0.75), 6) AS p75, round(stddev_pop(cents * q / 100.0), 6) AS std_pop FROM t GROUP BY symbol")
def agg35_quartiles(spark, d):
    t = ticks(spark, d).withColumn("worth", F.col("price") * F.col("quantity"))
    return S.series_stats(t, "worth").select("symbol", "p25", "median", "p75", "std_pop")


@query("top02_latest_trades", "SELECT symbol, trade_id, ts FROM t ORDER BY ts DESC, trade_id DESC LIMIT 100")
def top02(spark, d):
    return K.latest(ticks(spark, d)).select("symbol", "trade_id", "ts")


@query("top08_last_n_per_symbol", "SELECT symbol, trade_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS k FROM t) WHERE k <= 20")
def top08(spark, d):
    return K.last_n_per_symbol(ticks(spark, d), 20).select("symbol", "trade_id", "ts")


@query("set01_distinct_symbols", "SELECT DISTINCT symbol FROM t")
def set01(spark, d):
    return K.distinct_symbols(ticks(spark, d))


@query("set02_deduplicate", "SELECT symbol, count(*) AS n, sum(trade_id) AS ids FROM t GROUP BY symbol")
def set02(spark, d):
    t = ticks(spark, d)
    twice = t.unionByName(t.where("trade_id % 7 = 0").withColumn("ts", F.col("ts") + F.expr("interval 1 second")))
    return K.deduplicate(twice).join(t, ["symbol", "trade_id", "ts"], "left_semi").groupBy("symbol").agg(F.count("*").alias("n"), F.sum("trade_id").alias("ids"))


@query("set03_keep_latest", "SELECT symbol, count(*) AS n, sum(CASE WHEN trade_id % 7 = 0 THEN 1 ELSE 0 END) AS moved FROM t GROUP BY symbol")
def set03(spark, d):
    t = ticks(spark, d).withColumn("version", F.lit(1))
    twice = t.unionByName(t.where("trade_id % 7 = 0").withColumn("version", F.lit(2)))
    return K.deduplicate(twice, order=("version",), keep="last").groupBy("symbol").agg(F.count("*").alias("n"), F.count_if(F.col("version") == 2).alias("moved"))


@query("set06_coverage", "SELECT CAST(6 AS BIGINT) AS expected, count(DISTINCT symbol) AS present, 6 - count(DISTINCT symbol) AS missing, round(count(DISTINCT symbol) * 100.0 / 6, 6) AS coverage_pct FROM t")
def set06(spark, d):
    t = ticks(spark, d)
    expected = t.select("symbol").distinct().unionByName(t.agg(F.lit("absent").alias("symbol")))
    return K.coverage(expected, t)


@query("win25_train_test", """, n AS (SELECT symbol, count(*) AS n FROM t GROUP BY symbol), r AS (SELECT t.symbol, trade_id, n, row_number() OVER (PARTITION BY t.symbol ORDER BY ts, trade_id) AS rn FROM t JOIN n ON t.symbol = n.symbol)
SELECT symbol, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split, count(*) AS n, max(rn) AS last_rn FROM r GROUP BY 1, 2""")
def win25(spark, d):
    from ..plans.prefix import row_numbers

    t = row_numbers(K.train_test(ticks(spark, d)), "rn")
    return t.groupBy("symbol", "split").agg(F.count("*").alias("n"), F.max("rn").alias("last_rn"))
