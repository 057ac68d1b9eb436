"""Queries on operators that the other modules use only inside others, and on the rest of sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..operators import bars as B
from ..operators import micro as M
from ..operators import series as R
from ..operators import stats as S
from ..operators import strategy as G
from ..operators import ticks as K
from ..registry import query
from ..schema import ticks
from ..sources import files, raw
from ..streaming import analyzers, streams
from .bars import ADAPTIVE_SQL, STATS_SQL
from .quality import _BOOK, _VB, _VS, _win
from .series import _C, _R, _W, _frac_sql, candles

_ALL = "SELECT symbol, count(*) AS n, sum(price) AS total FROM t GROUP BY symbol"


def _sums(df):
    return df.groupBy("symbol").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query("src02_nested_folders", _ALL)
def src02(spark, d):
    path = files.shared_path(spark, "nested")
    t = ticks(spark, d)
    t.withColumns({"_d": F.col("date"), "_s": F.col("symbol")}).write.partitionBy("_d", "_s").parquet(path)
    return _sums(files.read_nested(spark, path))


def _json(t, **fields):
    return t.select("symbol", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value"))


def _agg_json(t):
    s = lambda c: F.col(c).cast("string")
    return _json(t, s=F.col("symbol"), a=F.col("trade_id"), p=s("price"), q=s("quantity"), T=F.unix_millis("ts"), m=F.col("is_buyer_maker"))


@query("src07_agg_trade_events", "SELECT symbol, trade_id, price, quantity, is_buyer_maker, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms FROM t")
def src07(spark, d):
    return raw.agg_trade_events(_agg_json(ticks(spark, d))).select("symbol", "trade_id", "price", "quantity", "is_buyer_maker", F.unix_millis("ts").alias("ms"))


@query("src08_depth_events", "SELECT symbol, trade_id AS last_update_id, price AS best_bid, quantity AS bid_quantity, CAST(price + 1 AS DECIMAL(18,8)) AS best_ask, CAST(1 AS INTEGER) AS levels FROM t")
def src08(spark, d):
    s = lambda c: F.col(c).cast("string")
    side = lambda p, q: F.array(F.array(p.cast("string"), q))
    t = ticks(spark, d)
    e = raw.depth_events(_json(t, s=F.col("symbol"), E=F.unix_millis("ts"), U=F.col("trade_id"), u=F.col("trade_id"), b=side(F.col("price"), s("quantity")), a=side((F.col("price") + 1).cast("decimal(18,8)"), s("quantity"))))
    return e.select("symbol", "last_update_id", F.get("bids", F.lit(0))["price"].alias("best_bid"), F.get("bids", F.lit(0))["quantity"].alias("bid_quantity"), F.get("asks", F.lit(0))["price"].alias("best_ask"), F.size("asks").alias("levels"))


@query("snk03_staging_to_dates", "SELECT date, symbol, count(*) AS n, sum(price) AS total FROM t GROUP BY date, symbol")
def snk03(spark, d):
    staging, path = files.shared_path(spark, "staging"), files.shared_path(spark, "dated")
    t = ticks(spark, d).drop("date")
    t.where("trade_id % 2 = 0").write.parquet(staging)
    files.reorganise_staging(spark, staging, path)
    t.where("trade_id % 2 = 1").write.mode("append").parquet(staging)
    files.reorganise_staging(spark, staging, path)
    return files.read_ticks(spark, path).groupBy("date", "symbol").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query("snk04_export_parquet", "SELECT trade_id, symbol, price FROM t WHERE symbol = 'view' AND date >= DATE '2024-01-05'")
def snk04(spark, d):
    path = files.shared_path(spark, "export")
    files.export_parquet(ticks(spark, d), path, "symbol = 'view' and date >= date'2024-01-05'")
    return spark.read.parquet(path).select("trade_id", "symbol", "price")


@query("snk08_table_to_partitions", _ALL)
def snk08(spark, d):
    path = files.shared_path(spark, "converted")
    files.create_view(ticks(spark, d).drop("date"), "ticks_to_convert")
    files.write_ticks(spark.table("ticks_to_convert"), path)
    return _sums(files.read_ticks(spark, path))


@query("snk09_view", "SELECT symbol, min(price) AS low FROM t WHERE quantity > 2 GROUP BY symbol")
def snk09(spark, d):
    files.create_view(ticks(spark, d), "ticks_view")
    return spark.sql("SELECT symbol, min(price) AS low FROM ticks_view WHERE quantity > 2 GROUP BY symbol")


@query("snk11_json_report", "SELECT symbol, count(*) AS records, count(*) - count(DISTINCT trade_id) AS duplicates FROM t GROUP BY symbol")
def snk11(spark, d):
    path = files.shared_path(spark, "report")
    files.write_report(ticks(spark, d).groupBy("symbol").agg(F.count("*").alias("records"), (F.count("*") - F.count_distinct("trade_id")).alias("duplicates")), path)
    return spark.read.schema("symbol string, records long, duplicates long").json(path)


@query("snk12_stream_to_table", _ALL)
def snk12(spark, d):
    return _sums(streams.run_to_files(streams.stream_ticks(spark, d), "micro"))


@query("snk14_materialised_candles", _C + "SELECT symbol, bucket, open, high, low, close, volume FROM c")
def snk14(spark, d):
    c = candles(spark, d).select("symbol", "bucket", *[F.col(n).cast("double").alias(n) for n in ("open", "high", "low", "close", "volume")])
    return files.materialise(c, "candles_4h")


@query("flt09_column_mapping", "SELECT trade_id, price AS last_price, quantity AS size FROM t")
def flt09(spark, d):
    return K.rename(ticks(spark, d), {"price": "last_price", "quantity": "size"}).select("trade_id", "last_price", "size")


@query("flt10_drop_nulls", _R + "SELECT symbol, bucket, round(pct, 6) AS pct_change FROM r WHERE pct IS NOT NULL")
def flt10(spark, d):
    return K.drop_nulls(R.returns(candles(spark, d)), ["pct_change"]).select("symbol", "bucket", dbl("pct_change").alias("pct_change"))


@query("flt11_empty_buckets", ", b AS (SELECT symbol, date, sum(CASE WHEN q > 9 THEN q ELSE 0 END) AS volume FROM t GROUP BY symbol, date) SELECT symbol, date, CAST(volume AS DOUBLE) AS volume FROM b WHERE volume > 0")
def flt11(spark, d):
    v = ticks(spark, d).groupBy("symbol", "date").agg(F.sum(F.when(F.col("quantity") > 9, F.col("quantity").cast("double")).otherwise(0.0)).alias("volume"))
    return K.where(v, "volume > 0")


@query("jn06_aligned_series", _R + f"""SELECT symbol, bucket, max(close) AS price, max(round(pct, 6)) AS returns, max(fd) AS frac FROM (SELECT symbol, bucket, close, NULL AS pct, NULL AS fd FROM c UNION ALL SELECT symbol, bucket, NULL, pct, NULL FROM r WHERE pct IS NOT NULL
 UNION ALL SELECT * FROM (SELECT symbol, bucket, NULL, NULL, round({_frac_sql(0.4, 1e-2)}, 6) AS fd FROM c) WHERE fd IS NOT NULL) GROUP BY symbol, bucket""")
def jn06(spark, d):
    c = candles(spark, d)
    one = lambda df, n: df.select("symbol", "bucket", dbl(n).alias("v")).where("v is not null")
    return R.align({"price": one(c, "close"), "returns": one(R.returns(c), "pct_change"), "frac": one(R.fractional_difference(c, 0.4, 1e-2), "frac_diff")}, "v")


@query("jn08_coverage_anti_join", "SELECT DISTINCT symbol FROM t WHERE symbol NOT IN (SELECT symbol FROM t WHERE date > DATE '2024-01-10' AND symbol <> 'click')")
def jn08(spark, d):
    t = ticks(spark, d)
    return K.missing_symbols(K.distinct_symbols(t), t.where("date > date'2024-01-10' and symbol <> 'click'"))


@query("agg02_ohlcv_any_rule", _C.replace("14400", "5400") + "SELECT symbol, bucket, open, high, low, close FROM c")
def agg02(spark, d):
    return S.ohlcv(ticks(spark, d), "90m").select("symbol", "bucket", *[F.col(n).cast("double").alias(n) for n in ("open", "high", "low", "close")])


@query("agg05_raw_trade_stats", "SELECT symbol, count(*) AS trade_count, min(price) AS min_price, max(price) AS max_price, round(avg(cents) / 100, 6) AS avg_price, CAST(sum(q) AS DOUBLE) AS total_volume, count(*) FILTER (WHERE is_buyer_maker) AS sell_count FROM t GROUP BY symbol")
def agg05(spark, d):
    r = ticks(spark, d).select("symbol", F.col("trade_id").alias("id"), "price", F.col("quantity").alias("qty"), F.unix_millis("ts").alias("time"), F.col("is_buyer_maker").alias("isBuyerMaker"))
    return S.symbol_stats(K.raw_trades(r)).select("symbol", "trade_count", "min_price", "max_price", "avg_price", F.col("total_volume").cast("double").alias("total_volume"), "sell_count")


@query("agg28_dagostino", """, m AS (SELECT symbol, avg(cents / 100.0) AS mu, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY symbol),
 c AS (SELECT t.symbol, n, avg((cents / 100.0 - mu) ** 2) AS m2, avg((cents / 100.0 - mu) ** 3) AS m3, avg((cents / 100.0 - mu) ** 4) AS m4 FROM t JOIN m ON t.symbol = m.symbol GROUP BY t.symbol, n),
 g AS (SELECT symbol, n, m3 / m2 ** 1.5 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
   (m4 / m2 ** 2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS u, 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM c),
 h AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / sb ** 2)) AS a FROM g),
 z AS (SELECT symbol, n, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1, (1 - 2 / (9 * a) - sign((1 - 2 / a) / (1 + u * sqrt(2 / (a - 4)))) * abs((1 - 2 / a) / (1 + u * sqrt(2 / (a - 4)))) ** (1 / 3.0)) / sqrt(2 / (9 * a)) AS z2 FROM h)
SELECT symbol, CAST(n AS BIGINT) AS n, round(z1 ** 2 + z2 ** 2, 3) AS k2, round(exp(-(z1 ** 2 + z2 ** 2) / 2), 5) AS p_value FROM z""")
def agg28b(spark, d):
    return S.dagostino(ticks(spark, d), "price")


@query("agg33_storage_stats", "SELECT symbol, CAST(1 AS BIGINT) AS files, count(*) AS records FROM t GROUP BY symbol")
def agg33(spark, d):
    path = files.shared_path(spark, "stored")
    ticks(spark, d).repartition("symbol").write.partitionBy("symbol").parquet(path)
    return files.storage_stats(spark.read.parquet(path)).select("symbol", "files", "records")


@query("win09_vwap_deviation", _C + ", v AS (SELECT symbol, bucket, sum(cents * q) / 100.0 / sum(q) AS vwap FROM o GROUP BY symbol, bucket) SELECT c.symbol, c.bucket, round((close - vwap) / vwap * 100, 6) AS vwap_deviation FROM c JOIN v ON c.symbol = v.symbol AND c.bucket = v.bucket")
def win09(spark, d):
    t = M.with_bucket(ticks(spark, d), 14400)
    v = t.groupBy("symbol", "bucket").agg((F.sum(F.col("price") * F.col("quantity")).cast("double") / F.sum("quantity").cast("double")).alias("vwap"))
    return G.vwap_deviation(candles(spark, d).join(v, ["symbol", "bucket"])).select("symbol", "bucket", "vwap_deviation")


@query("top01_ordered_read", "SELECT trade_id, ts FROM t ORDER BY ts, trade_id LIMIT 50")
def top01(spark, d):
    return K.select_ticks(ticks(spark, d)).orderBy("ts", "trade_id").limit(50).select("trade_id", "ts")


@query("top03_latest_records", "SELECT trade_id, symbol FROM t ORDER BY ts DESC, trade_id DESC LIMIT 25")
def top03(spark, d):
    return K.latest(ticks(spark, d), 25).select("trade_id", "symbol")


@query("top04_latest_book", _BOOK + """, m AS (SELECT symbol, date, max(ts) FILTER (WHERE a <= 10 OR b <= 10) AS ts FROM ba GROUP BY symbol, date), k AS (SELECT symbol, date, ts, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS k FROM m)
SELECT k.symbol, k.ts, round(sum(CASE WHEN b <= 3 THEN q ELSE 0 END), 6) AS bid_quantity, round(sum(CASE WHEN a <= 3 THEN q ELSE 0 END), 6) AS ask_quantity FROM k JOIN ba ON k.symbol = ba.symbol AND k.date = ba.date WHERE k = 1 GROUP BY k.symbol, k.ts""")
def top04(spark, d):
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v["quantity"].cast("double"))
    return M.latest_book(M.books_from_ticks(ticks(spark, d)), 3).select("symbol", "ts", dbl(total("bids")).alias("bid_quantity"), dbl(total("asks")).alias("ask_quantity"))


@query("set04_first_per_timestamp", ", x AS (SELECT *, date_trunc('hour', ts) AS h FROM t), k AS (SELECT *, row_number() OVER (PARTITION BY symbol, h ORDER BY trade_id) AS k FROM x) SELECT symbol, h, trade_id FROM k WHERE k = 1")
def set04(spark, d):
    t = ticks(spark, d).withColumn("h", F.date_trunc("hour", "ts"))
    return K.deduplicate(t, ("symbol", "h"), ("trade_id",)).select("symbol", "h", "trade_id")


@query("set05_union_of_pieces", _ALL)
def set05(spark, d):
    t = ticks(spark, d)
    return _sums(K.union_all(t.where("trade_id % 3 = 0"), t.where("trade_id % 3 = 1").drop("date"), t.where("trade_id % 3 = 2")))


@query("scl01_milliseconds", "SELECT trade_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms, CAST(epoch_us(ts) // 1000 * 1000 AS BIGINT) AS us FROM t")
def scl01(spark, d):
    ms = F.unix_millis("ts")
    return ticks(spark, d).select("trade_id", ms.alias("ms"), F.unix_micros(F.timestamp_millis(ms)).alias("us"))


@query("scl12_symbol_strings", "SELECT upper(trim(' ' || symbol || ' ')) AS name, count(*) AS n FROM t WHERE symbol LIKE '%c%' AND symbol NOT LIKE 'p%' GROUP BY 1")
def scl12(spark, d):
    from ..functions.scalars import upper_symbol

    t = ticks(spark, d).where(F.col("symbol").like("%c%") & ~F.col("symbol").like("p%"))
    return t.groupBy(upper_symbol(F.concat(F.lit(" "), "symbol", F.lit(" "))).alias("name")).agg(F.count("*").alias("n"))


@query("mic06_book_liquidity", _BOOK + """, x AS (SELECT symbol, date, max(ts) FILTER (WHERE a <= 10 OR b <= 10) AS ts, max(CASE WHEN b = 1 THEN p END) AS best_bid, max(CASE WHEN a = 1 THEN p END) AS best_ask, sum(CASE WHEN a <= 5 THEN p * q END) / sum(CASE WHEN a <= 5 THEN q END) - sum(CASE WHEN b <= 5 THEN p * q END) / sum(CASE WHEN b <= 5 THEN q END) AS ws,
   sum(CASE WHEN b <= 5 THEN q ELSE 0 END) AS bid_depth, sum(CASE WHEN a <= 5 THEN q ELSE 0 END) AS ask_depth FROM ba GROUP BY symbol, date),
 k AS (SELECT *, to_timestamp(CAST(floor(epoch(ts) / 604800) * 604800 AS BIGINT))::TIMESTAMP AS bucket FROM x), l AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC) AS z FROM k)
SELECT symbol, bucket, best_bid, best_ask, round((best_ask - best_bid) / ((best_ask + best_bid) / 2) * 10000, 4) AS spread_bps, round(ws, 6) AS weighted_spread, bid_depth, ask_depth, round((bid_depth - ask_depth) / (bid_depth + ask_depth), 6) AS imbalance FROM l WHERE z = 1""")
def mic06(spark, d):
    return M.book_liquidity(M.books_from_ticks(ticks(spark, d)), 604800)


@query("mic07_profile_shape", _win(86400) + """, r AS (SELECT symbol, bucket, min(p) AS lo, max(p) AS hi, sqrt(greatest(sum(p * p * q) / sum(q) - (sum(p * q) / sum(q)) ** 2, 0)) AS sd FROM w GROUP BY symbol, bucket),
 b AS (SELECT w.symbol, w.bucket, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((p - lo) / ((hi - lo) / 20)) AS INTEGER), 19) END AS bin, CAST(sum(q) AS DOUBLE) AS v FROM w JOIN r ON w.symbol = r.symbol AND w.bucket = r.bucket GROUP BY 1, 2, 3),
 k AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY v DESC, bin) AS k FROM b), s AS (SELECT symbol, bucket, max(CASE WHEN k = 1 THEN bin END) AS poc_bin, round(sum(v * v) / sum(v) ** 2, 6) AS concentration FROM k GROUP BY symbol, bucket)
SELECT s.symbol, s.bucket, lo AS low, hi AS high, round(sd, 4) AS weighted_std, poc_bin, concentration FROM s JOIN r ON s.symbol = r.symbol AND s.bucket = r.bucket""")
def mic07(spark, d):
    return M.profile_shape(ticks(spark, d))


@query("mic10_large_and_small", _win(86400) + """, c AS (SELECT symbol, bucket, quantile_cont(CAST(q AS DOUBLE), 0.25) AS a, quantile_cont(CAST(q AS DOUBLE), 0.95) AS z FROM w GROUP BY symbol, bucket),
 r AS (SELECT *, count(*) OVER o AS n, avg(q) OVER o AS m, stddev_pop(q) OVER o AS s FROM w WINDOW o AS (PARTITION BY symbol, bucket ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING))
SELECT r.symbol, r.bucket, count(*) FILTER (WHERE n > 20 AND abs(round((q - m) / CASE WHEN s > 0.000000001 THEN s END, 5)) > 2) AS large_count, round(avg(CASE WHEN NOT is_buyer_maker THEN q END), 6) AS avg_buy, round(avg(CASE WHEN is_buyer_maker THEN q END), 6) AS avg_sell,
 round(count(*) FILTER (WHERE q <= a) * 100.0 / count(*), 6) AS small_pct, round(count(*) FILTER (WHERE q > z) * 100.0 / count(*), 6) AS large_pct FROM r JOIN c ON r.symbol = c.symbol AND r.bucket = c.bucket GROUP BY r.symbol, r.bucket""")
def mic10(spark, d):
    return M.large_and_small(ticks(spark, d))


#: A running value over each symbol's ticks, step by step: the reference form of the block-wise one.
def _steps(first: str, then: str, columns: str) -> str:
    return f""", k AS (SELECT symbol, trade_id, ts, q, cents / 100.0 AS p, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i, (cents - lag(cents) OVER (PARTITION BY symbol ORDER BY ts, trade_id)) / CAST(lag(cents) OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS DOUBLE) AS ch FROM t)
SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, trade_id, ts, p, i, {first} FROM k WHERE i = 1 UNION ALL SELECT k.symbol, k.trade_id, k.ts, k.p, k.i, {then} FROM s JOIN k ON k.symbol = s.symbol AND k.i = s.i + 1) SELECT {columns} FROM s)"""


_MOMENTUM = _steps("CAST(0.0 AS DOUBLE) AS m", "0.1 * coalesce(k.ch, 0) + 0.9 * s.m", "symbol, trade_id, ts, p, m")


@query("mic09_movement_levels", _MOMENTUM.replace("SELECT * FROM (WITH", ", e AS (SELECT * FROM (WITH") + """), b AS (SELECT *, to_timestamp(CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT))::TIMESTAMP AS bucket FROM e),
 z AS (SELECT *, row_number() OVER (PARTITION BY symbol, bucket ORDER BY ts DESC, trade_id DESC) AS z FROM b), g AS (SELECT symbol, bucket, round(max(CASE WHEN z = 1 THEN m END), 6) AS momentum, round(stddev_pop(p) / avg(p), 5) AS variation FROM z GROUP BY symbol, bucket)
SELECT *, CASE WHEN variation > 0.1 THEN 'high' WHEN variation > 0.05 THEN 'medium' ELSE 'low' END AS volatility_level FROM g""")
def mic09(spark, d):
    return G.movement_levels(ticks(spark, d))


@query("mic14_open_windows", "SELECT symbol, to_timestamp(CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT))::TIMESTAMP AS bucket, count(*) AS trades FROM t GROUP BY 1, 2")
def mic14(spark, d):
    s = streams.tumbling(streams.stream_ticks(spark, d), M.volume_metrics(), 3600)
    return streams.run_updates(s, ["symbol", "bucket"], "open").select("symbol", "bucket", "trades")


@query("str07_retention", ", r AS (SELECT *, max(ts) OVER (PARTITION BY symbol) AS top, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS k FROM t) SELECT symbol, trade_id FROM r WHERE epoch_us(top) - epoch_us(ts) <= 86400000000 AND k <= 10000")
def str07(spark, d):
    return streams.last_n(streams.stream_ticks(spark, d), 10_000, "retained", seconds=86400).select("symbol", "trade_id")


@query("str08_last_n_buffer", ", r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS k FROM t) SELECT symbol, trade_id, price FROM r WHERE k <= 20")
def str08(spark, d):
    return streams.last_n(streams.stream_ticks(spark, d), 20, "buffer").select("symbol", "trade_id", "price")


@query("str10_incremental_ingestion", _ALL)
def str10(spark, d):
    path, cursors = files.shared_path(spark, "ingested"), files.shared_path(spark, "cursors")
    t = ticks(spark, d)
    for upto in (300, 600, 1 << 62, 1 << 62):
        files.ingest_new(t.where(F.col("trade_id") < upto), path, cursors)
    return _sums(files.read_ticks(spark, path))


@query("str14_monitor", """, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS z FROM t)
SELECT symbol, count(*) FILTER (WHERE NOT is_buyer_maker) AS buys, count(*) FILTER (WHERE is_buyer_maker) AS sells, round(CAST(count(*) FILTER (WHERE NOT is_buyer_maker) - count(*) FILTER (WHERE is_buyer_maker) AS DOUBLE) / count(*), 6) AS imbalance,
 CAST(coalesce(sum(q) FILTER (WHERE NOT is_buyer_maker), 0) AS DOUBLE) AS buy_volume, CAST(coalesce(sum(q) FILTER (WHERE is_buyer_maker), 0) AS DOUBLE) AS sell_volume, round(avg(cents / 100.0), 6) AS mean_price, round(stddev_pop(cents / 100.0), 6) AS price_std, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap,
 string_agg(CASE WHEN z <= 5 THEN CAST(trade_id AS VARCHAR) END, ',' ORDER BY z) AS last_trades FROM r GROUP BY symbol""")
def str14(spark, d):
    now = streams.run_updates(streams.monitor(streams.stream_ticks(spark, d)), ["symbol"], "monitor")
    five = streams.last_n(streams.stream_ticks(spark, d), 5, "monitor-last").groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct(-F.unix_micros("ts"), -F.col("trade_id"), "trade_id"))).alias("l"))
    out = now.join(five.select("symbol", F.array_join(F.transform("l", lambda x: x["trade_id"].cast("string")), ",").alias("last_trades")), "symbol")
    return out.drop("delta", "uptime_seconds")


@query("str04_late_rows", ", m AS (SELECT max(ts) AS top FROM t) SELECT symbol, count(*) AS n FROM t, m WHERE ts > top - INTERVAL 10 SECOND - INTERVAL 2 DAY GROUP BY symbol")
def str04(spark, d):
    """Three batches: late rows are told by the watermark that the batch before the last one left, so the first two
    move it, and what the third one has of closed windows is dropped."""
    path = files.shared_path(spark, "late")
    t = ticks(spark, d).drop("date")
    limit = F.lit(t.agg(F.max("ts")).first()[0]) - F.expr("interval 2 days 10 seconds")
    for part in (t.where((F.col("ts") > limit) & (F.col("trade_id") % 2 == 0)), t.where((F.col("ts") > limit) & (F.col("trade_id") % 2 == 1)), t.where(F.col("ts") <= limit)):
        part.coalesce(1).write.mode("append").parquet(path)
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(path)
    w = streams.with_watermark(s).groupBy("symbol", "ts").agg(F.count("*").alias("c"))
    return streams.run_updates(w, ["symbol", "ts"], "late-out").groupBy("symbol").agg(F.sum("c").alias("n"))


@query("stg06_trade_costs", _C + f""", m AS (SELECT symbol, bucket, close, close < lag(close) OVER {_W} AS buy, close > lag(close) OVER {_W} AS sell FROM c),
 n AS (SELECT *, lead(CASE WHEN sell THEN bucket END IGNORE NULLS) OVER {_W} AS xb, lead(CASE WHEN sell THEN close END IGNORE NULLS) OVER {_W} AS xc FROM m)
SELECT symbol, bucket AS entry_time, xb AS exit_time, round(close * 1.001, 6) AS net_entry, round(xc * 0.999, 6) AS net_exit, round(xc * 0.999 - close * 1.001, 6) AS net_pnl, round((xc * 0.999 - close * 1.001) / (close * 1.001) * 100, 6) AS net_pct FROM n WHERE buy AND xb IS NOT NULL""")
def stg06(spark, d):
    c = candles(spark, d).withColumn("_p", F.lag("close").over(R.over()))
    trips = R.round_trips(c, F.col("close") < F.col("_p"), F.coalesce(F.col("close") > F.col("_p"), F.lit(False)))
    return R.trade_costs(trips).select("symbol", "entry_time", "exit_time", "net_entry", "net_exit", "net_pnl", "net_pct")


@query("stg09_buy_share", _win(14400) + f"SELECT symbol, bucket, round(CAST({_VB} AS DOUBLE) / ({_VB} + {_VS}), 6) AS buy_share FROM w GROUP BY symbol, bucket")
def stg09(spark, d):
    b = M.windowed(ticks(spark, d), M.order_flow_metrics(), 14400)
    return G.buy_share(b).select("symbol", "bucket", "buy_share")


@query("stg12_liquidity_detail", _R + """, g AS (SELECT r.*, epoch(bucket) - lag(epoch(bucket)) OVER (PARTITION BY symbol ORDER BY bucket) AS gap, abs(close - open) / volume AS impact FROM r), q AS (SELECT symbol, quantile_cont(gap, 0.95) AS q FROM g GROUP BY symbol)
SELECT g.symbol, round(avg(impact), 6) AS mean_impact, round(stddev_samp(pct), 5) AS volatility, count(*) FILTER (WHERE gap > q) AS long_gaps FROM g JOIN q ON g.symbol = q.symbol GROUP BY g.symbol""")
def stg12(spark, d):
    return G.liquidity_detail(candles(spark, d))


def _moments(x: str, name: str, source: str) -> str:
    return f"SELECT symbol, '{name}' AS series, count({x}) AS n, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, round(skewness({x}), 5) AS skew, round(kurtosis({x}), 4) AS kurtosis FROM {source} GROUP BY symbol HAVING count({x}) > 0"


@query("stg13_fractional_study", _R + ", " + ", ".join(f"f{int(o * 10)} AS (SELECT symbol, round({_frac_sql(o, 1e-2)}, 6) AS v FROM c)" for o in (0.2, 0.3, 0.4)) + " " + " UNION ALL ".join([*[_moments("v", f"d={o}", f"f{int(o * 10)}") for o in (0.2, 0.3, 0.4)], _moments("pct", "returns", "r")]))
def stg13(spark, d):
    return R.fractional_study(candles(spark, d)).select("symbol", "series", "n", "mean", "std", "skew", "kurtosis")


@query("udf03_agg_trade_adaptor", _win(3600) + "SELECT symbol, bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume FROM w GROUP BY symbol, bucket")
def udf03(spark, d):
    r = analyzers.Registry()
    r.register(analyzers.SimpleCounter())
    return analyzers.on_agg_trades(r, _agg_json(ticks(spark, d)), F.col("symbol"), 3600).select("symbol", "bucket", "counter.trades", "counter.volume")


@query("bar10_adaptive_statistics", ADAPTIVE_SQL.rstrip() + STATS_SQL.replace(" FROM r GROUP BY symbol", ", round(min(threshold_used), 6) AS threshold_min, round(max(threshold_used), 6) AS threshold_max, round(avg(threshold_used), 6) AS threshold_mean FROM r GROUP BY symbol"))
def bar10(spark, d):
    return B.bar_statistics(B.adaptive_bars(ticks(spark, d), 5_000.0))
