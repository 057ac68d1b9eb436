"""Queries on sources, sinks, streams and analyzers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import micro as M
from ..operators import stats as S
from ..registry import query
from ..schema import ticks
from ..sources import files, raw
from ..streaming import analyzers, streams
from .bars import RESET_SQL, reset_columns


@query("src01_snk01_partitioned_round_trip", "SELECT trade_id, price, quantity FROM t WHERE symbol = 'click' AND date >= DATE '2024-01-05' AND date <= DATE '2024-01-10'")
def snk01(spark, d):
    path = files.shared_path(spark, "ticks")
    files.write_ticks(ticks(spark, d), path)
    return files.read_ticks(spark, path, "click", "2024-01-05", "2024-01-10", ["trade_id", "price", "quantity"])


@query("src03_sql_over_files", "SELECT symbol, max(price) AS high FROM t GROUP BY symbol")
def src03(spark, d):
    from ..operators.ticks import query as sql

    return sql(ticks(spark, d), "SELECT symbol, max(price) AS high FROM data GROUP BY symbol")


@query("src04_agg_trade_json", "SELECT symbol, trade_id, price, quantity, is_buyer_maker, CAST(to_timestamp(epoch_ms(ts) // 1000) AS DATE) AS date FROM t")
def src04(spark, d):
    t = ticks(spark, d)
    j = F.to_json(F.struct(F.col("trade_id").alias("a"), F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"), F.unix_millis("ts").alias("T"), F.col("is_buyer_maker").alias("m")))
    return raw.agg_trades(t.select("symbol", j.alias("value")), F.col("symbol")).select("symbol", "trade_id", "price", "quantity", "is_buyer_maker", "date")


@query("src05_kline_json", "SELECT symbol, CAST(floor(epoch(ts) / 86400) * 86400000 AS BIGINT) AS open_time, max(price) AS high, min(price) AS low, CAST(count(*) AS BIGINT) AS trades FROM t GROUP BY 1, 2")
def src05(spark, d):
    c = S.ohlcv(ticks(spark, d), "1d")
    s = lambda n: F.col(n).cast("string")
    ms = F.unix_millis("bucket")
    arr = F.array(ms.cast("string"), s("open"), s("high"), s("low"), s("close"), s("volume"), (ms + 86_399_999).cast("string"), F.lit("0"), s("trades"), F.lit("0"), F.lit("0"), F.lit("0"))
    return raw.klines(c.select("symbol", F.to_json(arr).alias("value")), F.col("symbol")).select("symbol", "open_time", "high", "low", "trades")


@query("src06_trade_events", "SELECT symbol, trade_id, price, quantity, is_buyer_maker, cents * q / 100.0 AS quote_quantity FROM t")
def src06(spark, d):
    j = F.to_json(F.struct(F.lit("trade").alias("e"), F.col("symbol").alias("s"), F.col("trade_id").alias("t"), F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"), F.unix_millis("ts").alias("T"), F.col("is_buyer_maker").alias("m")))
    t = raw.trade_events(ticks(spark, d).select(j.alias("value")))
    return t.select("symbol", "trade_id", "price", "quantity", "is_buyer_maker", F.col("quote_quantity").cast("double").alias("quote_quantity"))


@query("src09_book_snapshots", """, b AS (SELECT symbol, date, price, quantity, row_number() OVER (PARTITION BY symbol, date ORDER BY price, trade_id) AS k FROM t)
SELECT symbol, date, CAST(least(3, count(*)) AS INTEGER) AS bid_levels, max(CASE WHEN k = 1 THEN price END) AS best_bid FROM b GROUP BY symbol, date""")
def src09(spark, d):
    pair = lambda c: F.to_json(F.transform(c, lambda x: F.array(x["price"].cast("string"), x["quantity"].cast("string"))))
    b = M.books_from_ticks(ticks(spark, d)).select("symbol", "date", "ts", pair("bids").alias("bids_json"), pair("asks").alias("asks_json"))
    s = raw.book_snapshots(b, 3)
    return s.select("symbol", "date", "bid_levels", F.get("bids", F.lit(0))["price"].alias("best_bid"))


@query("snk05_csv_round_trip", "SELECT symbol, count(*) AS n, sum(price) AS total FROM t WHERE quantity > 3 GROUP BY symbol")
def snk05(spark, d):
    path = files.shared_path(spark, "csv")
    files.export_csv(ticks(spark, d), path, "quantity > 3")
    return files.read_csv_ticks(spark, path).groupBy("symbol").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query("snk06_append_new", "SELECT symbol, count(*) AS n FROM t GROUP BY symbol")
def snk06(spark, d):
    path = files.shared_path(spark, "append")
    t = ticks(spark, d)
    files.write_ticks(t.where("trade_id % 3 <> 0"), path)
    files.append_new(t.where("trade_id % 2 = 0 or trade_id % 3 = 0"), path)
    files.append_new(t, path)
    return files.read_ticks(spark, path).groupBy("symbol").agg(F.count("*").alias("n"))


@query("snk07_merge_latest", "SELECT symbol, count(*) AS n, sum(CASE WHEN trade_id % 5 = 0 THEN price + 1 ELSE price END) AS total FROM t GROUP BY symbol")
def snk07(spark, d):
    t = ticks(spark, d)
    new = t.where("trade_id % 5 = 0").withColumn("price", (F.col("price") + 1).cast("decimal(18,8)"))
    return files.merge_latest(t, new, ["symbol", "trade_id"]).groupBy("symbol").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


def _versions(spark, d) -> str:
    """A table of three versions: sells, then buys added to them, then rows over 100 instead of all."""
    t, path = ticks(spark, d), files.shared_path(spark, "versions")
    files.commit_version(t.where("NOT is_buyer_maker"), path)
    files.commit_version(t.where("is_buyer_maker"), path)
    files.commit_version(t.where("price > 100"), path, replace=True)
    return path


@query("src10_table_scan", "SELECT symbol, trade_id, price FROM t WHERE price > 100 AND date >= DATE '2024-01-05' AND date <= DATE '2024-01-20'")
def src10(spark, d):
    now = files.read_version(spark, _versions(spark, d))
    return now.where("date BETWEEN DATE'2024-01-05' AND DATE'2024-01-20'").select("symbol", "trade_id", "price")


@query("src11_older_versions", "SELECT v, symbol, count(*) AS n, sum(quantity) AS quantity FROM t, (VALUES (1), (2), (3)) x(v) WHERE v = 2 OR (v = 1 AND NOT is_buyer_maker) OR (v = 3 AND price > 100) GROUP BY v, symbol")
def src11(spark, d):
    path = _versions(spark, d)
    rows = [files.read_version(spark, path, v).withColumn("v", F.lit(v)) for v in (1, 2, 3)]
    both = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return both.groupBy("v", "symbol").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


@query("snk10_backup", "SELECT count(*) AS n FROM t")
def snk10(spark, d):
    path = files.shared_path(spark, "backup")
    files.backup(ticks(spark, d), path)
    return spark.read.parquet(path).agg(F.count("*").alias("n"))


@query("snk13_envelope", "SELECT symbol, count(*) AS n FROM t WHERE price > 100 GROUP BY symbol")
def snk13(spark, d):
    e = raw.envelope(streams.price_alerts(ticks(spark, d), 100.0).select("symbol", "trade_id"), "alerts", F.lit(0))
    return e.groupBy(F.get_json_object("value", "$.data.symbol").alias("symbol")).agg(F.count("*").alias("n"))


@query("agg33_partition_listing", "SELECT symbol, count(DISTINCT date) AS dates, min(date) AS first_date, max(date) AS last_date, count(*) AS records FROM t GROUP BY symbol")
def agg33(spark, d):
    return files.partition_listing(ticks(spark, d))


_CLOSED = "to_timestamp(CAST(floor(epoch(ts) / {w}) * {w} AS BIGINT))::TIMESTAMP"


@query("str01_tumbling", f"SELECT * FROM (SELECT symbol, {_CLOSED.format(w=3600)} AS bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap FROM t GROUP BY 1, 2) WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 SECOND FROM t)")
def str01(spark, d):
    s = streams.tumbling(streams.stream_ticks(spark, d), M.volume_metrics(), 3600)
    return streams.run_to_files(s, "tumbling").select("symbol", "bucket", "trades", "volume", "vwap")


@query("str06_deduplicated", "SELECT symbol, count(*) AS n FROM t GROUP BY symbol")
def str06(spark, d):
    # Every trade comes twice.
    s = streams.stream_ticks(spark, d).unionByName(streams.stream_ticks(spark, d))
    return streams.run_to_files(streams.deduplicated(s), "dedup").groupBy("symbol").agg(F.count("*").alias("n"))


@query("str05_bar07_stateful_bars", RESET_SQL + " HAVING sum(cents * q) >= 500000")
def str05(spark, d):
    return reset_columns(streams.run_to_files(streams.reset_bars(streams.stream_ticks(spark, d), 5_000.0), "bars"))


@query("str09_str12_latest_per_symbol", "SELECT symbol, count(*) AS trades, max(CASE WHEN z = 1 THEN price END) AS last_price, max(ts) AS last_time FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS z FROM t) GROUP BY symbol")
def str09(spark, d):
    return streams.run_updates(streams.latest_per_symbol(streams.stream_ticks(spark, d)), ["symbol"], "latest")


@query("str15_price_alerts", "SELECT symbol, trade_id, ts, price FROM t WHERE price > 200")
def str15(spark, d):
    return streams.run_to_files(streams.price_alerts(streams.stream_ticks(spark, d), 200.0), "alerts")


@query("str03_sessions", """, f AS (SELECT symbol, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY symbol ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS f FROM t), i AS (SELECT *, sum(f) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM f)
SELECT symbol, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS n FROM i GROUP BY symbol, i.i HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 SECOND FROM t)""")
def str03(spark, d):
    return streams.run_to_files(streams.sessions(streams.stream_ticks(spark, d)), "sessions")


@query("mic12_udf01_analyzers", f"SELECT symbol, {_CLOSED.format(w=3600)} AS bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume, round(CAST(count(*) FILTER (WHERE NOT is_buyer_maker) AS DOUBLE) / nullif(count(*) FILTER (WHERE is_buyer_maker), 0), 6) AS ratio FROM t GROUP BY 1, 2")
def mic12(spark, d):
    r = analyzers.Registry()
    r.register(analyzers.SimpleCounter())
    r.register(analyzers.FromColumns("flow", M.order_flow_metrics))
    return r.run(ticks(spark, d), 3600).select("symbol", "bucket", "counter.trades", "counter.volume", "counter.ratio")


