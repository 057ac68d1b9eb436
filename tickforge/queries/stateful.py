"""Queries on streams that carry state over micro-batches and restarts: the ticks come in five ranges of time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import dbl
from ..registry import query
from ..schema import ticks
from ..sources import files, raw
from ..streaming import analyzers as N
from ..streaming import stateful as Z
from .bars import ADAPTIVE_SQL, RESET_SQL

PARTS = 5


def _arriving(spark, t):
    """(path, stream) of t in files by time."""
    Z.use_rocksdb(spark)
    path = files.shared_path(spark, "arriving")
    Z.in_time_files(t, path, PARTS)
    return path, Z.stream_of(spark, path, t.schema)


def _table(spark, label):
    return Z.StreamTable(spark, files.shared_path(spark, label))


_RESET_ROWS = RESET_SQL[: RESET_SQL.index("SELECT symbol, bar_id, min(ts)")]


@query("str05_bars_over_batches", _RESET_ROWS + """SELECT symbol, bar_id, min(ts) AS timestamp, max(ts) AS timestamp_close, max(CASE WHEN a = 1 THEN cents END) / 100.0 AS open, max(cents) / 100.0 AS high, min(cents) / 100.0 AS low, max(CASE WHEN z = 1 THEN cents END) / 100.0 AS close, round(CAST(sum(q) AS DOUBLE), 6) AS volume,
 round(sum(cents * q) / 100.0, 4) AS dollar_volume, count(*) AS tick_count, round(sum(cents * q) / 100.0 / sum(q), 6) AS vwap, CAST(5000 AS DOUBLE) AS threshold_used FROM n GROUP BY symbol, bar_id HAVING sum(cents * q) >= 500000""")
def str05(spark, d):
    """Two batches, a stop, and the rest."""
    t = ticks(spark, d)
    path, s = _arriving(spark, t)
    out = _table(spark, "bars")
    out.run(Z.bars(s, 5_000.0), max_batches=2)
    s = Z.bars(Z.stream_of(spark, path, t.schema), 5_000.0)
    out.run(s)
    return out.rows(s.schema).select("symbol", "bar_id", "timestamp", "timestamp_close", "open", "high", "low", "close", dbl("volume").alias("volume"), dbl("dollar_volume", 4).alias("dollar_volume"), "tick_count", dbl("vwap").alias("vwap"), "threshold_used")


@query("bar07_adaptive_stream_bars", ADAPTIVE_SQL + "SELECT symbol, bar_id, t0 AS timestamp, t1 AS timestamp_close, open, close, round(dollar_volume, 4) AS dollar_volume, tick_count, round(dollar_volume / volume, 6) AS vwap, round(threshold_used, 4) AS threshold_used FROM d")
def bar07(spark, d):
    t = ticks(spark, d)
    path, s = _arriving(spark, t)
    out = _table(spark, "bars")
    out.run(Z.bars(s, 5_000.0, 20), max_batches=3)
    s = Z.bars(Z.stream_of(spark, path, t.schema), 5_000.0, 20)
    out.run(s)
    return out.rows(s.schema).select("symbol", "bar_id", "timestamp", "timestamp_close", "open", "close", dbl("dollar_volume", 4).alias("dollar_volume"), "tick_count", dbl("vwap").alias("vwap"), dbl("threshold_used", 4).alias("threshold_used"))


def _newest(spark, d, n, seconds=None):
    t = ticks(spark, d)
    path, s = _arriving(spark, t)
    out = _table(spark, "newest")
    out.run(Z.newest_rows(s, n, seconds), "update", max_batches=2)
    s = Z.newest_rows(Z.stream_of(spark, path, t.schema), n, seconds)
    out.run(s, "update")
    return Z.opened(out.newest(s.schema, ["symbol"]), t.schema)


@query("str08_newest_rows", ", r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS k FROM t) SELECT symbol, trade_id, ts, price, quantity FROM r WHERE k <= 20")
def str08(spark, d):
    return _newest(spark, d, 20).select("symbol", "trade_id", "ts", "price", "quantity")


@query("str07_newest_rows_in_time", ", r AS (SELECT *, max(ts) OVER (PARTITION BY symbol) AS top, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS k FROM t) SELECT symbol, trade_id, ts FROM r WHERE epoch_us(top) - epoch_us(ts) <= 43200000000 AND k <= 500")
def str07(spark, d):
    return _newest(spark, d, 500, 43_200).select("symbol", "trade_id", "ts")


@query("str10_resumed_runs", "SELECT symbol, date, count(*) AS n, sum(price) AS total FROM t GROUP BY symbol, date")
def str10(spark, d):
    """Three runs with files added in between; the second one stops between the write and the commit of a batch."""
    t = ticks(spark, d)
    path, out, calls = files.shared_path(spark, "landing"), _table(spark, "landed"), []
    stream = lambda: Z.stream_of(spark, path, t.schema, 1)

    def stop(i):
        calls.append(i)
        if len(calls) == 2:
            raise InterruptedError("stopped before the commit")

    for k in range(3):
        t.where(F.col("trade_id") % 3 == k).repartition(3).write.mode("append").parquet(path)
        try:
            out.run(stream(), before_commit=stop if k == 1 else None)
        except Exception as e:
            if "stopped before the commit" not in str(e):
                raise
    return out.rows(t.schema).groupBy("symbol", "date").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query("str13_bounded_run", "SELECT symbol, count(*) AS n FROM t GROUP BY symbol")
def str13(spark, d):
    """Runs of one batch each, until one finds nothing left."""
    t = ticks(spark, d)
    path, s = _arriving(spark, t)
    out = _table(spark, "bounded")
    while out.run(s, max_batches=1):
        s = Z.stream_of(spark, path, t.schema)
    return out.rows(t.schema).groupBy("symbol").agg(F.count("*").alias("n"))


def _depth(spark, d):
    """A depth message for each tick: 1 to 3 bids from its price down, one ask above it."""
    t = ticks(spark, d)
    level = lambda p: F.array(p.cast("decimal(18,8)").cast("string"), F.col("quantity").cast("string"))
    bids = F.transform(F.sequence(F.lit(0), (F.col("trade_id") % 3).cast("int")), lambda k: level(F.col("price") - k))
    fields = {"s": F.col("symbol"), "E": F.unix_millis("ts"), "U": F.col("trade_id"), "u": F.col("trade_id"), "b": bids, "a": F.array(level(F.col("price") + 1))}
    return t.select("ts", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value"))


_DEPTH = ", m AS (SELECT *, CAST(1 + trade_id % 3 AS INTEGER) AS bid_levels, row_number() OVER (PARTITION BY symbol ORDER BY epoch_ms(ts) DESC, trade_id DESC) AS z FROM t) "


@query("str09_current_books", _DEPTH + "SELECT symbol, trade_id AS last_update_id, price AS best_bid, CAST(price + 1 AS DECIMAL(18,8)) AS best_ask, CAST(price - (bid_levels - 1) AS DECIMAL(18,8)) AS last_bid, bid_levels, CAST(1 AS INTEGER) AS ask_levels FROM m WHERE z = 1")
def str09(spark, d):
    b = _books(spark, d)
    return b.select("symbol", "last_update_id", F.get("bids", F.lit(0))["price"].alias("best_bid"), F.get("asks", F.lit(0))["price"].alias("best_ask"), F.element_at("bids", -1)["price"].alias("last_bid"), "bid_levels", "ask_levels")


def _books(spark, d):
    t = _depth(spark, d)
    path, s = _arriving(spark, t)
    out = _table(spark, "books")
    out.run(Z.books(raw.depth_events(s)), "update", max_batches=2)
    s = Z.books(raw.depth_events(Z.stream_of(spark, path, t.schema)))
    out.run(s, "update")
    return out.newest(s.schema, ["symbol"])


@query("str12_depth_statistics", _DEPTH + "SELECT symbol, count(*) AS updates, CAST(sum(bid_levels + 1) AS BIGINT) AS levels_seen, max(CASE WHEN z = 1 THEN bid_levels END) AS bid_levels FROM m GROUP BY symbol")
def str12(spark, d):
    return _books(spark, d).select("symbol", "updates", "levels_seen", "bid_levels")


@query("str11_side_outputs", "SELECT symbol, 'trade' AS kind, count(*) AS n, sum(trade_id) AS ids FROM t GROUP BY symbol UNION ALL SELECT symbol, 'depth', count(*), sum(trade_id) FROM t GROUP BY symbol")
def str11(spark, d):
    """Trades and depth messages of one stream go to a handler each, which keeps what it gets by batch."""
    both = _depth(spark, d).select("ts", F.lit("depth").alias("kind"), "value")
    trade = F.to_json(F.struct(F.col("symbol").alias("s"), F.col("trade_id").alias("t"), F.unix_millis("ts").alias("T")))
    both = both.unionByName(ticks(spark, d).select("ts", F.lit("trade").alias("kind"), trade.alias("value")))
    _, s = _arriving(spark, both)
    path = files.shared_path(spark, "sides")
    parsed = {"trade": lambda b: b.select(F.get_json_object("value", "$.s").alias("symbol"), F.get_json_object("value", "$.t").cast("long").alias("id")), "depth": lambda b: raw.depth_events(b).select("symbol", F.col("last_update_id").alias("id"))}
    keep = lambda k: lambda b, i: parsed[k](b).withColumn("kind", F.lit(k)).write.mode("overwrite").parquet(f"{path}/{k}-{i}")
    Z.side_outputs(s, "kind", {k: keep(k) for k in parsed}, _table(spark, "sides"))
    return spark.read.schema("symbol string, id long, kind string").parquet(f"{path}/*").groupBy("symbol", "kind").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


_STREAKS = """, w AS (SELECT *, to_timestamp(CAST(floor(epoch(ts) / 14400) * 14400 AS BIGINT))::TIMESTAMP AS bucket, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS i FROM t),
 c AS (SELECT *, CASE WHEN is_buyer_maker <> lag(is_buyer_maker) OVER o THEN 1 ELSE 0 END AS c FROM w WINDOW o AS (PARTITION BY symbol, bucket ORDER BY i)),
 r AS (SELECT *, sum(c) OVER (PARTITION BY symbol, bucket ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM c),
 l AS (SELECT symbol, bucket, run, count(*) AS n, min(i) AS i, bool_or(is_buyer_maker) AS side FROM r GROUP BY symbol, bucket, run),
 s AS (SELECT symbol, bucket, CAST(sum(n) AS BIGINT) AS trades, max(n) AS longest, arg_min(side, i - n * 1000000000) AS longest_is_sell, count(*) - 1 AS changes FROM l GROUP BY symbol, bucket) """


@query("udf01_trade_analyzer", _STREAKS + "SELECT * FROM s")
def udf01(spark, d):
    return N.replay_trades(ticks(spark, d), N.Streaks, 14_400)


@query("udf01_trade_analyzer_stream", _STREAKS + "SELECT * FROM s WHERE bucket + INTERVAL 4 HOUR < (SELECT max(ts) - INTERVAL 10 SECOND FROM t)")
def udf01_stream(spark, d):
    t = ticks(spark, d)
    path, s = _arriving(spark, t)
    out = _table(spark, "streaks")
    out.run(N.stream_trades(s, N.Streaks, 14_400), max_batches=2)
    s = N.stream_trades(Z.stream_of(spark, path, t.schema), N.Streaks, 14_400)
    out.run(s)
    return out.rows(s.schema).drop("_batch")
