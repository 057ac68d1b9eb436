"""Queries on operators that others use inside: intervals, parameters by symbol, analyzers' registry, CSV, appends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.scalars import dbl
from ..operators import bars as B
from ..operators import micro as M
from ..operators import series as R
from ..operators import ticks as K
from ..registry import query
from ..schema import ticks
from ..sources import files
from ..streaming import analyzers
from .bars import HEAD_SQL
from .series import _R, _TRIPS, candles


@query("src12_csv_scan", "SELECT symbol, date, count(*) AS n, sum(price) AS total FROM t WHERE price > 50 GROUP BY symbol, date")
def src12(spark, d):
    path = files.shared_path(spark, "csv")
    files.export_csv(ticks(spark, d), path)
    t = files.read_csv_ticks(spark, path).where("price > 50")
    return t.groupBy("symbol", "date").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query("snk02_append_per_run", "SELECT symbol, CAST(trade_id % 3 AS INTEGER) AS run, count(*) AS n FROM t GROUP BY 1, 2")
def snk02(spark, d):
    """Three runs append a file set each; none touches what is there."""
    path = files.shared_path(spark, "runs")
    for k in range(3):
        files.write_ticks(ticks(spark, d).where(F.col("trade_id") % 3 == k), path)
    return files.read_ticks(spark, path).groupBy("symbol", (F.col("trade_id") % 3).cast("int").alias("run")).agg(F.count("*").alias("n"))


_FROM_EPOCH = {"30s": 30, "15m": 900, "6h": 21_600, "3d": 259_200}
_BUCKETS = [f"SELECT symbol, '{i}' AS interval, to_timestamp(CAST(floor(epoch(ts) / {s}) * {s} AS BIGINT))::TIMESTAMP AS bucket FROM t" for i, s in _FROM_EPOCH.items()]
_BUCKETS += ["SELECT symbol, '2w', to_timestamp(CAST(floor((epoch(ts) - 345600) / 1209600) * 1209600 + 345600 AS BIGINT))::TIMESTAMP FROM t", "SELECT symbol, '1M', date_trunc('month', ts)::TIMESTAMP FROM t"]


@query("scl04_intervals", f", b AS ({' UNION ALL '.join(_BUCKETS)}) SELECT symbol, interval, count(DISTINCT bucket) AS buckets, min(bucket) AS first_bucket, max(bucket) AS last_bucket FROM b GROUP BY symbol, interval")
def scl04(spark, d):
    t = ticks(spark, d)

    def by(interval: str) -> DataFrame:
        b = t.select("symbol", F.lit(interval).alias("interval"), X.bucket_start("ts", interval).alias("bucket")).distinct()
        return b.groupBy("symbol", "interval").agg(F.count("*").alias("buckets"), F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"))

    return reduce(DataFrame.unionByName, [by(i) for i in [*_FROM_EPOCH, "2w", "1M"]])


@query("scl05_hours_and_weekdays", "SELECT symbol, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, count(*) AS n FROM t GROUP BY 1, 2, 3")
def scl05(spark, d):
    return ticks(spark, d).groupBy("symbol", F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday")).agg(F.count("*").alias("n"))


@query("scl09_severities", _R + ", s AS (SELECT symbol, abs(pct * 100) AS p FROM r WHERE pct IS NOT NULL) SELECT symbol, CASE WHEN p > 20 THEN 'critical' WHEN p > 15 THEN 'high' WHEN p > 10 THEN 'medium' ELSE 'low' END AS severity, count(*) AS n FROM s GROUP BY 1, 2")
def scl09(spark, d):
    r = R.returns(candles(spark, d)).where("pct_change IS NOT NULL")
    return r.groupBy("symbol", X.severity_by_change(F.col("pct_change") * 100).alias("severity")).agg(F.count("*").alias("n"))


@query("jn10_thresholds_by_symbol", ", p AS (SELECT *, CASE symbol WHEN 'click' THEN 100 WHEN 'view' THEN 900 ELSE 400 END AS lim FROM t) SELECT symbol, CAST(max(lim) AS DOUBLE) AS threshold, count(*) FILTER (WHERE cents * q > lim * 100) AS above FROM p GROUP BY symbol")
def jn10(spark, d):
    own = spark.createDataFrame([("click", 100), ("view", 900), ("default", 400)], "symbol string, threshold long")
    t = B.with_threshold(ticks(spark, d), own)
    return t.groupBy("symbol").agg(F.max("threshold").cast("double").alias("threshold"), F.count_if(F.col("price") * F.col("quantity") > F.col("threshold")).alias("above"))


@query("win11_time_between_bars", HEAD_SQL + ", p AS (SELECT symbol, (epoch_us(t0) - epoch_us(lag(t0) OVER (PARTITION BY symbol ORDER BY bar_id))) / 1000000.0 AS s FROM d) SELECT symbol, count(s) AS n, round(avg(s), 4) AS mean_seconds, round(max(s), 6) AS longest FROM p GROUP BY symbol")
def win11(spark, d):
    s = B.dollar_bars(ticks(spark, d), 10_000)
    return s.groupBy("symbol").agg(F.count("time_since_last_bar").alias("n"), dbl(F.avg("time_since_last_bar"), 4).alias("mean_seconds"), F.max("time_since_last_bar").alias("longest"))


@query("top10_best_and_worst_trades", _TRIPS + ", k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY pnl DESC, entry_time) AS b, row_number() OVER (PARTITION BY symbol ORDER BY pnl, entry_time) AS w FROM trips) SELECT symbol, max(CASE WHEN b = 1 THEN entry_time END) AS best_entry, max(CASE WHEN b = 1 THEN pnl END) AS best, max(CASE WHEN w = 1 THEN entry_time END) AS worst_entry, max(CASE WHEN w = 1 THEN pnl END) AS worst FROM k GROUP BY symbol")
def top10(spark, d):
    e = R.mean_reversion(candles(spark, d))
    return R.best_and_worst(R.round_trips(e, F.col("event") == "entry", F.col("event") == "exit"))


@query("udf02_registry", "SELECT symbol, to_timestamp(CAST(floor(epoch(ts) / 7200) * 7200 AS BIGINT))::TIMESTAMP AS bucket, count(*) AS trades, CAST(sum(q) AS DOUBLE) AS volume FROM t GROUP BY 1, 2")
def udf02(spark, d):
    """Of three analyzers one is switched off and one is taken out again."""
    r = analyzers.Registry()
    r.register(analyzers.SimpleCounter())
    r.register(analyzers.FromColumns("flow", M.order_flow_metrics))
    r.register(analyzers.FromColumns("volume", M.volume_metrics))
    r.enable("flow", False)
    r.unregister("volume")
    out = r.run(ticks(spark, d), 7200)
    return out.select("symbol", "bucket", *[f"{a}.{c}" for a in out.columns[2:] for c in ("trades", "volume")])


@query("udf05_ad_hoc_sql", "SELECT symbol, date, count(*) AS n, rank() OVER (PARTITION BY date ORDER BY count(*) DESC, symbol) AS place FROM t GROUP BY symbol, date")
def udf05(spark, d):
    q = K.query(ticks(spark, d), "SELECT symbol, date, count(*) AS n, rank() OVER (PARTITION BY date ORDER BY count(*) DESC, symbol) AS place FROM data GROUP BY symbol, date")
    return q.withColumn("place", F.col("place").cast("long"))
