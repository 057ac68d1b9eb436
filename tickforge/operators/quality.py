"""Data quality: duplicates, freshness, invalid values, anomalies, scores, recommendations and backfill plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import dbl, ratio, severity_by_change, severity_by_z
from .series import gaps, time_band_join, top_gaps, x, zscore

KEYS = ("symbol", "trade_id")


def duplicate_breakdown(ticks: DataFrame) -> DataFrame:
    """Per symbol: rows beyond the first of each id, and ids that occur more than once."""
    k = ticks.groupBy(*KEYS).agg(F.count("*").alias("c")).where("c > 1")
    return k.groupBy("symbol").agg(F.sum(F.col("c") - 1).alias("duplicates"), F.count("*").alias("ids"))


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: records before and after, removed, and duplicates that are left."""
    b = before.agg(F.count("*").alias("records_before")).withColumn("_k", F.lit(1))
    a = after.agg(F.count("*").alias("records_after"), (F.count("*") - F.count_distinct(*KEYS)).alias("duplicates_left")).withColumn("_k", F.lit(1))
    return b.join(a, "_k").select("records_before", "records_after", (F.col("records_before") - F.col("records_after")).alias("removed"), "duplicates_left")


def duplicate_timestamps(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol", "ts").agg(F.count("*").alias("n")).where("n > 1")


def gap_report(ticks: DataFrame, min_seconds: float = 3600) -> DataFrame:
    g = gaps(ticks, min_seconds)
    return g.groupBy("symbol").agg(F.count("*").alias("gap_count"), dbl(F.sum("days"), 4).alias("total_days"), F.max("hours").alias("largest_hours"))


def freshness(ticks: DataFrame, as_of, stale_hours: float = 2.0) -> DataFrame:
    hours = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.max("ts"))) / F.lit(3.6e9)
    return ticks.groupBy("symbol").agg(F.max("ts").alias("last_time"), dbl(hours).alias("age_hours"), (hours > stale_hours).alias("stale"))


def invalid_values(ticks: DataFrame) -> DataFrame:
    bad = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) <= 0))
    return ticks.groupBy("symbol").agg(bad("price").alias("bad_price"), bad("quantity").alias("bad_quantity"), F.count_if(F.col("ts").isNull()).alias("null_time"))


def assessment(ticks: DataFrame, as_of, min_seconds: float = 3600) -> DataFrame:
    """Per symbol: records, duplicates, range, freshness, gaps, invalid values, issues and a score of 0 to 100.

    Range, freshness and invalid values are one aggregate; the parts meet in a union that is summed up by symbol.
    """
    hours = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.max("ts"))) / F.lit(3.6e9)
    bad = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) <= 0))
    base = ticks.groupBy("symbol").agg(
        F.count("*").alias("records"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time"), dbl(hours).alias("age_hours"), (hours > 2.0).alias("stale"),
        bad("price").alias("bad_price"), bad("quantity").alias("bad_quantity"), F.count_if(F.col("ts").isNull()).alias("null_time"),
    )
    parts = [base, duplicate_breakdown(ticks).select("symbol", "duplicates"), gap_report(ticks, min_seconds)]
    d = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    d = d.groupBy("symbol").agg(*[F.max(c).alias(c) for c in d.columns if c != "symbol"])
    d = d.na.fill(0, ["duplicates", "gap_count", "total_days", "largest_hours"])
    issues = F.col("duplicates") + F.col("gap_count") + F.col("bad_price") + F.col("bad_quantity") + F.col("null_time")
    d = d.withColumn("issues", issues)
    score = F.when(F.col("records") == 0, 100.0).otherwise(F.greatest(F.lit(0.0), 100 * (1 - F.col("issues") / F.col("records"))))
    return d.withColumn("quality_score", dbl(score, 4))


def recommendations(ticks: DataFrame, as_of, min_seconds: float = 3600) -> DataFrame:
    """(symbol, action, priority, detail): remove duplicates, fill the three largest gaps, refresh stale symbols."""
    d = duplicate_breakdown(ticks).select("symbol", F.lit("deduplicate").alias("action"), F.lit("HIGH").alias("priority"), F.col("duplicates").cast("double").alias("detail"))
    g = top_gaps(gaps(ticks, min_seconds), 3, per_symbol=True).select("symbol", F.lit("fill_gap").alias("action"), F.lit("HIGH").alias("priority"), F.col("hours").alias("detail"))
    f = freshness(ticks, as_of).where("stale").select("symbol", F.lit("refresh").alias("action"), F.lit("MEDIUM").alias("priority"), F.col("age_hours").alias("detail"))
    return d.unionByName(g).unionByName(f)


def overall_status(ticks: DataFrame, as_of, min_seconds: float = 3600) -> DataFrame:
    """One row: symbols, records, duplicates, gaps, their sum as issues, stale symbols, and healthy or issues_found, as
    there is anything to recommend."""
    a = assessment(ticks, as_of, min_seconds)
    s = a.agg(F.count("*").alias("symbols"), F.sum("records").alias("records"), F.sum("duplicates").alias("duplicates"), F.sum("gap_count").alias("gaps"), F.count_if("stale").alias("stale_symbols"))
    return s.withColumn("issues", F.col("duplicates") + F.col("gaps")).withColumn("status", F.when((F.col("issues") == 0) & (F.col("stale_symbols") == 0), "healthy").otherwise("issues_found"))


def maintenance_triggers(ticks: DataFrame, as_of, duplicates: int = 1000, gap_hours: float = 6, age_hours: float = 2) -> DataFrame:
    a = assessment(ticks, as_of)
    return a.select("symbol", (F.col("duplicates") > duplicates).alias("dedupe"), (F.col("largest_hours") > gap_hours).alias("backfill"), (F.col("age_hours") > age_hours).alias("refresh"))


def spikes(candles: DataFrame, limit: float = 10.0) -> DataFrame:
    change = ratio(x("close") - x("open"), x("open")) * 100
    d = candles.withColumn("change_pct", change).where(F.abs(F.col("change_pct")) > limit)
    return d.select("symbol", "bucket", F.lit("price_spike").alias("kind"), severity_by_change(F.col("change_pct")).alias("severity"), dbl("change_pct").alias("change_pct"), x("close").alias("price"))


def outliers(candles: DataFrame, n: int = 20, limit: float = 3.0) -> DataFrame:
    """Rolling z over the last n closes, the current one included, partial frames allowed; sample deviation."""
    z = zscore(candles, n, min_periods=True).where(F.abs(F.col("zscore")) > limit)
    return z.select("symbol", "bucket", F.lit("outlier").alias("kind"), severity_by_z(F.col("zscore")).alias("severity"), F.lit(0.0).alias("change_pct"), x("close").alias("price"))


def anomalies(candles: DataFrame, include_low: bool = False) -> DataFrame:
    """Spikes, and outliers of candles that no spike is reported for."""
    s = spikes(candles)
    o = outliers(candles).join(s.select("symbol", "bucket"), ["symbol", "bucket"], "left_anti")
    out = s.unionByName(o)
    return out if include_low else out.where("severity <> 'low'")


def anomaly_report(a: DataFrame) -> DataFrame:
    return a.groupBy("symbol", "kind", "severity").agg(F.count("*").alias("n"), F.min("bucket").alias("first_time"), F.max("bucket").alias("last_time"))


def market_wide(probes: DataFrame, candles: DataFrame, seconds: int = 300, limit: float = 5.0, share: float = 0.5) -> DataFrame:
    """For each probe time: symbols that moved more than limit % within the band, and whether they are over ``share``."""
    moved = candles.where(F.abs(ratio(x("close") - x("open"), x("open")) * 100) > limit).select(F.lit(0).alias("symbol"), F.col("symbol").alias("who"), F.col("bucket").alias("ts"))
    total = candles.agg(F.count_distinct("symbol").alias("_n"))
    p = probes.select(F.lit(0).alias("symbol"), F.col("bucket").alias("ts")).distinct()
    near = time_band_join(p, moved, seconds).groupBy("ts").agg(F.count_distinct("r_who").alias("affected"))
    out = p.select("ts").join(near, "ts", "left").withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")
    return out.select("ts", F.coalesce("affected", F.lit(0)).alias("affected"), (F.coalesce("affected", F.lit(0)) > share * F.col("_n")).alias("market_wide"))


def backfill_plan(ticks: DataFrame, ranges: DataFrame, max_records: int, initial_density: float = 4000.0) -> DataFrame:
    """Missing ranges (symbol, missing_start, missing_end) cut into pieces that hold about 0.6 * max_records rows.

    A piece's hours are 0.6 * max_records over the 90th percentile of the symbol's records an hour (initial_density
    where there are none), at least 0.5 and at most 6.
    """
    hourly = ticks.groupBy("symbol", F.date_trunc("hour", "ts").alias("h")).agg(F.count("*").alias("c"))
    density = hourly.groupBy("symbol").agg(F.percentile(F.col("c").cast("double"), F.lit(0.9)).alias("density"))
    d = ranges.select("symbol", "missing_start", "missing_end").join(density, "symbol", "left")
    hours = F.least(F.lit(6.0), F.greatest(F.lit(0.5), F.lit(0.6 * max_records) / F.coalesce("density", F.lit(initial_density))))
    d = d.withColumn("_us", (hours * F.lit(3.6e9)).cast("long")).withColumn("_a", F.unix_micros("missing_start")).withColumn("_z", F.unix_micros("missing_end")).where("_z > _a")
    d = d.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_z") - F.col("_a") - 1) / F.col("_us")))))
    start = F.col("_a") + F.col("_p") * F.col("_us")
    return d.select("symbol", "missing_start", F.col("_p").alias("piece"), F.timestamp_micros(start).alias("piece_start"), F.timestamp_micros(F.least(start + F.col("_us"), F.col("_z"))).alias("piece_end"))


def file_sanity(df: DataFrame, ts: str = "ts", symbol: str = "symbol") -> DataFrame:
    """Rows, size, dates and symbols of every file behind df."""
    f = df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("records"), F.max("_metadata.file_size").alias("file_bytes"), F.count_distinct(F.to_date(ts)).alias("dates"), F.count_distinct(symbol).alias("symbols"),
    )
    return f.withColumn("non_empty", F.col("records") > 0)


def latest_window(ticks: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Per symbol the range still to fetch: from the last tick, or as_of - hours if that is later, to as_of."""
    end = F.lit(as_of).cast("timestamp")
    return ticks.groupBy("symbol").agg(F.max("ts").alias("_l")).select("symbol", F.greatest("_l", F.timestamp_micros(F.unix_micros(end) - hours * 3_600_000_000)).alias("fetch_start"), end.alias("fetch_end"))


