"""Streams that carry state over micro-batches and over restarts, against the batch operators."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickforge.operators import bars
from tickforge.schema import ticks
from tickforge.sources import files
from tickforge.streaming import stateful

COLUMNS = ["symbol", "bar_id", "timestamp", "timestamp_close", "open", "close", "tick_count"]
CLOSE = ["high", "low", "volume", "dollar_volume", "vwap", "price_std", "ticks_per_second", "dollar_volume_per_second", "time_since_last_bar", "threshold_used"]


@pytest.fixture(autouse=True)
def rocksdb(spark):
    stateful.use_rocksdb(spark)


def parted(spark, t, parts):
    """(path, stream): t in files by time."""
    path = files.shared_path(spark, "in")
    stateful.in_time_files(t, path, parts)
    return path, stateful.stream_of(spark, path, t.schema)


def same(got, want):
    key = lambda r: (r["symbol"], r["bar_id"])
    got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [[r[c] for c in COLUMNS] for r in got] == [[r[c] for c in COLUMNS] for r in want] and got
    for a, b in zip(got, want):
        for c in CLOSE:
            x, y = (None if v is None or v != v else float(v) for v in (a[c], b[c]))
            assert x == y or abs(x - y) <= (1e-4 if c == "dollar_volume_per_second" else 2e-6) * max(1, abs(y)), c


@pytest.mark.parametrize("parts", [2, 5])
@pytest.mark.parametrize("lookback", [None, 20])
def test_bars_do_not_depend_on_batches(spark, sf_dir, parts, lookback):
    t = ticks(spark, sf_dir)
    _, s = parted(spark, t, parts)
    s = stateful.bars(s, 5000.0, lookback)
    table = stateful.StreamTable(spark, files.shared_path(spark, "bars"))
    assert table.run(s) >= parts
    want = bars.adaptive_bars(t, 5000.0, lookback) if lookback else bars.reset_bars(t, 5000.0, keep_tail=False)
    same(table.rows(s.schema), want)
    assert table.rows(s.schema).where("stale").count() == 0


def test_bars_go_on_after_stops(spark, sf_dir):
    t = ticks(spark, sf_dir)
    path, s = parted(spark, t, 5)
    table = stateful.StreamTable(spark, files.shared_path(spark, "bars"))
    assert table.run(stateful.bars(s, 5000.0, 20), max_batches=2) == 2

    def stop(i):
        raise RuntimeError("stopped between write and commit")

    with pytest.raises(Exception, match="stopped between"):
        table.run(stateful.bars(stateful.stream_of(spark, path, t.schema), 5000.0, 20), before_commit=stop)
    s = stateful.bars(stateful.stream_of(spark, path, t.schema), 5000.0, 20)
    table.run(s)
    same(table.rows(s.schema), bars.adaptive_bars(t, 5000.0))


def test_a_stale_bar_closes(spark):
    t0 = datetime(2024, 1, 1)
    schema = "symbol string, trade_id long, ts timestamp, price decimal(18,8), quantity decimal(18,8), is_buyer_maker boolean"
    rows = [("a", 1, 0), ("a", 2, 5), ("c", 3, 9000), ("c", 4, 9001), ("a", 5, 9100), ("a", 6, 9101), ("a", 7, 9102)]
    path = files.shared_path(spark, "in")
    for r in rows:
        spark.createDataFrame([(r[0], r[1], t0 + timedelta(seconds=r[2]), Decimal(10), Decimal(1), True)], schema).coalesce(1).write.mode("append").parquet(path)
    s = stateful.bars(stateful.stream_of(spark, path, spark.read.parquet(path).schema, 1), 25.0, stale_seconds=600)
    table = stateful.StreamTable(spark, files.shared_path(spark, "bars"))
    table.run(s)
    got = sorted((r["symbol"], r["bar_id"], r["tick_count"], r["stale"]) for r in table.rows(s.schema).collect())
    # The watermark that c's first tick moves is there with its second one: a's two ticks are stale then.
    assert got == [("a", 0, 2, True), ("a", 1, 3, False)]


@pytest.mark.parametrize("seconds", [None, 86400])
def test_newest_rows_survive_a_restart(spark, sf_dir, seconds):
    t = ticks(spark, sf_dir)
    path, s = parted(spark, t, 4)
    table = stateful.StreamTable(spark, files.shared_path(spark, "newest"))
    assert table.run(stateful.newest_rows(s, 30, seconds), "update", max_batches=2) == 2
    s = stateful.newest_rows(stateful.stream_of(spark, path, t.schema), 30, seconds)
    assert table.run(s, "update") >= 2
    got = stateful.opened(table.newest(s.schema, ["symbol"]), t.schema)
    by = {}
    for r in t.collect():
        by.setdefault(r["symbol"], []).append(r)
    want = []
    for rows in by.values():
        rows.sort(key=lambda r: (r["ts"], r["trade_id"]), reverse=True)
        want += [r for r in rows[:30] if seconds is None or (rows[0]["ts"] - r["ts"]).total_seconds() <= seconds]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_each_row_once_over_three_runs(spark, sf_dir):
    t = ticks(spark, sf_dir).drop("date")
    path, out = files.shared_path(spark, "in"), stateful.StreamTable(spark, files.shared_path(spark, "out"))
    part = lambda k: t.where(F.col("trade_id") % 3 == k)
    part(0).repartition(3).write.parquet(path)
    stream = lambda: stateful.stream_of(spark, path, t.schema, 1)
    assert out.rows(t.schema).count() == 0
    assert out.run(stream()) == 3
    part(1).repartition(3).write.mode("append").parquet(path)
    calls = []

    def stop(i):
        calls.append(i)
        if len(calls) == 2:
            raise RuntimeError("stopped between write and commit")

    with pytest.raises(Exception, match="stopped between"):
        out.run(stream(), before_commit=stop)
    part(2).repartition(2).write.mode("append").parquet(path)
    assert out.run(stream()) == 4
    got = out.rows(t.schema)
    assert sorted(map(tuple, got.drop("_batch").collect())) == sorted(map(tuple, t.collect()))
    assert got.select("_batch").distinct().count() == 8 and out.run(stream()) == 0


def test_a_bounded_run_stops_and_goes_on(spark, sf_dir):
    t = ticks(spark, sf_dir)
    path, s = parted(spark, t, 4)
    out = stateful.StreamTable(spark, files.shared_path(spark, "out"))
    assert out.run(s, max_batches=1) == 1
    assert 0 < out.rows(t.schema).count() < t.count()
    assert out.run(stateful.stream_of(spark, path, t.schema), max_batches=100) >= 3
    assert out.rows(t.schema).count() == t.count()
