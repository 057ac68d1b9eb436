"""Operators that SQL can't express, against plain loops; edge cases; interval parsing; streams against batch."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.functions import scalars
from tickforge.operators import bars, micro, quality, series
from tickforge.operators import stats as S
from tickforge.plans import prefix
from tickforge.schema import ticks
from tickforge.sources import files
from tickforge.streaming import analyzers, streams

SCHEMA = "symbol string, trade_id long, ts timestamp, price decimal(18,8), quantity decimal(18,8), is_buyer_maker boolean, date date"


def loop_bars(rows, threshold, keep_tail, lookback=None):
    """(first, last, open, high, low, close, volume, dollars, ticks, deviation, seconds, threshold) of bars tick by tick."""
    out, cur, acc, sizes, limit = [], [], 0.0, [], threshold

    def close():
        p, q = np.array([float(r["price"]) for r in cur]), np.array([float(r["quantity"]) for r in cur])
        seconds = (cur[-1]["ts"] - cur[0]["ts"]).total_seconds()
        out.append((cur[0]["ts"], cur[-1]["ts"], p[0], p.max(), p.min(), p[-1], q.sum(), (p * q).sum(), len(cur), p.std(ddof=1) if len(p) > 1 else None, seconds, limit))

    for r in rows:
        cur.append(r)
        acc += float(r["price"]) * float(r["quantity"])
        if acc >= limit - 1e-9:
            close()
            sizes = [*sizes, acc][-(lookback or 1):]
            cur, acc = [], 0.0
            if lookback and len(sizes) >= 5:
                w = np.exp(np.linspace(-1, 0, len(sizes)))
                limit = float((w * sizes).sum() / w.sum())
    if keep_tail and cur:
        close()
    return out


BAR_COLUMNS = ["timestamp", "timestamp_close", "open", "high", "low", "close", "volume", "dollar_volume", "tick_count", "price_std", "duration_seconds", "threshold_used"]


def same_bars(got, want, slowest):
    assert len(got) == len(want)
    for r, x in zip(got, want):
        for c, v in zip(BAR_COLUMNS, x):
            ok = r[c] == v if not isinstance(v, float) else abs(r[c] - v) <= 2e-6 * max(1, abs(v))
            assert ok or v is None and (r[c] is None or r[c] != r[c]), (c, r, x)
        span = max(x[10], 1.0) if slowest else x[10] or 1.0
        assert abs(r["ticks_per_second"] - x[8] / span) < 1e-5 and abs(r["dollar_volume_per_second"] - x[7] / span) < 1e-3


def by_symbol(t):
    by = {}
    for r in t.orderBy("symbol", "ts", "trade_id").collect():
        by.setdefault(r["symbol"], []).append(r)
    return [by[s] for s in sorted(by, key=lambda s: (s is not None, s))]


@pytest.mark.parametrize("per_block", [2, 64])
@pytest.mark.parametrize("keep_tail", [True, False])
def test_reset_bars_against_a_loop(spark, sf_dir, monkeypatch, keep_tail, per_block):
    monkeypatch.setattr(bars, "BARS_PER_BLOCK", per_block)
    t = ticks(spark, sf_dir)
    got = bars.reset_bars(t, 5000.0, keep_tail).orderBy("symbol", "bar_id").collect()
    same_bars(got, [x for s in by_symbol(t) for x in loop_bars(s, 5000.0, keep_tail)], False)
    assert [r["bar_id"] for r in got if r["symbol"] == "click"] == list(range(sum(r["symbol"] == "click" for r in got)))


def quick_ticks(spark, n, symbols, seed=0):
    """Ticks a tenth of a second apart with ties in time, some of them worth nothing or more than a bar; one symbol is null."""
    r = np.random.RandomState(seed)
    t0 = datetime(2024, 1, 1)
    price = np.round(r.choice([0.25, 1.0, 3.5, 700.0], n, p=[0.4, 0.3, 0.29, 0.01]), 2)
    quantity = r.choice([0.0, 1.0, 2.0], n, p=[0.1, 0.6, 0.3])
    rows = [(symbols[k % len(symbols)], k, t0 + timedelta(seconds=int(k // 3) * 0.1), __import__("decimal").Decimal(str(p)), __import__("decimal").Decimal(str(q)), bool(k % 2), t0.date()) for k, (p, q) in enumerate(zip(price, quantity))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("per_block", [1, 50])
def test_reset_bars_of_dense_ticks(spark, monkeypatch, per_block):
    monkeypatch.setattr(bars, "BARS_PER_BLOCK", per_block)
    t = quick_ticks(spark, 3000, ["a", "a", None])
    for threshold in (0.25, 40.0, 1e9):
        same_bars(bars.reset_bars(t, threshold).orderBy("symbol", "bar_id").collect(), [x for s in by_symbol(t) for x in loop_bars(s, threshold, True)], False)


def test_block_maps_compose():
    r = np.random.RandomState(3)
    for _ in range(300):
        n, limit = r.randint(1, 60), int(r.randint(1, 40))
        worth = np.minimum(r.randint(0, 15, n), limit)
        for open_ in range(limit):
            acc, closed = open_, 0
            for w in worth.tolist():
                acc += w
                if acc >= limit:
                    acc, closed = 0, closed + 1
            fits = [x for x in bars.block_map(worth, limit) if x[0] <= open_]
            assert (fits[-1][1:] if fits else (0, open_ + worth.sum())) == (closed, acc)


def test_a_symbols_reset_bars_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(bars, "BARS_PER_BLOCK", 4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d = bars.reset_bar_ids(quick_ticks(spark, 2000, ["a"]), 20.0)
        assert d.select(F.spark_partition_id()).distinct().count() > 1
        # Only the blocks' totals and maps meet by symbol; ticks are dealt by blocks.
        plan = d._jdf.queryExecution().executedPlan().toString()
        by = [x for x in plan.split("\n") if "Exchange hashpartitioning(" in x]
        assert len(by) >= 3 and "price" not in "".join(x for x in by if "symbol" in x)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("lookback", [20, 6, 3])
def test_adaptive_bars_against_a_loop(spark, sf_dir, lookback):
    for t, threshold in ((ticks(spark, sf_dir), 5000.0), (quick_ticks(spark, 2000, ["a", "b"], 5), 12.0)):
        got = bars.adaptive_bars(t, threshold, lookback).orderBy("symbol", "bar_id").collect()
        same_bars(got, [x for s in by_symbol(t) for x in loop_bars(s, threshold, False, lookback)], True)
        assert lookback >= 5 or {r["threshold_used"] for r in got} == {threshold}


def test_rows_without_symbol_or_time_stay(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0, 1), (None, t0, 2), ("a", None, 3), (None, None, 4), ("a", t0 + timedelta(days=3), 5), (None, t0 + timedelta(days=3), 6)]
    d = spark.createDataFrame(rows, "symbol string, ts timestamp, trade_id long")
    got = {r["trade_id"]: (r["s"], r["p"]) for r in prefix.previous(prefix.running_total(d, F.col("trade_id"), "s"), {"trade_id": "p"}).collect()}
    assert got == {3: (3, None), 1: (4, 3), 5: (9, 1), 4: (4, None), 2: (6, 4), 6: (12, 2)}
    y = {r["trade_id"]: r["y"] for r in prefix.decayed_sum(d, F.col("trade_id"), 0.5, "y").collect()}
    assert y == {3: 3.0, 1: 2.5, 5: 6.25, 4: 4.0, 2: 4.0, 6: 8.0}


def test_three_semantics_differ(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", i, t0 + timedelta(seconds=i), p, 1, False, t0.date()) for i, p in enumerate([50, 250, 10, 10])]
    t = spark.createDataFrame([(a, b, c, __import__("decimal").Decimal(d), __import__("decimal").Decimal(e), f, g) for a, b, c, d, e, f, g in rows], SCHEMA)
    assert [r["bar_id"] for r in bars.dollar_bars(t, 100).orderBy("bar_id").collect()] == [0, 3]
    assert [r["tick_count"] for r in bars.reset_bars(t, 100.0).orderBy("bar_id").collect()] == [2, 2]
    assert [r["tick_count"] for r in bars.reset_bars(t, 100.0, keep_tail=False).collect()] == [2]


def test_prefix_does_not_depend_on_blocks(spark, sf_dir):
    t = ticks(spark, sf_dir)
    got = [prefix.running_total(t, F.col("price") * F.col("quantity"), "c", unit=u).orderBy("symbol", "trade_id").select("c").collect() for u in ("hour", "day", "year")]
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_asof_join_of_all_rows(spark, unit):
    # All probes with all facts, with days without facts, probes before the first fact, and a symbol without any.
    t0, rnd = datetime(2024, 1, 1), np.random.RandomState(4)
    at = lambda m: t0 + timedelta(minutes=int(m))
    facts = [(s, at(m), float(i)) for s in "ab" for i, m in enumerate(np.sort(rnd.choice(20_000, 60, replace=False)))]
    probes = [(s, at(m), i) for s in "abc" for i, m in enumerate(rnd.choice(20_000, 200, replace=False))] + [("a", facts[5][1], 1000)]
    f, p = spark.createDataFrame(facts, "symbol string, ts timestamp, v double"), spark.createDataFrame(probes, "symbol string, ts timestamp, n long")
    got = {(r["symbol"], r["n"]): (r["fact_ts"], r["v"]) for r in series.asof_backward(p, f, ["v"], unit).collect()}
    want = {(s, n): max(((x, v) for q, x, v in facts if q == s and x <= ts), default=(None, None)) for s, ts, n in probes}
    assert got == want
    pairs = series.time_band_join(p, f, 7200).select("symbol", "n", "r_v").collect()
    near = [(s, n, v) for s, ts, n in probes for q, x, v in facts if q == s and abs((x - ts).total_seconds()) <= 7200]
    assert sorted(map(tuple, pairs)) == sorted(near)


def test_band_join_does_not_shuffle_its_right_side(spark, monkeypatch):
    f = spark.range(3000).selectExpr("cast(id % 3 as string) symbol", "timestamp_seconds(id * 700) ts", "id v").unionByName(spark.range(1).selectExpr("'0' symbol", "cast(null as timestamp) ts", "-1L v"))
    p = f.where("v % 20 = 0 or v < 0").selectExpr("symbol", "ts", "v n").unionByName(spark.sql("SELECT cast(null as string) symbol, timestamp_seconds(700) ts, -2L n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = series.time_band_join(p, f, 7200)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "r_ts" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning(" in x)
        monkeypatch.setattr(series, "MAX_VALUES", 10)
        many = series.time_band_join(p, f, 7200)
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString() and many.columns == few.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = sorted((n, v) for n in range(0, 3000, 20) for v in range(n % 3, 3000, 3) if abs(n - v) * 700 <= 7200)
    assert sorted(map(tuple, few.select("n", "r_v").collect())) == sorted(map(tuple, many.select("n", "r_v").collect())) == want


def test_asof_join_spreads_a_symbol(spark):
    p = spark.range(2000).selectExpr("'a' AS symbol", "timestamp_seconds(id * 3600) AS ts", "id AS n")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = series.asof_backward(p, p.select("symbol", "ts", F.col("n").alias("v")), ["v"])
        assert out.where("v <> n").count() == 0 and out.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_decayed_sum(spark, sf_dir):
    t = ticks(spark, sf_dir)
    got = {(r["symbol"], r["trade_id"]): r["y"] for r in prefix.decayed_sum(t, F.col("quantity"), 0.9, "y").collect()}
    last = {}
    for r in t.orderBy("symbol", "ts", "trade_id").collect():
        last[r["symbol"]] = 0.9 * last.get(r["symbol"], 0.0) + float(r["quantity"])
        assert abs(got[r["symbol"], r["trade_id"]] - last[r["symbol"]]) < 1e-9


def test_fractional_difference(spark, sf_dir):
    c = S.ohlcv(ticks(spark, sf_dir), "4h")
    w = series.fractional_weights(0.4, 1e-2)
    got = series.fractional_difference(c, 0.4, 1e-2).orderBy("symbol", "bucket").collect()
    by = {}
    for r in got:
        by.setdefault(r["symbol"], []).append(r)
    for rows in by.values():
        x = [float(r["close"]) for r in rows]
        for i, r in enumerate(rows):
            want = sum(w[k] * x[i - k] for k in range(len(w))) if i >= len(w) - 1 else None
            assert (r["frac_diff"] is None) == (want is None) and (want is None or abs(want - r["frac_diff"]) < 1e-5)


def test_value_area(spark, sf_dir):
    p = micro.profile(ticks(spark, sf_dir))
    hist = {}
    for r in p.collect():
        hist.setdefault((r["symbol"], r["bucket"]), [0.0] * 20)[r["bin"]] = r["volume"]
    for r in micro.value_area(p).collect():
        h = hist[r["symbol"], r["bucket"]]
        poc = h.index(max(h))
        lo = hi = poc
        v = h[poc]
        while v < 0.7 * sum(h):
            low, high = (h[lo - 1] if lo else -1.0), (h[hi + 1] if hi < 19 else -1.0)
            if low >= high and lo:
                lo, v = lo - 1, v + low
            else:
                hi, v = hi + 1, v + high
        assert (r["poc"], r["va_low"], r["va_high"]) == (poc, lo, hi)


def test_backfill_pieces_cover_ranges(spark, sf_dir):
    t = ticks(spark, sf_dir)
    ranges = series.missing_ranges(series.islands(t), datetime(2024, 1, 5), datetime(2024, 1, 8))
    plan = quality.backfill_plan(t, ranges, 20)
    a = ranges.selectExpr("sum(unix_micros(missing_end) - unix_micros(missing_start)) s").first()["s"]
    z = plan.selectExpr("sum(unix_micros(piece_end) - unix_micros(piece_start)) s").first()["s"]
    assert a == z


def test_stream_bars_match_batch(spark, sf_dir):
    s = streams.run_to_files(streams.reset_bars(streams.stream_ticks(spark, sf_dir), 5000.0), "t-bars")
    b = bars.reset_bars(ticks(spark, sf_dir), 5000.0, keep_tail=False)
    cols = ["symbol", "bar_id", "tick_count", "open", "close"]
    assert sorted(map(tuple, s.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_stream_bars_close_on_exact_sums(spark):
    # Ten dimes are a dollar; as doubles they are less.
    path = files.shared_path(spark, "dimes")
    for k in range(2):
        spark.range(1005 * k, 1005 * (k + 1)).selectExpr("'a' symbol", "id trade_id", "timestamp_seconds(id) ts", "cast(0.1 as decimal(18,8)) price", "cast(1 as decimal(18,8)) quantity").coalesce(1).write.mode("append").parquet(path)
    s = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    b = streams.run_to_files(streams.reset_bars(s, 1.0), "dime-bars").orderBy("bar_id").select("bar_id", "timestamp", "tick_count", F.round("dollar_volume", 9)).collect()
    assert [tuple(r) for r in b] == [(i, datetime(1970, 1, 1) + timedelta(seconds=10 * i), 10, 1.0) for i in range(201)]


def test_sampler_sums_do_not_grow():
    # Running sums of all these ticks would leave the whole numbers that a double holds.
    limit, n = 400_000_000_001, 200_000
    some = np.random.RandomState(3).randint(1, 300_000_000_000, n)
    worth = np.column_stack([some, limit - some]).ravel().astype(float)
    got = bars.Sampler(limit / 1e8, 8).feed(np.arange(2 * n), worth / 1e8, np.ones(2 * n), worth)
    assert len(got) == n and {r[9] for r in got} == {2}


def test_empty_ticks(spark):
    t = spark.createDataFrame([], SCHEMA)
    for d in (S.ohlcv(t, "1h"), bars.dollar_bars(t, 100), bars.reset_bars(t, 100.0), bars.adaptive_bars(t, 100.0), series.gaps(t), series.islands(t), quality.assessment(t, datetime(2024, 1, 1)), micro.runs_test(t)):
        assert d.count() == 0
    with pytest.raises(ValueError):
        bars.require_valid(t)


def test_intervals():
    assert scalars.parse_interval("15m") == (15, "m") and scalars.interval_seconds("1w") == 604800
    for bad in ("", "m", "0m", "5x", "1.5h"):
        with pytest.raises(ValueError):
            scalars.parse_interval(bad)


def test_pruned_scan(spark, sf_dir):
    path = files.shared_path(spark, "t-ticks")
    files.write_ticks(ticks(spark, sf_dir), path)
    plan = files.read_ticks(spark, path, "click", "2024-01-05", "2024-01-06", ["price"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "click" in plan
    with pytest.raises(Exception):
        files.read_ticks(spark, path + "-none").count()


def test_registry_of_analyzers():
    r = analyzers.Registry()
    r.register(analyzers.SimpleCounter())
    with pytest.raises(ValueError):
        r.register(analyzers.SimpleCounter())
    r.enable("counter", False)
    with pytest.raises(ValueError):
        r.run(None)


def test_decayed_sums_and_islands_of_a_dense_day(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tickforge.operators import series
    from tickforge.plans import prefix

    start = dt.datetime(2024, 1, 5, 1)
    rows, at = [], start
    for i in range(12_000):
        at += dt.timedelta(milliseconds=200 if i % 4000 else 3_600_000)
        rows.append(("a", i, at, float(i % 7 + 1)))
    d = spark.createDataFrame(rows, "symbol string, trade_id long, ts timestamp, price double")
    for decay in (0.9, 0.999, 0.05):
        got = [r["y"] for r in prefix.decayed_sum(d, F.col("price"), decay, "y").orderBy("trade_id").collect()]
        y = 0.0
        for r, g in zip(rows, got, strict=True):
            y = decay * y + r[3]
            assert abs(g - y) <= 1e-9 * y
    got = series.islands(d).orderBy("island_start").collect()
    assert [r["n"] for r in got] == [4000, 4000, 4000] and got[0]["island_start"] == rows[0][2]


@pytest.mark.parametrize("small", [1, 20, 100_000])
def test_exact_quantiles(spark, small):
    from tickforge.operators.selection import exact_quantiles

    r = np.random.RandomState(8)
    groups = {
        "normal": r.randn(700), "ties": r.choice([1.0, 2.0], 500, p=[0.97, 0.03]), "wide": 10.0 ** r.uniform(-300, 300, 400), "one": np.array([5.0]), "same": np.full(300, -2.5), "tail": np.concatenate([r.rand(300), [1e18]]), None: r.randint(0, 9, 250).astype(float),
    }
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("normal", None), ("empty", None)]
    at = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p951": 0.951, "p100": 1.0}
    d = spark.createDataFrame(rows, "symbol string, v double")
    got = {x["symbol"]: x for x in exact_quantiles(d, "v", at, small=small).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        for n, p in at.items():
            want = np.quantile(x, p)
            assert abs(got[k][n] - want) <= 1e-9 * abs(want), (k, n)
    assert exact_quantiles(d.limit(0), "v", at).count() == 0


def test_versions_of_a_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    t = spark.range(10)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_version(spark, path).count()
    ids = lambda **at: sorted(r["id"] for r in files.read_version(spark, path, **at).collect())
    assert files.commit_version(t.where("id < 3"), path) == 1
    # Rows of a writer that failed before its commit are not seen, and are overwritten by the next one.
    t.where("id > 7").write.parquet(f"{path}/rows/2")
    assert ids() == [0, 1, 2]
    assert files.commit_version(t.where("id = 5"), path) == 2
    assert files.commit_version(t.where("id < 0"), path) == 3
    assert ids() == [0, 1, 2, 5]
    assert files.commit_version(t.where("id = 9"), path, replace=True) == 4
    assert files.commit_version(t.where("id = 9"), path) == 5
    assert [ids(version=v) for v in (1, 2, 3, 4, 5)] == [[0, 1, 2], [0, 1, 2, 5], [0, 1, 2, 5], [9], [9, 9]]
    times = {r["version"]: r["committed_at"] for r in spark.read.parquet(f"{path}/commits").collect()}
    assert ids(as_of=times[2]) == [0, 1, 2, 5] and ids(as_of=times[4]) == [9] and ids(as_of="2999-01-01") == [9, 9]
    with pytest.raises(ValueError):
        files.read_version(spark, path, version=6)
    with pytest.raises(ValueError):
        files.read_version(spark, path, as_of="2000-01-01")
