"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tickforge import registry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
HEADLINE = [
    "agg01_ohlcv_1m", "agg01_ohlcv_1d", "agg03_symbol_stats", "agg06_volume_profile", "agg17_order_flow_windows", "bar02_dollar_bars", "bar_lineitem_dollar_bars", "bar05_adaptive_bars", "bar06_reset_bars",
    "win01_gaps", "win06_rsi", "win13_cumulative_dollar_volume", "win16_islands", "dq02_duplicate_breakdown", "dq08_dq11_assessment", "dq15_jn04_anomalies", "mic01_order_flow", "mic02_win23_runs_test", "obk02_depth", "jn02_asof_backward",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.sql.shuffle.partitions", str(CPUS)).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda n: registry.QUERIES[n](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    run("agg03_symbol_stats")
    took = {}
    for name in HEADLINE:
        best = []
        for _ in range(2):
            t = time.perf_counter()
            run(name)
            best.append(time.perf_counter() - t)
        took[name] = round(min(best), 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
