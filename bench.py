"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

One warm-up, then the median of three runs per query; each run forces full
evaluation with the ``noop`` sink (every row computed, nothing collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickframe.plans import catalog  # noqa: E402
from tickframe.session import build_session  # noqa: E402

HEADLINE = [
    "r17_portfolio_analytics",    # flagship: every portfolio's analytics in one job
    "r18_backtest",
    "r11_risk_metrics",
    "r12_risk_attribution",
    "s23_indicator_table",        # full technical-indicator row per (symbol, date)
    "w10_rolling_portfolio_metrics",
    "c02_forward_fill",
    "c07_resample_monthly",
    "j07_macro_asof",
    "f01_screen",
    "a05_screener_summary",
    "a16_correlation_matrix",
    "a14_covariance_matrix",
    "st01_rate_alerts",
    "st10_hourly_bars",
]


def run(spark, fn, sf_dir):
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", partitions=cpus)
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in names if any(p in n for p in sys.argv[1:])]
    out = {}
    if names:
        run(spark, qs[names[0]], sf_dir)  # JVM / JIT warm-up shared by all queries
    for n in names:
        run(spark, qs[n], sf_dir)  # warm-up
        out[n] = round(statistics.median(run(spark, qs[n], sf_dir) for _ in range(3)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
