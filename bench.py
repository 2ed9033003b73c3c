"""Bench: median of three warm runs of each headline query, as one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Every
query is computed in full into Spark's no-op sink; queries that end in a written
table are timed including the write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "downsample_long",
    "downsample_moments",
    "downsample_wide",
    "downsample_v2_bars",
    "online_features",
    "intraday_returns",
    "interval_vwap",
    "return_table",
    "lag_returns",
    "shift_dates",
    "slot_schedule",
    "dataset_join",
    "dataset_build",
    "milestone_splits",
    "zscore_fit_apply",
    "cs_zscore",
    "latest_models",
    "feature_matrix",
    "matrix_model_score",
    "linear_score",
    "ensemble_mean",
    "alpha_hist",
    "stream_downsample",
]


def run(fn, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)  # warm-up
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(3)), 3)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
