"""Times the headline queries and prints one JSON line.

Every query runs twice: "cold" is its first run (class loading, code generation), "queries" and the total are the
second. BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores; names given
as arguments choose other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from geocadence.catalog import load_all  # noqa: E402
from geocadence.catalog.registry import QUERIES  # noqa: E402
from geocadence.session import build_session  # noqa: E402

HEADLINE = [
    "a5_rain_indicators", "a6_sm_indicators", "w1_rolling_cell_sum", "a3_circle_peaks", "w2_rolling_area_sum", "scenario_table",
    "m8_predictor_table", "a1_slip_counts", "j1_point_polygon", "j6_newest_run_wins", "a7_coverage", "j8_nearest_regrid",
    "j15_rasterize", "j17_asof_tolerance", "m2_kernel_score_collapsed", "m5_cross_validation", "w8_thin_greedy", "o1_run_catalogue",
]


def main() -> None:
    load_all()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "geocadence-bench", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{folder}/events.parquet").count()  # starts the engine
    cold, seconds = {}, {}
    for name in names:
        for times in (cold, seconds):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "cold": cold,
                      "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
