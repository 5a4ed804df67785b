"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores; BENCH_RUNS (default 3) the timed runs after two warm-ups.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("SPARK_LOCAL_HOSTNAME", "localhost")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortkit import build_session, scratch  # noqa: E402
from queries import queries  # noqa: E402

WARM_UP = 2
HEADLINE = (
    "flagship_clean",
    "flagship_train_ready",
    "flagship_health",
    "c_select_cohort",
    "d_vital_mean_std",
    "d_vital_slope",
    "d_lab_pivot",
    "g_split_patient",
    "g_split_person",
    "g_split_temporal",
    "g_split_site",
    "k_label_encode_safe",
    "k_scale_standard",
    "k_train_only_pipeline",
    "l_cardinality_scan",
    "l_duplicate_rows",
    "m_threshold_youden",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    registered, taken = queries(), {name: [] for name in names}
    # Rounds over all queries, so that none is timed on a cold machine.
    for run in range(runs + WARM_UP):
        for name in names:
            start = time.perf_counter()
            with scratch(spark):
                # Every row and column is computed; nothing is sent to the driver.
                registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run >= WARM_UP:
                taken[name].append(time.perf_counter() - start)
    times = {name: round(statistics.median(ts), 3) for name, ts in taken.items()}
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries, median of runs after two warm-ups",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rsplit("/", 1)[-1].removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
