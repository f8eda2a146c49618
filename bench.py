"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_REPEATS
(default 1; the median is reported) steer the run. One unmeasured warm-up query starts the
session; each query is then written to the noop sink, so all its rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from loanproof.queries import queries
from loanproof.session import build_session

HEADLINE = [
    "label_maturity_by_quarter",
    "audit_table",
    "outlier_screen",
    "missing_profile",
    "dedup_keep_first",
    "cardinality",
    "partition_overlap",
    "chronological_split",
    "time_series_folds",
    "row_ordinal",
    "binary_metrics",
    "roc_curve",
    "subgroup_age",
    "subgroup_extended",
    "threshold_sweep",
    "calibration_bins",
    "bootstrap_tree",
    "random_split_exact",
    "train_test_contamination",
    "mutual_information",
    "train_only_preprocess",
    "target_encode_train",
    "fit_freeze_score",
    "near_duplicate_screen",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    known["default_rate_by_year"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        took = []
        for _ in range(repeats):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
