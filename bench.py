"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default all) choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tankwise.catalog import QUERIES  # noqa: E402
from tankwise.session import build_session  # noqa: E402

HEADLINE = [
    "batch_metrics",
    "missing_both",
    "outlier_clip",
    "scale_by_tank",
    "resample_by_tank",
    "align_phase",
    "rolling_stats",
    "feat_all",
    "validate_rules",
    "anom_all",
    "cp_cusum",
    "pearson_matrix",
    "golden_similarity",
    "batch_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000).selectExpr("sum(id)").collect()  # starts the executors' code paths
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
