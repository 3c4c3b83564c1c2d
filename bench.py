"""Headline timings on one driver folder; prints one JSON line.

Stages run cold in a new workspace, in the order of a real run; every step
includes building its plan and writing its output. Queries then read the
written zones.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import partial

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart import schemas as S  # noqa: E402
from sparkmart.plans.catalogue import all_queries  # noqa: E402
from sparkmart.plans.workspace import workspace  # noqa: E402
from sparkmart.session import in_parallel  # noqa: E402

QUERIES = [
    "v00_error_code_counts",
    "v09_reconcile",
    "m05_fact_module_presentation_activity_type_week",
    "m06_fact_module_presentation_assessments_week",
    "m07_fact_student_module_presentation_week",
    "m08_train_frame",
    "m09_predict_frame",
    "c01_c07_predict_contract",
    "c11_mart_constraints",
    "e04_describe",
    "e07_spearman_matrix",
    "f01_engineered_features",
    "k02_k04_overall_metrics",
    "k08_metrics_by_week",
    "k10_threshold_sweep",
    "l02_logistic_full",
    "x03_top_factors",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    w = workspace(spark, folder)
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    def raw_zone() -> None:
        in_parallel([partial(w.raw, t) for t in S.TABLES])

    def clean_zone() -> None:
        in_parallel([partial(w.clean, t) for t in S.TABLES])

    def mart_zone() -> None:
        w.marts()

    timed("stage_raw_zone", raw_zone)
    timed("stage_clean_zone", clean_zone)
    timed("stage_mart_zone", mart_zone)
    queries = all_queries()
    for name in QUERIES:
        timed(
            name,
            lambda n=name: queries[n](spark, folder).write.format("noop").mode("overwrite").save(),
        )
    print(
        json.dumps(
            {
                "metric": "wall time of zone builds and headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
