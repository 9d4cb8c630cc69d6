"""Time the headline queries, one run of each in a warm JVM, into a sink that drops the rows.

Prints one line of JSON. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores; names given
as arguments run only those queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyward.plans import QUERIES  # noqa: E402
from tallyward.session import build_session  # noqa: E402

HEADLINE = (
    "scan_parquet", "dedup_rows", "impute_mean", "impute_median", "outliers_iqr", "cap_outliers", "clean_discharges",
    "feat_all_sql", "group_stats", "group_stats_all_dims", "box_stats", "corr_matrix", "histogram", "topk_diagnoses",
    "encode_label", "scale_standard", "eval_metrics", "eval_spearman", "drift_detect", "drift_by_window",
    "json_requests_parse", "train_gbt",
)
WARM_UP = ("feat_all_sql", "group_stats")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"), "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        print(f"{name} {seconds[name]} s, {jobs} jobs", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_warm_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
