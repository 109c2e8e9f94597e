"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores. Each query
runs to the end without collecting rows: its result goes to Spark's no-op sink. One small
warm-up starts the JVM's and the session's machinery; each query is timed once.
"""

from __future__ import annotations

import json
import os
import time

from variloom.plans import RUNS
from variloom.session import build_session

HEADLINE = [
    "cohort_summary", "pair_adjacent", "seed_state", "repair_urls", "finished_lines_by_status", "work_units",
    "progress", "node_status", "jobs_by_case", "current_stage",
    "flagstat", "coverage_stats", "coordinate_sorted", "pileup", "somatic_calls", "somatic_by_chrom", "variant_counts",
    "vcf_concat", "rt_vcf", "split_counts",
    "output_status", "qa_running", "metric_summary",
    "codon_usage", "recode_windows", "window_filter", "window_pairs", "best_pairs", "apply_tags",
    "stream_current_stage", "stream_windowed",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false",
                          spark_ui_showConsoleProgress="false", spark_driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    RUNS["cohort_summary"](spark, folder).count()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        RUNS[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
