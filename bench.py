"""Time the headline queries; the last line printed is one JSON line with all figures.

A JSON line of the figures so far follows every query, so a run that is stopped
has still reported what it finished. The one-off query has a budget of its own:
beyond it the run is given up and reported as such.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query after one warm-up; the median counts), BENCH_QUERIES
(comma-separated names instead of the headline list), BENCH_ONCE_SECONDS (budget
of the one-off query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import threading
import time

from pyspark.sql import SparkSession

from stayline.queries import QUERIES

HEADLINE = (
    "demo_group",
    "services_tenure",
    "box_stats_lineitem",
    "value_frequencies_lineitem",
    "null_counts_lineitem",
    "column_profile",
    "profile_by_target",
    "transformation_log",
    "schema_inspection",
    "dedup_full",
    "dedup_subset_first",
    "iqr_winsorize_lineitem",
    "standard_scale_lineitem",
    "dataset_fingerprint_lineitem",
    "cleaned_customers",
    "validation_report_dirty",
    "stratified_split_orders",
    "kfold_assignment_orders",
    "one_hot_columns",
    "roc_auc_orders",
    "confusion_metrics_documents",
    "classification_report",
    "nearest_centroid",
    "silhouette",
    "enrich_predictions",
    "model_comparison",
    "batch_summary",
    "champion_history",
    "champion_current",
    "incremental_scoring",
)
#: Fits four models and scores a batch; run once, as the published figure is for one run too.
ONCE = ("weekly_summary",)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed_within(spark: SparkSession, name: str, sf_dir: str, budget: float) -> float | None:
    """Seconds of one run, or None if it was given up at its budget."""
    found: list[float] = []
    failed: list[BaseException] = []

    def work() -> None:
        try:
            found.append(timed(spark, name, sf_dir))
        except BaseException as error:  # handed to the caller below
            failed.append(error)

    worker = threading.Thread(target=work, daemon=True)
    worker.start()
    worker.join(budget)
    if worker.is_alive():
        spark.sparkContext.cancelAllJobs()
        return None
    if failed:
        raise failed[0]
    return found[0]


def report(seconds: dict[str, float], given_up: dict[str, float], sf_dir: str) -> None:
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    line = {
        "metric": "headline queries, warm median, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    if given_up:
        line["given_up_after"] = given_up
    print(json.dumps(line), flush=True)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    budget = float(os.environ.get("BENCH_ONCE_SECONDS", "900"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [*HEADLINE, *ONCE]
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}
    given_up: dict[str, float] = {}
    for name in names:
        if name in ONCE:
            took = timed_within(spark, name, sf_dir, budget)
            if took is None:
                given_up[name] = budget
            else:
                seconds[name] = round(took, 3)
        else:
            timed(spark, name, sf_dir)
            seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        report(seconds, given_up, sf_dir)
    if given_up:
        os._exit(0)  # the given-up thread may still be inside a call


if __name__ == "__main__":
    main()
