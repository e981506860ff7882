"""Wall-clock seconds of the headline queries, as one JSON line.

BENCH_SF_DIR   data folder      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores      (default 8)
BENCH_RUNS     timed runs       (default 3, after one warm-up; the median counts)
BENCH_QUERIES  comma-separated names (default: all below)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from riskweave.operators.evaluation import auc_evaluator  # noqa: E402
from riskweave.plans import catalogue, pipelines, training  # noqa: E402
from riskweave.sources.events import read_event_transactions  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SLOW = {
    "tune_and_fit",
    "score_and_auc",
    "gbt_scores",
    "stream_scores",
    "champion_decision",
    "tuning_results",
}
HEADLINE = [
    "transactions_scan",
    "group_count_by_month",
    "feature_prep_chain",
    "temporal_split_valid",
    "denylist_anti_join",
    "top_k_cards",
    "bootstrap_summary",
    "one_hot_array",
    "minmax_scale",
    "robust_scale_exact",
    "feature_vectors",
    "roc_auc_exact",
    "pooled_t_statistic",
    "envelope_roundtrip",
    "stream_feature_rows",
    "stream_ingest",
    "gbt_scores",
    "stream_scores",
    "champion_decision",
    "tune_and_fit",
    "score_and_auc",
    "tuning_results",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_grid_point(spark: SparkSession):
    """The tuning run of the published session: depth 10, 100 rows per node, and a refit."""
    trees = pipelines.gradient_boosted_trees()
    grid = training.parameter_grid(trees, depths=(10,), min_instances=(100,))
    data = read_event_transactions(spark, SF_DIR)
    return training.tune(data, trees, grid, partitions=int(CPUS)).model


def measure(spark: SparkSession) -> dict[str, float]:
    queries = catalogue.all_queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    state: dict[str, object] = {}

    def work(name: str) -> None:
        if name == "tune_and_fit":
            state["model"] = one_grid_point(spark)
        elif name == "score_and_auc":
            model = state.get("model") or one_grid_point(spark)
            scored = model.transform(read_event_transactions(spark, SF_DIR))
            auc_evaluator().evaluate(scored)
        else:
            run(queries[name](spark, SF_DIR))

    seconds = {}
    for name in names:
        warm_up, runs = (False, 1) if name in SLOW else (True, RUNS)
        if warm_up:
            work(name)
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            work(name)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("riskweave bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="riskweave-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).agg(F.sum("id")).collect()
    seconds = measure(spark)
    spark.stop()
    sf = Path(SF_DIR).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
