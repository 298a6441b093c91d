"""Wall time of the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "daily_spend",
    "spend_class",
    "feature_table",
    "minmax_scale",
    "ordered_target_encode_pooled",
    "bag_sample",
    "goss_sample",
    "gini_best_split",
    "knn_classify",
    "knn_euclidean",
    "tree_classify",
    "forest_classify",
    "newton_regress",
    "newton_classify",
    "leafwise_regress",
    "oblivious_regress",
    "linear_regress",
    "dense_gradient_step",
)


def main() -> None:
    from daybook.session import local_session
    from registry.spark_queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    # Time per boosting round, the unit in which long fits grow.
    times["newton_round"] = round(times["newton_regress"] / 3, 3)
    start = time.perf_counter()
    QUERIES["newton_regress_binned"](spark, folder).write.format("noop").mode("overwrite").save()
    times["newton_round_binned"] = round((time.perf_counter() - start) / 20, 3)
    total = round(sum(times[n] for n in HEADLINE), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
             "sf": Path(folder).name.removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
