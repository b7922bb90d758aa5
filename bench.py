"""Benchmark the headline jobs on the driver tables.

Runs each query end to end (plan building, including any sampling or
checkpoint actions, plus full execution into Spark's ``noop`` sink, so
nothing is collected) at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import catalog  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = [
    "recommend_top_n",          # the one job the reference times
    "candidate_lists",
    "mutual_friend_counts",
    "rating_profile",
    "user_rate_histogram",
    "top_user_titles",
    "itemset_support",
    "roc_curve_orders",
    "partial_auc",
    "precision_sweep_orders",
    "split_train_test",
    "bag_of_words",
    "score_predictions",
    "number_included_accuracy",
    "assign_cluster",
    "pca_per_cluster",
    "kmeans_euclidean",
    "read_ratings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024)}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), extra=extra)
    if not spark.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="quarry-bench-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    catalog.load_all()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
