"""Headline benchmark: prints ONE JSON line with per-query wall seconds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced end to end with the ``noop`` sink (every row computed,
nothing collected).  A query's time includes everything it needs, fits too, except ``tree_predict_only`` which times
scoring with an already fitted tree.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "information_gain", "gini_gain", "mse_reduction", "mae_reduction",
    "tree_fit_cls_ig", "tree_fit_cls_gini", "tree_fit_reg_mse", "tree_fit_reg_mae", "tree_fit_lineitem_mse",
    "tree_predict_cls",
    "balanced_sample", "split_stratified",
    "eda_corr", "eda_histogram", "eda_boxplot",
    "html_elements", "player_rows", "player_details",
    "stream_ingest", "player_tree_accuracy", "player_reg_scores",
]


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    from sylvan.plans import QUERIES
    from sylvan.plans import learn_queries, trees
    from sylvan.session import checkpoint_root, get_spark
    from sylvan.sources.tables import table

    spark = get_spark(f"local[{CPUS}]", app="sylvan-bench", shuffle_partitions=int(CPUS) * 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(int(CPUS) * 4))
    checkpoint_root(spark)
    _force(table(spark, SF_DIR, "region"))  # JVM warm-up

    times, failed = {}, {}

    def timed(name, fn):
        t0 = time.time()
        try:
            fn()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - record and keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"

    for name in HEADLINE:
        timed(name, lambda name=name: _force(QUERIES[name](spark, SF_DIR)))

    # scoring alone: the model is fitted first, outside the timer
    model = trees.model(spark, SF_DIR, "cls_ig")
    timed("tree_predict_only", lambda: _force(model.predict(trees._src(spark, SF_DIR, "lineitem"))))

    # logistic regression, 100 full-batch epochs
    timed("logreg_100_epochs", lambda: learn_queries._lr_model(spark, SF_DIR, epochs=100, every=10))

    total = round(sum(times.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_wall", "value": total, "unit": "sec", "queries": times,
           "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(CPUS)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
