"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, the median is reported);
after BENCH_BUDGET seconds (default 400) every further query is run once. `runs` says how often each query ran.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_brands_by_orders", "avg_balance_filtered_join", "left_join_three_keys", "join_key_audit", "dedup_by_key", "distinct_rows",
    "ratio_filter_safe", "wide_to_long_totals", "stratified_split", "positional_split", "numeric_summary", "group_describe",
    "pearson_pairs", "spearman_pairs", "relative_importance", "brand_baskets", "assoc_rules", "nonredundant_rules", "tokens_clean",
    "ngram_counts", "phrase_chunks", "sentiment_by_document", "readability", "tfidf_tidy", "tfidf_l2_top_terms", "gram_matrix",
    "fit_statistics", "residual_diagnostics", "logistic_glm", "naive_bayes_confusion", "auc_rank", "nearest_neighbours", "knn_imputed",
    "silhouette_rows", "exemplar_rows", "review_table", "decision_tree_report", "adaboost_report",
    "hashed_term_buckets", "kmeans_profile", "density_clusters", "single_linkage_sizes", "smote_class_sizes",
]


def main() -> None:
    from tallyloom.plans import load_all
    from tallyloom.runtime import build_session, drop_stages

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    budget = float(os.environ.get("BENCH_BUDGET", "400"))
    started = time.time()
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    times: dict[str, float] = {}
    counts: dict[str, int] = {}
    for name in names:
        taken = []
        for i in range(runs):
            if i and time.time() - started > budget:
                break
            began = time.time()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - began)
            drop_stages(spark)
        times[name], counts[name] = round(statistics.median(taken), 3), len(taken)
        print(name, [round(x, 2) for x in taken], file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_queries_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": float(scale.group(1)) if scale else None, "runs": counts, "cpus": int(cpus), "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
