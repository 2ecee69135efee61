"""Time headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netsleuth.plans import catalog  # noqa: E402
from netsleuth.session import build_session  # noqa: E402

HEADLINE = [
    "flow_verdicts", "build_flows", "engineer_features", "model_matrix", "gate_report", "split_train_test",
    "stratified_sample", "kfold", "score_flows", "evaluate_detector", "drift_wasserstein", "drift_ks", "drift_psi",
    "drift_decision", "ate_aipw", "ate_ols", "refute_placebo", "cate_by_quartile", "graph_edges", "message_edges",
    "sample_negatives", "neighbour_mean", "link_heuristics", "rank_techniques", "chunk_fixed", "chunk_recursive",
    "tfidf_weights", "two_stage_retrieve", "vector_topk", "context_recall", "groundedness", "answer_relevancy",
    "cve_lookup", "score_runs", "train_detector", "stream_score", "stream_session",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = catalog.queries()
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        # small inputs: keep a task per core instead of merging them to one
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
