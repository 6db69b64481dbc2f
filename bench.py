"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the local cores.
Every query is run once to compile and warm, then timed writing to the no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from lodestrata.plans import registry
from lodestrata.session import build_session

HEADLINE = [
    "vector_topk", "retrieval_hit_mrr", "keyword_search", "keyword_score_rank", "funnel_counts", "dedup_keep_best", "chunk_documents", "norm_text", "context_budget_inclusive", "block_index",
    "positional_join", "role_sets", "resolve_by_role", "scope_normalize", "unit_normalize", "quality_issues", "review_queue", "numeric_metrics", "field_metrics", "citation_metrics", "error_buckets",
    "pipeline_cost_report", "upsert_coalesce", "replace_by_key", "stratified_round_robin", "document_parse",
    "record_faults", "keyed_upsert", "report_main_table", "gold_documents", "embed_chunks",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = {n: registry.QUERIES[n] for n in HEADLINE}
    try:
        from lodestrata.llm.queries import QUERIES as more

        queries |= more
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith("lodestrata.llm"):
            raise
    took = {}
    for name, f in queries.items():
        f(spark, sf_dir).write.format("noop").mode("overwrite").save()
        t = time.perf_counter()
        f(spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
