"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON.

A query is run to its end into the noop sink, once to warm up and once for the figure. rows_per_sec holds the throughput of the
batch steps that the reference publishes figures for, over the rows that the query reads.
"""

from __future__ import annotations

import json
import os
import time

from quarry.session import session

HEADLINE = [
    "clean_dedup_ledger", "clean_html_text", "normalize_whitespace", "dedup_first_wins", "occurrence_backfill", "cross_source_merge", "field_empty_rate", "residue_audit",
    "shared_node_merge", "citation_split", "edge_id_rewrite", "edge_upsert_last", "next_step_edges", "referential_integrity", "reconcile_counts", "traverse_out", "star_join",
    "shared_anchor_reverse", "neighborhood_expand", "context_render", "vector_topk", "multihop_plan", "chunk_documents", "sentence_units", "stratified_sample",
    "em_f1_score", "score_grouping_sets", "bag_match_ab", "window_session", "pricing_summary",
]
#: Query, table it reads, and the reference's published rows a second of that step.
STEPS = {"clean_dedup_ledger": ("documents", 2682), "clean_html_text": ("pages", 2682), "cross_source_merge": ("documents", 5473), "residue_audit": ("pages", 4216), "edge_upsert_last": ("lineitem", 83)}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    from quarry import catalog

    queries, took = catalog.queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            began = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - began, 3)
    rates = {q: {"rows_per_sec": round(spark.read.parquet(f"{sf}/{t}.parquet").count() / took[q]), "published": p} for q, (t, p) in STEPS.items()}
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "rows_per_sec": rates, "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
