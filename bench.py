"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from corpusgraph.operators import blocks
from workload import inputs
from workload.compare import local_session
from workload.registry import CHECKS

HEADLINE = (
    "story_analytics",
    "top_tags",
    "clean_publications",
    "newest_publications",
    "pending_extractions",
    "pending_embedding_batches",
    "extraction_cost_summary",
    "embedding_cost_summary",
    "full_refresh",
    "keyed_update",
    "csv_append",
    "extract_pairs",
    "similar_pairs",
    "knn",
    "dense_problem_edges",
    "cluster_assign",
    "clustered_graph_edges",
    "graph_edges",
    "similarity_stats",
    "sql_join_agg",
)
# Columns whose vectors are all compared with each other.
VECTOR_COLUMNS = {"knn": 1, "dense_problem_edges": 1, "graph_edges": 2}


def copy_ratios(spark, sf: str) -> dict[str, float]:
    """How often a vector is sent in the pair join at 0.80, by number of pivots."""
    rows = inputs.vectors(spark, sf)
    vectors = blocks.load_vectors(rows, "id", "emb")
    layouts = {n: blocks.self_strips(vectors, 0.80, pivots=n).layout for n in (1, 32, 128)}
    return {str(n): round(layout.sent / vectors.count, 2) for n, layout in layouts.items()}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.monotonic()
        CHECKS[name].job(spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.monotonic() - start, 3)
    vectors = 4 * spark.read.parquet(f"{sf}/embeddings.parquet").count()
    columns = {name: n for name, n in VECTOR_COLUMNS.items() if name in took}
    pairs = vectors * (vectors - 1) // 2
    report = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf).removeprefix("sf"),
        "sends_per_vector": copy_ratios(spark, sf) if columns else {},
        "pairs_per_sec": {n: round(pairs * c / took[n]) for n, c in columns.items()},
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
