"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from gatelake.plans.queries import QUERIES
from gatelake.session import local_session

HEADLINE = [
    "line_count", "strip_comments", "extract_modules", "count_modules", "module_hash", "hash_frequency",
    "module_hash_counts", "sorted_hash_listing", "hierarchy_from_text", "size_report", "corpus_totals",
    "designs_per_source", "rank_series", "histogram_log", "upsert_designs", "last_written_files",
    "netlist_instances", "connectivity_nodes", "connectivity_edges", "clock_candidates", "ast_flatten",
    "ast_edges", "closure", "is_dag", "top_scores", "auto_top", "sub_design_dedup", "subdesign_text",
    "blif_fix_constants", "blif_add_global_clock", "unroll_cell_arrays", "token_count", "char_counts",
    "tfidf_char", "tfidf_word_ngrams", "pca_2d", "expand_archives", "apply_source_rules", "validate_source",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    names = [n for n in HEADLINE if len(sys.argv) < 2 or n in sys.argv[1:]]
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
