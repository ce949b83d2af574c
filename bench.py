"""Headline queries on $BENCH_SF_DIR with $BENCH_CPUS threads; prints one JSON line.

A few queries are run first to warm up (JIT, Python workers); then each query is run once.
"""

from __future__ import annotations

import importlib.util
import json
import os
import sys
import tempfile
import time
from pathlib import Path

HEADLINE = [
    "bm25_topk", "dense_topk", "vector_topk", "cell_topk", "compressed_topk", "multi_query", "parent_document",
    "semantic_topk", "rrf_ensemble", "containment_qrels", "relevance_summary", "context_recall",
    "retriever_aggregates", "comparison_wide", "html_documents", "fixed_windows", "recursive_chunks",
    "standardise_inferred", "key_coverage", "simple_graph", "connected_components", "clustering",
    "event_rollup", "incremental_ingest",
]


WARM_UP = ["bm25_topk", "semantic_topk", "simple_graph", "event_rollup"]


def main() -> None:
    here = Path(__file__).resolve().parent
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    sys.path.insert(0, str(here))
    from gleaner.session import build_session, release

    spark = build_session(
        "gleaner-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("spark_entry", here / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    queries = entry.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in WARM_UP:
        run(name)
    times = {name: run(name) for name in names}
    release(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
