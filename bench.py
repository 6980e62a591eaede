"""Times the headline queries: python bench.py

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_QUERIES (comma-separated names).
Every query runs to the end into Spark's no-op sink; the better of two runs counts, or the only one of a query
that takes more than half a minute.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticketloom.catalog import load  # noqa: E402
from ticketloom.session import build_session  # noqa: E402

HEADLINE = [
    "class_distribution", "stream_enrich", "clean_text", "build_rag_docs", "cache_lookup", "incremental_embeddings",
    "apply_feedback", "append_feedback", "data_profile", "classification_report", "stratified_split",
    "stratified_sample", "row_index", "tfidf_vocabulary", "tfidf_features", "embed_texts", "detect_language",
    "retrieve", "retrieve_filtered", "retrieve_with_fallback", "query_doc_pairs", "ann_retrieve", "column_drift",
    "history_before_last", "tumbling_class_counts", "feedback_stream_join", "train_and_evaluate", "predict_batch",
    "replace_table", "write_dataset", "train_on_tfidf", "random_search", "monitor_and_retrain",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = load()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            if runs[0] > 30:
                break
        seconds[name] = round(min(runs), 3)
        print(f"{name}:", *[f"{r:.2f}" for r in runs], file=sys.stderr, flush=True)
    line = {
        "metric": "total time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
