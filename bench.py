"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from rankloom.catalog.all_queries import REGISTRY
from rankloom.session import local_session

HEADLINE = [
    "standard_terms",
    "relevant_fraction",
    "stored_postings",
    "top_hits",
    "bm25_evaluation",
    "search_without_stored_index",
    "union_of_hits",
    "cosine_rescore",
    "chunk_rerank",
    "result_page",
    "mean_pooled_documents",
    "tfidf_weights",
    "top_keywords",
    "keyword_rerank",
    "noun_phrase_model",
    "document_summaries",
    "expansion_by_first_sense",
    "expansion_by_vector",
    "expansion_by_graph",
    "search_with_expanded_queries",
    "evaluation_grid",
    "json_lines_corpus",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["snippets"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        result = REGISTRY[name].build(spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
