"""Times queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``python bench.py`` runs the headline queries, ``python bench.py all`` or names any others.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley import catalog, runtime

# Run once untimed: starts the JVM, fills the file cache.
WARM_UP = "token_counts"

HEADLINE = """
mention_extract mention_counts_by_source mention_extract_by_join mention_sentiment incremental_new_events
recent_lookback rolling_7d_daily dedup_first_seen append_only_new target_limit_ordered thread_flatten
template_expansion chunk_text group_concat_topic sentiment_scores token_counts ngram_counts ctfidf_top_terms
topic_info topic_similarity topic_centroids nearest_neighbours keyword_rerank mmr_select density_clusters
summarise_chunks topic_summaries class_metrics rouge_n rouge_l bleu_corpus readability token_match_score
topic_coherence stream_ingest topic_model_fit approx_topic_distribution
""".split()


def memory() -> str:
    """Half of the machine, 16 GB at most."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") >> 30
    return f"{max(2, min(16, total // 2))}g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    catalog.load()
    spark = runtime.session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", memory()),
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
    )
    spark.sparkContext.setLogLevel("OFF")
    run = lambda name: catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run(WARM_UP)
    times: dict[str, float] = {}
    names = list(catalog.QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    for name in names:
        start = time.perf_counter()
        try:
            run(name)
        except Exception as error:
            print(f"{name}: {str(error)[:300]}", file=sys.stderr)
            continue
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
