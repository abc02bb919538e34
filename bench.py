"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and fully executed once to warm up, then timed
BENCH_RUNS times (default 3); the median is reported. DataFrame queries run
into Spark's `noop` sink: the whole plan executes, but rows are not shipped
to Python (as on a cluster, where results are written, not collected). The
k-means entries run the loop to convergence. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quire.operators import articles  # noqa: E402
from quire.plans import catalogue  # noqa: E402
from quire.plans import params as P  # noqa: E402
from quire.session import local_session  # noqa: E402
from quire.sources import tables  # noqa: E402


def _collect(df):
    df.write.format("noop").mode("overwrite").save()


def _kmeans(spark, sf_dir, compact):
    _, result = catalogue.run_kmeans(spark, sf_dir, P.SPREAD, compact=compact)
    return result.centers


def headline(spark, sf_dir):
    art = lambda: tables.articles_view(spark, sf_dir)
    return {
        "rank_terms": lambda: _collect(articles.rank_terms(art(), P.ARTICLE_VOCAB)),
        "rank_terms_agg": lambda: _collect(articles.rank_terms_agg(art(), P.ARTICLE_VOCAB)),
        "rank_terms_using_index": lambda: _collect(
            articles.rank_terms_using_index(articles.inverted_index(art(), P.ARTICLE_VOCAB), P.ARTICLE_VOCAB)),
        "inverted_index_arrays": lambda: _collect(catalogue.inverted_index_arrays(spark, sf_dir)),
        "inverted_index": lambda: _collect(catalogue.inverted_index(spark, sf_dir)),
        "rank_terms_from_lines": lambda: _collect(catalogue.rank_terms_from_lines(spark, sf_dir)),
        "scored_postings_from_lines": lambda: _collect(catalogue.scored_postings_from_lines(spark, sf_dir)),
        "grouped_postings": lambda: _collect(catalogue.grouped_postings(spark, sf_dir)),
        "grouped_posting_blocks": lambda: _collect(catalogue.grouped_posting_blocks(spark, sf_dir)),
        "scored_postings": lambda: _collect(catalogue.scored_postings(spark, sf_dir)),
        "kmeans": lambda: _kmeans(spark, sf_dir, compact=True),
        "kmeans_uncompacted": lambda: _kmeans(spark, sf_dir, compact=False),
        "kmeans_45": lambda: catalogue.run_kmeans_45(spark, sf_dir).centers,
        "kmeans_assign_many": lambda: _collect(catalogue.kmeans_assign_many(spark, sf_dir)),
        "weighted_medians": lambda: _collect(catalogue.weighted_medians(spark, sf_dir)),
        "rank_terms_vocab_table": lambda: _collect(catalogue.rank_terms_vocab_table(spark, sf_dir)),
        "stored_index_rank": lambda: _collect(catalogue.stored_index_rank(spark, sf_dir)),
        "cluster_results": lambda: _collect(catalogue.cluster_results(spark, sf_dir)),
        "time_usage_grouped": lambda: _collect(catalogue.time_usage_grouped(spark, sf_dir)),
        "time_usage_grouped_sql": lambda: _collect(catalogue.time_usage_grouped_sql(spark, sf_dir)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, app="quire-bench")
    times: dict[str, float] = {}
    for name, fn in headline(spark, sf_dir).items():
        if only and name not in only:
            continue
        fn()  # warm-up: JIT, file listing, page cache
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
