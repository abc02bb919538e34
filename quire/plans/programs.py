"""The three end-to-end programs, composed from the operators: rank terms
over an article file, cluster question/answer postings, and summarise a
wide survey file. Each reads its own input file and prints its report."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from quire.operators import articles, clustering, postings, timeuse
from quire.sources import csv as csv_source
from quire.sources import lines

T = TypeVar("T")

# The default vocabulary of the article and posting programs,
# in tie-break order.
LANGUAGES = ["JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
             "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy"]


# The timing line and the phase labels of the ranking program.
TIMING_LINE = "{label}: {ms} ms"
PHASES = ["ranking in one scan", "ranking from the index", "ranking by term counts"]


class Timings:
    """Phase timer: `timed(label, fn)` runs fn and records its wall time."""

    def __init__(self) -> None:
        self.lines: list[str] = []

    def timed(self, label: str, fn: Callable[[], T]) -> T:
        start = time.perf_counter()
        result = fn()
        self.lines.append(TIMING_LINE.format(label=label, ms=int((time.perf_counter() - start) * 1000)))
        return result

    def __str__(self) -> str:
        return "\n".join(self.lines)


def rank_articles(spark: SparkSession, path: str, vocab: Sequence[str] = LANGUAGES) -> dict:
    """Three rankings of the terms over an article-line file, each timed.

    The file is read and parsed once: what is cached for the three passes is a
    bit per vocabulary term and article, not the texts (and it is recomputed
    from the file if an executor is lost)."""
    bits = articles.term_bitmaps(lines.read_articles(spark, path), vocab).select("bits").cache()
    t = Timings()
    try:
        naive = t.timed(PHASES[0], lambda: articles.rank_bitmaps(bits, vocab).collect())
        index = articles.index_bitmaps(bits, vocab)
        by_index = t.timed(PHASES[1], lambda: articles.rank_terms_using_index(index, vocab).collect())
        by_key = t.timed(PHASES[2], lambda: articles.rank_bitmaps_agg(bits, vocab).collect())
    finally:
        bits.unpersist()
    return {"naive": [tuple(r) for r in naive], "index": [tuple(r) for r in by_index],
            "by_key": [tuple(r) for r in by_key], "timing": str(t)}


def cluster_postings(spark: SparkSession, path: str, vocab: Sequence[str] = LANGUAGES,
                     spread: int = 50_000, kernels: int = 45, eta: float = 20.0,
                     max_iterations: int = 120, expected_vectors: int | None = None,
                     debug: bool = True, resume: str | None = None) -> DataFrame:
    """Postings file -> scored vectors -> sampled centres -> k-means ->
    cluster summary (printed). Returns the summary frame.

    The vectors are computed once, as the materialised weighted points; their
    number is checked on those. With `resume`, a folder of the shared store,
    the points and each round's centres are kept there and a later call goes
    on from them."""
    def build() -> DataFrame:
        raw = lines.read_postings(spark, path)
        return clustering.weighted_points(
            postings.vector_postings(postings.scored_postings(raw), vocab, spread))

    saved = clustering.SavedRun(spark, resume) if resume else None
    points = saved.points(build) if saved else clustering.materialize(build())
    clustering.expect_vectors(points, expected_vectors)
    centers = clustering.collect_centers(clustering.initial_centers(points, vocab, spread, kernels))
    result = clustering.kmeans(points, centers, eta, max_iterations, checkpoint=False, debug=debug, saved=saved)
    summary = clustering.cluster_results(points, result.centers, vocab, spread)
    clustering.print_results(summary)
    return summary


def summarise_time_use(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Wide survey CSV -> grouped mean hours per (working, sex, age), shown.

    The schema is made from the header line (first column text, the others
    numbers), so the file is read once; with `infer` Spark infers the types
    in a pass of its own."""
    schema = None if infer else csv_source.row_schema(csv_source.header(spark, path))
    _, df = csv_source.read_csv(spark, path, schema)
    grouped = timeuse.time_usage_grouped(timeuse.time_usage_summary(df))
    grouped.show()
    return grouped
