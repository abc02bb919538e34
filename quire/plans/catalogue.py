"""Named query plans over the shared tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import articles, clustering, postings, timeuse
from quire.plans import params as P
from quire.session import scratch_folder
from quire.sources import bucketed, index_store, lines, tables
from quire.sources import csv as csv_source

Plan = Callable[[SparkSession, str], DataFrame]


# --- time use -------------------------------------------------------------

def classify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.column_groups(tables.wide_view(spark, sf_dir))


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = tables.wide_view(spark, sf_dir)
    raw = wide.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in wide.columns])  # fields as text
    return csv_source.typed_rows(raw)


def time_usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.time_usage_summary(tables.wide_view(spark, sf_dir))


def time_usage_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.time_usage_summary_typed(time_usage_summary(spark, sf_dir))


def time_usage_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.time_usage_grouped(time_usage_summary(spark, sf_dir))


def time_usage_grouped_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.time_usage_grouped_sql(time_usage_summary(spark, sf_dir))


def time_usage_grouped_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.time_usage_grouped_typed(time_usage_typed(spark, sf_dir))


def time_usage_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey written as CSV files, read back with inferred types, summarised."""
    path = scratch_folder(spark, "survey")
    tables.wide_view(spark, sf_dir).write.option("header", "true").csv(path)
    _, survey = csv_source.read_csv(spark, path)
    return timeuse.time_usage_grouped(timeuse.time_usage_summary(survey))


# --- articles -------------------------------------------------------------

def parse_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_articles(tables.article_lines_view(spark, sf_dir), line_col="line")


def mentions_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.mentions_filter(tables.articles_view(spark, sf_dir), P.MENTION_TERM).select("title")


def occurrences_of_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.occurrences_of_term(tables.articles_view(spark, sf_dir), P.MENTION_TERM)


def rank_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.rank_terms(tables.articles_view(spark, sf_dir), P.ARTICLE_VOCAB)


def rank_terms_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.rank_terms_agg(tables.articles_view(spark, sf_dir), P.ARTICLE_VOCAB)


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.inverted_index(tables.articles_view(spark, sf_dir), P.ARTICLE_VOCAB)


def inverted_index_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = articles.inverted_index_blocks(inverted_index(spark, sf_dir), P.ARTICLE_VOCAB, P.INDEX_BLOCK_SIZE)
    return blocks.select("term", "block", "n", F.array_join("titles", ",").alias("titles"))


def rank_terms_using_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.rank_terms_using_index(inverted_index(spark, sf_dir), P.ARTICLE_VOCAB)


def top_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.top_term(rank_terms(spark, sf_dir), P.ARTICLE_VOCAB)


def rank_terms_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking from a bit per term and article."""
    bits = articles.term_bitmaps(tables.articles_view(spark, sf_dir), P.ARTICLE_VOCAB)
    return articles.rank_bitmaps(bits, P.ARTICLE_VOCAB)


def index_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = articles.term_bitmaps(tables.articles_view(spark, sf_dir), P.ARTICLE_VOCAB)
    return articles.index_bitmaps(bits, P.ARTICLE_VOCAB)


def rank_terms_vocab_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking over a vocabulary table: every token of the corpus."""
    arts = tables.articles_view(spark, sf_dir)
    words = arts.select(F.explode(F.split("text", " ")).alias("term")).where("term <> ''").distinct()
    vocab = words.select(F.xxhash64("term").alias("idx"), "term")
    return articles.rank_terms_agg(arts, vocab)


def _stored_index(spark: SparkSession, sf_dir: str) -> index_store.StoredIndex:
    path = scratch_folder(spark, "index")
    index_store.write_index(tables.articles_view(spark, sf_dir), path, block_size=P.STORED_BLOCK_SIZE)
    return index_store.StoredIndex(spark, path)


def stored_index_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking from an index of all tokens, written and read back."""
    return _stored_index(spark, sf_dir).rank(P.ARTICLE_VOCAB)


def stored_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_index(spark, sf_dir).lookup(P.STORED_TERMS)


def rank_terms_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup lines parsed into articles, then ranked."""
    return articles.rank_terms(parse_articles(spark, sf_dir), P.ARTICLE_VOCAB)


# --- postings -------------------------------------------------------------

def parse_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_postings(tables.posting_lines_view(spark, sf_dir), line_col="line")


def grouped_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = postings.grouped_postings(tables.postings_view(spark, sf_dir))
    return g.select("qid", F.col("q_tag").alias("tag"), F.col("a_id").alias("answer_id"),
                    F.col("a_score").alias("score"))


def scored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.scored_postings(tables.postings_view(spark, sf_dir)).select("id", "tag", "high_score")


def scored_postings_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting lines parsed, then scored."""
    return postings.scored_postings(parse_postings(spark, sf_dir)).select("id", "tag", "high_score")


def grouped_posting_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = postings.grouped_posting_blocks(tables.postings_view(spark, sf_dir), P.ANSWER_BLOCK_SIZE)
    pairs = F.transform("answers", lambda a: F.concat_ws(":", a["id"], a["score"]))
    return blocks.select("qid", "block", "n", "n_answers", F.array_join(pairs, ",").alias("answers"))


def vectors(spark: SparkSession, sf_dir: str, spread: int = P.SPREAD, vocab: list[str] = P.POSTING_VOCAB) -> DataFrame:
    scored = postings.scored_postings(tables.postings_view(spark, sf_dir))
    return postings.vector_postings(scored, vocab, spread)


def scored_postings_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings written by explicit partitioning and scored without a shuffle."""
    path = scratch_folder(spark, "postings")
    name = "quire_" + path.rsplit("-", 1)[-1]
    bucketed.write_postings(tables.postings_view(spark, sf_dir), name, P.BUCKETS, path)
    posts = bucketed.read_postings_tables(spark, name)
    return bucketed.shuffle_free(postings.scored_postings(posts).select("id", "tag", "high_score"))


def weighted_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median price in cents of each supplier's line items, by quantity."""
    lines_ = tables.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("quantity"))
    return clustering.group_medians(lines_, "l_suppkey", "cents", "quantity")


def vector_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.vector_count(vectors(spark, sf_dir))


def distinct_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.distinct_vectors(vectors(spark, sf_dir))


# --- clustering -----------------------------------------------------------

def sample_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.sample_vectors(vectors(spark, sf_dir), len(P.POSTING_VOCAB), P.KERNELS, P.SEED)


def sample_vectors_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.sample_vectors_global(vectors(spark, sf_dir), P.KERNELS, P.SEED)


def _points_and_centers(spark: SparkSession, sf_dir: str, spread: int = P.SPREAD, compact: bool = True):
    """Weighted points, materialised once, and the initial centres sampled
    from them; the base tables are scanned once."""
    points = clustering.materialize(clustering.weighted_points(vectors(spark, sf_dir, spread), compact=compact))
    centers = clustering.collect_centers(
        clustering.initial_centers(points, P.POSTING_VOCAB, spread, P.KERNELS, P.SEED))
    return points, centers


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.kmeans_assign(*_points_and_centers(spark, sf_dir))


def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.kmeans_step(*_points_and_centers(spark, sf_dir))


def run_kmeans(spark: SparkSession, sf_dir: str, spread: int = P.SPREAD, compact: bool = True):
    """Weighted points and the finished k-means run for `spread`.

    The points are materialised once; the initial sample, every round and
    the later cluster summary all read that checkpoint."""
    points, centers = _points_and_centers(spark, sf_dir, spread, compact)
    result = clustering.kmeans(points, centers, P.ETA, P.MAX_ITERATIONS, checkpoint=False)
    return points, result


def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_kmeans(spark, sf_dir)[1].centers_frame(spark)


def kmeans_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_kmeans(spark, sf_dir)[1].totals_frame(spark)


def kmeans_uncompacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same centres as `kmeans`, every vector with weight 1 (checks that
    compaction is exact)."""
    return run_kmeans(spark, sf_dir, compact=False)[1].centers_frame(spark)


def kmeans_trace_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_kmeans(spark, sf_dir)[1].trace_frame(spark)


def _pair_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = postings.scored_postings(tables.pair_postings_view(spark, sf_dir))
    return clustering.materialize(clustering.weighted_points(
        postings.vector_postings(scored, P.PAIR_TAGS, P.SPREAD)))


def _kmeans_15_tags(spark: SparkSession, sf_dir: str):
    points = _pair_points(spark, sf_dir)
    centers = clustering.collect_centers(
        clustering.initial_centers(points, P.PAIR_TAGS, P.SPREAD, P.PAIR_KERNELS, P.SEED))
    return points, clustering.kmeans(points, centers, P.ETA, P.MAX_ITERATIONS, checkpoint=False)


def kmeans_15_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-means at the posting program's own size: three centres for each of 15 tags."""
    return _kmeans_15_tags(spark, sf_dir)[1].centers_frame(spark)


def cluster_results_15_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, result = _kmeans_15_tags(spark, sf_dir)
    return clustering.cluster_results(points, result.centers, P.PAIR_TAGS, P.SPREAD)


def kmeans_assign_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of many centres, by bands."""
    points = clustering.materialize(clustering.weighted_points(vectors(spark, sf_dir, vocab=P.ALL_TAGS)))
    sample = clustering.sample_vectors_global(points, P.MANY_KERNELS, P.SEED)
    return clustering.kmeans_assign(points, clustering.collect_centers(
        clustering.number_centers(sample, P.MANY_KERNELS)))


def run_kmeans_45(spark: SparkSession, sf_dir: str):
    """K-means at the posting program's own size, over all tags."""
    points = clustering.materialize(clustering.weighted_points(vectors(spark, sf_dir, vocab=P.ALL_TAGS)))
    centers = clustering.collect_centers(
        clustering.initial_centers(points, P.ALL_TAGS, P.SPREAD, P.ALL_KERNELS, P.SEED))
    return clustering.kmeans(points, centers, P.ETA, P.MAX_ITERATIONS, checkpoint=False)


def kmeans_45(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_kmeans_45(spark, sf_dir).centers_frame(spark)


def kmeans_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_kmeans(spark, sf_dir, P.MIXED_SPREAD)[1].centers_frame(spark)


def _cluster_results(spark: SparkSession, sf_dir: str, spread: int) -> DataFrame:
    points, result = run_kmeans(spark, sf_dir, spread)
    return clustering.cluster_results(points, result.centers, P.POSTING_VOCAB, spread)


def cluster_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cluster_results(spark, sf_dir, P.SPREAD)


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_report(cluster_results(spark, sf_dir))


def cluster_results_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cluster_results(spark, sf_dir, P.MIXED_SPREAD)


QUERIES: dict[str, Plan] = {
    "parse_articles": parse_articles,
    "mentions_filter": mentions_filter,
    "occurrences_of_term": occurrences_of_term,
    "rank_terms": rank_terms,
    "rank_terms_agg": rank_terms_agg,
    "inverted_index": inverted_index,
    "inverted_index_arrays": inverted_index_arrays,
    "rank_terms_using_index": rank_terms_using_index,
    "top_term": top_term,
    "rank_terms_from_lines": rank_terms_from_lines,
    "rank_terms_bitmaps": rank_terms_bitmaps,
    "index_bitmaps": index_bitmaps,
    "rank_terms_vocab_table": rank_terms_vocab_table,
    "stored_index_rank": stored_index_rank,
    "stored_index_lookup": stored_index_lookup,
    "parse_postings": parse_postings,
    "grouped_postings": grouped_postings,
    "grouped_posting_blocks": grouped_posting_blocks,
    "scored_postings": scored_postings,
    "scored_postings_from_lines": scored_postings_from_lines,
    "scored_postings_bucketed": scored_postings_bucketed,
    "weighted_medians": weighted_medians,
    "vector_postings": vectors,
    "vector_count": vector_count,
    "distinct_vectors": distinct_vectors,
    "sample_vectors": sample_vectors,
    "sample_vectors_global": sample_vectors_global,
    "kmeans_assign": kmeans_assign,
    "kmeans_step": kmeans_step,
    "kmeans": kmeans,
    "kmeans_trace": kmeans_trace,
    "kmeans_uncompacted": kmeans_uncompacted,
    "kmeans_trace_centers": kmeans_trace_centers,
    "kmeans_mixed": kmeans_mixed,
    "kmeans_45": kmeans_45,
    "kmeans_15_tags": kmeans_15_tags,
    "cluster_results_15_tags": cluster_results_15_tags,
    "kmeans_assign_many": kmeans_assign_many,
    "cluster_results": cluster_results,
    "cluster_report": cluster_report,
    "cluster_results_mixed": cluster_results_mixed,
    "classify_columns": classify_columns,
    "typed_rows": typed_rows,
    "time_usage_summary": time_usage_summary,
    "time_usage_typed": time_usage_typed,
    "time_usage_grouped": time_usage_grouped,
    "time_usage_grouped_sql": time_usage_grouped_sql,
    "time_usage_grouped_typed": time_usage_grouped_typed,
    "time_usage_from_csv": time_usage_from_csv,
}
