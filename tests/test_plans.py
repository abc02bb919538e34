"""Plan-shape checks: the scale properties the operators are built for."""

import pytest

from quire.operators import articles, clustering
from quire.plans import catalogue
from quire.plans import params as P
from quire.sources import tables

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = ["parse_articles", "mentions_filter", "occurrences_of_term", "rank_terms", "rank_terms_agg",
        "inverted_index", "rank_terms_using_index", "top_term", "parse_postings", "grouped_postings",
        "scored_postings", "vector_postings", "vector_count", "distinct_vectors", "sample_vectors",
        "sample_vectors_global", "classify_columns", "typed_rows", "time_usage_summary",
        "time_usage_typed", "time_usage_grouped", "time_usage_grouped_sql", "time_usage_grouped_typed",
        "inverted_index_arrays", "rank_terms_from_lines", "scored_postings_from_lines"]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_plan(spark, name):
    plan = executed(catalogue.QUERIES[name](spark, SF))
    assert not any(node in plan for node in PYTHON_NODES), plan


def test_ranking_reads_only_text(spark):
    plan = executed(catalogue.rank_terms(spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("ReadSchema: struct<text:string>" in line for line in scans)


def test_labour_force_filter_reaches_orders_scan(spark):
    plan = executed(catalogue.time_usage_grouped(spark, SF))
    orders_scan = [line for line in plan.splitlines() if "FileScan" in line and "orders.parquet" in line]
    assert orders_scan and "<= 4" in orders_scan[0]


def test_answers_reduced_before_join(spark):
    plan = executed(catalogue.scored_postings(spark, SF))
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_max" in line for line in lines[join:])


def test_sampler_limits_before_shuffle(spark):
    plan = executed(catalogue.sample_vectors(spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_posting_blocks_scan_text_once(spark):
    idx = articles.inverted_index(tables.articles_view(spark, SF), P.ARTICLE_VOCAB)
    blocks = articles.inverted_index_blocks(idx, P.ARTICLE_VOCAB, 50)
    assert "FileScan" not in executed(blocks)  # everything after the checkpoint reads it


def test_rounds_keep_the_points_partitions(spark):
    # no size at which the rounds move to one task
    points = spark.range(0, 4000, 1, 4).selectExpr("id % 7 x", "id y", "1L w")
    points = clustering.materialize(points)
    assert points.rdd.getNumPartitions() == 4
    plan = executed(clustering._centroids(points, [(0, 0, 0), (1, 5, 900)]))
    assert "Coalesce" not in plan and "*(" in plan  # whole-stage codegen


def test_small_frames_are_literals_of_the_plan(spark):
    points = clustering.materialize(spark.createDataFrame([(0, 1, 2)], "x long, y long, w long"))
    plan = executed(clustering.kmeans_step(points, [(0, 0, 1), (1, 0, 5)]))
    assert plan.split("Initial Plan")[-1].count("Scan ExistingRDD") == 1  # the points only


def test_kmeans_rounds_read_the_checkpoint_only(spark):
    vec = catalogue.vectors(spark, SF)
    points = clustering.materialize(clustering.weighted_points(vec))
    centers = clustering.collect_centers(clustering.sample_vectors(points, len(P.POSTING_VOCAB), P.KERNELS))
    for df in (clustering._centroids(points, centers),
               clustering.cluster_results(points, centers, P.POSTING_VOCAB, P.SPREAD)):
        assert "FileScan" not in executed(df)  # lineage cut: the base tables are not read again


def test_bucketed_inputs_make_the_wide_view_shuffle_free(spark, tmp_path):
    from quire.operators import timeuse
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            (tables.table(spark, SF, name).write.bucketBy(8, key).mode("overwrite")
             .option("path", str(tmp_path / name)).saveAsTable(f"quire_test_{name}_b"))
        wide = tables.wide_from(spark.table("quire_test_orders_b"), spark.table("quire_test_lineitem_b"))
        plan = executed(wide)
        assert "Exchange" not in plan, plan
        # the bucketed input gives the same summary as the plain one
        got = sorted(tuple(r) for r in timeuse.time_usage_grouped(timeuse.time_usage_summary(wide)).collect())
        want = sorted(tuple(r) for r in catalogue.time_usage_grouped(spark, SF).collect())
        assert got == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("orders", "lineitem"):
            spark.sql(f"DROP TABLE IF EXISTS quire_test_{name}_b")


def test_bucketed_inputs_make_scoring_shuffle_free(spark, tmp_path):
    from quire.operators import postings
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            (tables.table(spark, SF, name).write.bucketBy(8, key).mode("overwrite")
             .option("path", str(tmp_path / name)).saveAsTable(f"quire_test_{name}_p"))
        posts = tables.postings_from(spark.table("quire_test_orders_p"), spark.table("quire_test_lineitem_p"))
        scored = postings.scored_postings(posts).select("id", "tag", "high_score")
        assert "Exchange" not in executed(scored)
        want = sorted(tuple(r) for r in catalogue.scored_postings(spark, SF).collect())
        assert sorted(tuple(r) for r in scored.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("orders", "lineitem"):
            spark.sql(f"DROP TABLE IF EXISTS quire_test_{name}_p")
