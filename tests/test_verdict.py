"""Checks hold whatever columns are read; nearest centre at any k."""

import random

import pytest

from quire.functions import nearest_center
from quire.functions.geometry import UNROLLED
from quire.operators import articles, clustering, postings
from quire.sources.lines import parse_articles, parse_postings

GOOD_LINE = "12345678901234A</title><text>Java Scala1234567890123456"


@pytest.mark.parametrize("read", [
    lambda d: d.select("title").collect(), lambda d: d.select("text").collect(), lambda d: d.count(),
    lambda d: articles.rank_terms(d, ["Java", "Scala"]).collect(),
    lambda d: articles.occurrences_of_term(d, "Java").collect()])
def test_malformed_article_fails_whatever_is_read(spark, read):
    lines = spark.createDataFrame([(GOOD_LINE,), ("malformed Java",)], "value string")
    with pytest.raises(Exception, match="malformed article line"):
        read(parse_articles(lines))


@pytest.mark.parametrize("column", ["posting_type", "id", "accepted_answer", "parent_id", "score", "tag", None])
def test_malformed_posting_fails_whatever_is_read(spark, column):
    posts = parse_postings(spark.createDataFrame([("1,7,,,5,Java",), ("1,x,,,5,",)], "value string"))
    with pytest.raises(Exception, match="malformed posting line"):
        posts.select(column).collect() if column else posts.count()


def test_invalid_sample_fails_whatever_is_read(spark):
    vectors = spark.createDataFrame([(0, 1), (0, 2), (50000, 1)], "x long, y long")
    with pytest.raises(Exception, match="sample needs"):
        clustering.sample_vectors(vectors, 2, kernels=4).select("x", "y").collect()


@pytest.mark.parametrize("k", [1, 2, 45, UNROLLED, UNROLLED + 1, 200])
def test_nearest_center_at_any_k(spark, k):
    rng = random.Random(k)
    centers = [(i * 3, rng.randrange(20), rng.randrange(20)) for i in range(k)]
    points = [(x, y) for x in range(20) for y in range(20)]
    found = spark.createDataFrame(points, "x long, y long").select("x", "y", nearest_center("x", "y", centers).alias("c"))
    for x, y, c in found.collect():
        assert c == min(centers, key=lambda z: ((x - z[1]) ** 2 + (y - z[2]) ** 2, z[0]))[0]


def test_one_term_vocabulary(spark):
    points = spark.createDataFrame([(0, 1, 2), (0, 5, 1)], "x long, y long, w long")
    found = clustering.cluster_results(points, [(0, 0, 1), (1, 0, 5)], ["only"], 50_000).collect()
    assert sorted((r["label"], r["percent"], r["size"]) for r in found) == [("only", 100.0, 1), ("only", 100.0, 2)]


def test_index_blocks_keep_copies(spark):
    index = spark.createDataFrame([("java", "a"), ("java", "a"), ("java", "b")], "term string, title string")
    (row,) = articles.inverted_index_blocks(index, ["java"]).collect()
    assert (row["n"], row["titles"], row["n_titles"]) == (3, ["a", "a", "b"], 2)


def test_index_blocks_of_a_title_with_many_copies(spark):
    index = spark.range(5000).selectExpr("'java' term", "if(id < 4000, 'a', concat('t', id)) title")
    found = articles.inverted_index_blocks(index, ["java"], 100).collect()
    assert all(r["n"] == len(r["titles"]) <= 200 for r in found)
    assert max(r["block"] for r in found) == 49 and {r["n_titles"] for r in found} == {1001}
    titles = sorted(t for r in found for t in r["titles"])
    assert titles == sorted(["a"] * 4000 + [f"t{i}" for i in range(4000, 5000)])


def test_index_blocks_past_the_old_grid(spark):
    # one posting a block: 2^20 blocks were the most before, and neighbours fell together
    index = spark.range(1 << 21).selectExpr("'java' term", "cast(id as string) title")
    blocks = articles.inverted_index_blocks(index, ["java"], 1)
    top = blocks.selectExpr("max(n) most", "max(block) last", "sum(n) n").first()
    assert top["n"] == 1 << 21 and top["most"] <= 16 and (1 << 20) < top["last"] < (1 << 21)


def test_index_blocks_keep_null_titles(spark):
    index = spark.createDataFrame([("java", None), ("java", None), ("java", "b")], "term string, title string")
    (row,) = articles.inverted_index_blocks(index, ["java"]).collect()
    assert (row["n"], len(row["titles"]), row["n_titles"]) == (3, 3, 2)


def test_answer_blocks_of_a_hot_question(spark):
    posts = spark.range(2100).selectExpr(
        "int(if(id < 2, 1, 2)) posting_type", "if(id >= 2000, 2000, id) id", "cast(null as bigint) accepted_answer",
        "if(id < 2, null, if(id < 2090, 0, 7)) parent_id", "int(id % 5) * 0 score", "'Java' tag")
    found = postings.grouped_posting_blocks(posts, 50).collect()
    assert {(r["qid"], r["n_answers"]) for r in found} == {(0, 2088)}  # 1 is unanswered, 7 is no question
    assert all(r["n"] == len(r["answers"]) <= 150 for r in found) and len(found) > 30
    got = sorted((a["id"], a["score"]) for r in found for a in r["answers"])
    assert got == sorted((min(i, 2000), 0) for i in range(2, 2090))
