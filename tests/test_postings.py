import pytest
from pyspark.sql import functions as F

from conftest import rows
from quire.operators import postings as Po
from quire.sources.lines import POSTING_SCHEMA

VOCAB = ["Scala", "Java", "Python"]


def postings(spark, data):
    return spark.createDataFrame(data, POSTING_SCHEMA)


DATA = [
    (1, 10, None, None, 0, "Scala"),
    (2, 11, None, 10, 5, None),
    (2, 12, None, 10, 9, None),
    (1, 20, None, None, 0, "Java"),
    (2, 21, None, 20, -3, None),
    (2, 22, None, 20, -1, None),     # only negative answers -> high score 0
    (1, 30, None, None, 0, "Cobol"),  # outside the vocabulary
    (2, 31, None, 30, 4, None),
    (1, 40, None, None, 0, None),     # no tag
    (2, 41, None, 40, 1, None),
    (1, 50, None, None, 0, "Scala"),  # unanswered
    (2, 60, None, None, 7, None),     # answer without parent (Q4): dropped
    (2, 61, None, 99, 7, None),       # orphan answer: dropped
    (3, 70, None, 10, 100, None),     # other posting type: ignored
]


def test_grouped_postings_long_form(spark):
    g = Po.grouped_postings(postings(spark, DATA))
    got = sorted(rows(g, "qid", "a_id", "a_score"))
    assert got == [(10, 11, 5), (10, 12, 9), (20, 21, -3), (20, 22, -1), (30, 31, 4), (40, 41, 1)]


def test_scored_postings_floor_and_drops(spark):
    got = sorted(rows(Po.scored_postings(postings(spark, DATA)), "id", "tag", "high_score"))
    assert got == [(10, "Scala", 9), (20, "Java", 0), (30, "Cobol", 4), (40, None, 1)]


def test_duplicate_question_id_scored_once(spark):
    df = postings(spark, [(1, 5, None, None, 0, "Scala"), (1, 5, 9, None, 0, "Java"),
                          (2, 6, None, 5, 3, None), (2, 7, None, 5, 8, None)])
    assert sorted(rows(Po.scored_postings(df), "id", "tag")) == [(5, "Java"), (5, "Scala")]
    once = Po.scored_postings(df, unique_ids=False)
    assert rows(once, "id", "tag", "accepted_answer", "high_score") == [(5, "Scala", None, 8)]
    # the pairs themselves cross-multiply, as the grouping of pairs does
    assert Po.grouped_postings(df).count() == 4


def test_scored_matches_grouped(spark):
    df = postings(spark, DATA)
    g = Po.grouped_postings(df).groupBy("qid").agg({"a_score": "max"}).collect()
    expected = sorted((r[0], max(0, r[1])) for r in g)
    assert sorted(rows(Po.scored_postings(df), "id", "high_score")) == expected


def test_vector_postings(spark):
    scored = Po.scored_postings(postings(spark, DATA))
    got = sorted(rows(Po.vector_postings(scored, VOCAB, 50000)))
    assert got == [(0, 9), (50000, 0)]
    with pytest.raises(ValueError):
        Po.vector_postings(scored, VOCAB, 0)


def test_whole_tag_match_only(spark):
    df = postings(spark, [(1, 1, None, None, 0, "Java Scala"), (2, 2, None, 1, 3, None),
                          (1, 3, None, None, 0, "Java"), (2, 4, None, 3, 2, None)])
    assert rows(Po.vector_postings(Po.scored_postings(df), VOCAB, 10)) == [(10, 2)]


def test_vector_count_check(spark):
    vec = Po.vector_postings(Po.scored_postings(postings(spark, DATA)), VOCAB)
    assert rows(Po.vector_count(vec)) == [(2,)]
    assert rows(Po.vector_count(vec, expected=2)) == [(2,)]
    with pytest.raises(Exception, match="unexpected vector count"):
        Po.vector_count(vec, expected=3).collect()


def test_hot_question_is_split_not_dropped(spark):
    """One question holds a third of all answers. With broadcast off and low
    skew thresholds, AQE marks the sort-merge join skewed and splits the hot
    partition; every pair still comes out, and scoring stays exact."""
    hot = [(2, 1000 + i, None, 1, i % 50, None) for i in range(3000)]
    cold = [(2, 100000 + i, None, 2 + i % 600, 1, None) for i in range(6000)]
    qs = [(1, q, None, None, 0, "Scala") for q in range(1, 602)]
    df = postings(spark, qs + hot + cold).repartition(16)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        g = Po.grouped_postings(df, split_hot=False)
        got = g.collect()
        assert len(got) == 9000 and sum(1 for r in got if r.qid == 1) == 3000
        plan = g._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        scored = dict(rows(Po.scored_postings(df), "id", "high_score"))
        assert scored[1] == 49 and len(scored) == 601
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
