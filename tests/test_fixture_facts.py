"""Golden values recorded for the shared tables at sf0.01 (from an
independent DuckDB run of the fixture views)."""

import pytest

from quire.plans import catalogue

SF = "/root/testdata/sf0.01"


def test_term_counts(spark):
    got = [tuple(r) for r in catalogue.rank_terms(spark, SF).collect()]
    assert got == [("the", 559), ("in", 559), ("and", 525), ("to", 514), ("of", 503), ("a", 470),
                   ("is", 460), ("that", 428), ("la", 225), ("que", 176), ("le", 127), ("der", 116),
                   ("die", 114), ("und", 106), ("zzqx", 0)]


def test_first_grouped_row(spark):
    assert tuple(catalogue.time_usage_grouped(spark, SF).first()) == (
        "not working", "female", "active", 5.1, 2.6, 8.1)


def test_vector_count(spark):
    assert catalogue.vector_count(spark, SF).first()[0] == 10605


@pytest.mark.parametrize("spread,rounds,moved", [(50000, 15, 19.0), (100, 10, 13.0)])
def test_kmeans_convergence(spark, spread, rounds, moved):
    _, res = catalogue.run_kmeans(spark, SF, spread)
    assert (res.iterations, res.moved, len(res.centers)) == (rounds, moved, 12)
