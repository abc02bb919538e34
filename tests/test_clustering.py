import random

import pytest

from conftest import rows
from quire.operators import clustering as K

VOCAB = ["A", "B", "C"]


def vectors(spark, pts):
    return spark.createDataFrame(pts, "x bigint, y bigint")


def brute_kmeans(points, centers, eta, max_iter):
    """Plain-Python k-means with the same rules (first centre wins ties,
    truncated integer means, empty cluster keeps its centre)."""
    cur = [(x, y) for _, x, y in sorted(centers)]
    it = 0
    while True:
        it += 1
        groups = {i: [] for i in range(len(cur))}
        for p in points:
            best = min(range(len(cur)), key=lambda i: ((p[0] - cur[i][0]) ** 2 + (p[1] - cur[i][1]) ** 2, i))
            groups[best].append(p)
        new = []
        for i, c in enumerate(cur):
            g = groups[i]
            if g:
                sx, sy = sum(p[0] for p in g), sum(p[1] for p in g)
                new.append((int(sx / len(g)), int(sy / len(g))))
            else:
                new.append(c)
        moved = sum((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 for a, b in zip(cur, new))
        cur = new
        if moved < eta or it >= max_iter:
            return cur, it, moved


def test_nearest_tie_goes_to_lower_id(spark):
    pts = K.weighted_points(vectors(spark, [(5, 0)]))
    got = rows(K.kmeans_assign(pts, [(1, 10, 0), (0, 0, 0)]))
    assert got == [(0, 1)]


def test_empty_cluster_keeps_centre(spark):
    pts = K.weighted_points(vectors(spark, [(0, 0), (0, 2), (100, 100), (100, 104)]))
    centers = [(0, 0, 0), (1, 100, 100), (2, 5000, 5000)]
    assert sorted(rows(K.kmeans_step(pts, centers))) == [(0, 0, 1), (1, 100, 102), (2, 5000, 5000)]
    res = K.kmeans(pts, centers, eta=1.0, max_iterations=10, checkpoint=False)
    assert len(res.centers) == 3 and res.centers[2] == (2, 5000, 5000)


def test_kmeans_matches_brute_force(spark):
    rnd = random.Random(7)
    pts = [(rnd.choice([0, 1000, 2000]), rnd.randint(0, 300)) for _ in range(400)]
    centers = [(i, x, y) for i, (x, y) in enumerate([(0, 10), (0, 200), (1000, 50), (1000, 250), (2000, 100)])]
    want, want_it, want_moved = brute_kmeans(pts, centers, 20.0, 120)
    for compact in (True, False):
        res = K.kmeans(K.weighted_points(vectors(spark, pts), compact=compact), centers, 20.0, 120)
        assert [c[1:] for c in res.centers] == want
        assert (res.iterations, res.moved) == (want_it, want_moved)
        assert res.moved < 20.0 or res.iterations == 120


def test_converged_is_strict():
    assert K.converged(19.9, 20.0) and not K.converged(20.0, 20.0)
    assert K.movement([(0, 0), (3, 4)], [(1, 0), (0, 0)]) == 26.0
    with pytest.raises(ValueError):
        K.movement([(0, 0)], [])


def test_kmeans_iteration_cap(spark, capsys):
    pts = K.weighted_points(vectors(spark, [(0, 0), (0, 1000)]))
    res = K.kmeans(pts, [(0, 0, 0)], eta=0.0, max_iterations=3, checkpoint=False, debug=True)
    assert res.iterations == 3 and len(res.trace) == 3
    out = capsys.readouterr().out
    assert "Iteration: 1" in out and "Iteration: 3" in out and "Reached max iterations!" in out
    assert "(0,0) ==>              (0,500)    distance:   250000" in out
    assert [r[0] for r in rows(res.totals_frame(spark))] == [1, 2, 3]


def test_sample_per_tag(spark):
    pts = [(x, y) for x in (0, 100, 200) for y in range(20)] + [(0, 1)] * 5
    s = rows(K.sample_vectors(vectors(spark, pts), n_terms=3, kernels=6, seed=42))
    assert [r[0] for r in s] == list(range(6))
    assert sorted({r[1] for r in s}) == [0, 100, 200]
    assert all(sum(1 for r in s if r[1] == x) == 2 for x in (0, 100, 200))
    assert len({(r[1], r[2]) for r in s}) == 6
    # deterministic
    assert s == rows(K.sample_vectors(vectors(spark, pts), n_terms=3, kernels=6, seed=42))


def test_sample_checks(spark):
    with pytest.raises(ValueError):
        K.sample_vectors(vectors(spark, [(0, 0)]), n_terms=4, kernels=6)
    few = vectors(spark, [(0, 1), (0, 2), (100, 1)])
    with pytest.raises(Exception, match="sample needs"):
        K.sample_vectors(few, n_terms=2, kernels=4).collect()
    too_many_tags = vectors(spark, [(x, y) for x in (0, 100, 200) for y in (1, 2)])
    with pytest.raises(Exception, match="sample needs"):
        K.sample_vectors(too_many_tags, n_terms=2, kernels=4).collect()


def test_global_sample(spark):
    pts = [(x, y) for x in range(5) for y in range(5)] * 2
    s = K.sample_vectors_global(vectors(spark, pts), kernels=7)
    got = rows(s)
    assert len(got) == 7 and len(set(got)) == 7
    numbered = rows(K.number_centers(s, 7))
    assert [r[0] for r in numbered] == list(range(7))
    assert [r[1:] for r in numbered] == sorted(got)


def test_cluster_results_mixed_cluster(spark):
    # one centre; tags A x2, B x1 -> label A, 66.67 %, size 3
    pts = K.weighted_points(vectors(spark, [(0, 4), (0, 8), (100, 6)]))
    got = rows(K.cluster_results(pts, [(0, 50, 5)], VOCAB, 100))
    assert len(got) == 1
    cid, label, percent, size, median = got[0]
    assert (cid, label, size, median) == (0, "A", 3, 6)
    assert percent == pytest.approx(200.0 / 3)


def test_cluster_label_tie_takes_first_tag(spark):
    pts = K.weighted_points(vectors(spark, [(100, 1), (200, 2)]))
    got = rows(K.cluster_results(pts, [(0, 150, 0)], VOCAB, 100))
    assert got[0][1] == "B" and got[0][2] == 50.0


@pytest.mark.parametrize("scores,median", [([5], 5), ([5, 8], 6), ([1, 2, 9], 2), ([3, 4, 1, 10], 3)])
def test_median_rule(spark, scores, median):
    pts = K.weighted_points(vectors(spark, [(0, s) for s in scores]))
    assert rows(K.cluster_results(pts, [(0, 0, 0)], VOCAB, 100), "median") == [(median,)]


def test_results_order_and_report(spark):
    pts = K.weighted_points(vectors(spark, [(0, 100), (0, 101), (1000, 1), (1000, 3)]))
    res = K.cluster_results(pts, [(0, 0, 100), (1, 1000, 2)], VOCAB, 1000)
    assert [r[0] for r in rows(res)] == [1, 0]
    lines = [r[0] for r in rows(K.cluster_report(res))]
    assert lines == ["      2  B                 (100.0%)            2",
                     "    100  A                 (100.0%)            2"]


def test_cluster_without_vocabulary_tag_has_null_label(spark):
    pts = K.weighted_points(vectors(spark, [(500, 3), (500, 5), (0, 7)]))
    got = sorted(rows(K.cluster_results(pts, [(0, 0, 7), (1, 500, 4)], VOCAB, 100)))
    assert got == [(0, "A", 100.0, 1, 7), (1, None, 0.0, 2, 4)]
