"""Cases that an operator once did only in part."""

import random

import numpy as np

from quire.llm import outliers


def prose(rng, n=120):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def test_copies_of_junk_in_one_group_go(spark):
    rng = random.Random(7)
    junk = " ".join(f"{w}{'#$%&' * 3}" for w in prose(rng).split())
    n = 200
    rows = [(i + n * g, junk if i < share * n else prose(rng), "en", f"source {share}")
            for g, share in enumerate((0.3, 0.4)) for i in range(n)]
    found = outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert kept == {i: text != junk for i, text, _, _ in rows}


def plain_mcd(x, rng):
    """The covariance of the half with the least determinant, over many random
    starts, each concentrated until it stays; with the operator's least variances."""
    h, least = int((len(x) + 5) * outliers.COVERED), np.diag(np.square(outliers.LEAST_SD))
    best = None
    for _ in range(100):
        own = rng.choice(len(x), 5, replace=False)
        for _ in range(50):
            mean = x[own].mean(axis=0)
            cov = outliers.consistency() * np.cov(x[own].T, bias=True) + least
            d2 = np.einsum("ij,ij->i", (x - mean) @ np.linalg.inv(cov), x - mean)
            nearest = np.argsort(d2, kind="stable")[:h]
            if set(nearest) == set(own):
                break
            own = nearest
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = det, d2
    return best[1]


def test_verdicts_equal_a_plain_mcd(spark):
    rng, rows = random.Random(11), []
    for g in range(2):
        for i in range(160):
            words = prose(rng, rng.randint(60, 200)).split()
            if i % 9 == 0:  # junk of several kinds
                words = [w + "#" * (i % 5 + 1) for w in words] if i % 2 else ["x" * 40 + w for w in words]
            text = "\n".join(" ".join(words[k:k + 12]) for k in range(0, len(words), 12))
            rows.append((1000 * g + i, text + "\nthe same line again\n" * (i % 7 == 0), "en", f"s{g}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in outliers.quality(docs).collect()}
    found = [tuple(r) for r in outliers.vectors(outliers.statistics(docs)).select("doc_id", "source", "base_failed", *outliers.VECTOR).collect()]
    judged = 0
    for source in ("s0", "s1"):
        group = [r for r in found if r[1] == source and not r[2]]
        d2 = plain_mcd(np.array([r[3:] for r in group], float), np.random.default_rng(1))
        clear = [(r[0], d) for r, d in zip(group, d2) if not 0.7 < d / outliers.CUTOFF < 1.4]  # beyond the bins' width
        judged += len(clear)
        assert {i: kept[i] for i, _ in clear} == {i: d <= outliers.CUTOFF for i, d in clear}
    assert judged > 300 and 20 < sum(not k for k in kept.values()) < 60
