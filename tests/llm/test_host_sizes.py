"""A host's boilerplate goes by the same counts on hosts of any size."""

import collections

import pytest

from quire.llm import webtext


def own(i):
    return " ".join(f"w{i}x{k}" for k in range(20))


def notice(j):
    return " ".join(f"n{j}y{k}" for k in range(10))


@pytest.mark.parametrize("n", [256, 257, 300, 600, 601, 800, 2100])
def test_notices_go_by_their_pages_on_the_whole_host(spark, n):
    """Notice j stands on some j // 10 + 1 pages, spread over the host."""
    on = collections.defaultdict(list)
    for j in range(140):
        for k in range(j // 10 + 1):
            on[(37 * j + 53 * k) % n].append(j)
    assert sum(map(len, on.values())) == 10 * sum(range(1, 15))
    needed = max(3, -(-n // 200))
    rows = [(i, "http://h.example/x", "".join(f"<div>{t}</div>" for t in [own(i), *map(notice, on[i])])) for i in range(n)]
    found = webtext.extract(spark.createDataFrame(rows * 2, "page_id long, url string, html string")).collect()
    want = {i: " ".join([own(i), *(notice(j) for j in on[i] if j // 10 + 1 < needed)]) for i in range(n)}
    # a page that nearly consists of notices is a copy of others and keeps them
    plain = [i for i in range(n) if 10 * len(on[i]) <= 100]
    assert len(plain) > 250
    assert len(found) == 2 * n
    texts = {r["page_id"]: r["text"] for r in found}
    assert {i: texts[i] for i in plain} == {i: want[i] for i in plain}
