"""Pages that once crashed, stalled or lost text."""

import time

import numpy as np
import pytest

from quire.llm import webtext

SCHEMA = "page_id long, url string, html string"


def article(page):
    return " ".join(t for z, t in webtext.blocks(page) if z == webtext.ARTICLE)


@pytest.mark.parametrize("page, want", [
    ('<article title="The hidden valley">kept</article>', "kept"),
    ('<article aria-label="Hidden gems" data-x="class=ad">kept</article>', "kept"),
    ('<article><p class="share-price">a</p><section class="search-engines">b</section></article>', "a b"),
    ('<article class="related-works">kept</article>', "kept"),
    ('<article><p class="notices-of-birds">a</p><div class="cookie-notice">out</div>b</article>', "a b"),
    ('<article>a<div hidden>out</div><div HIDDEN="">out</div><p aria-hidden=TRUE>out</p>b</article>', "a b"),
    ('<article>a<div class="comments">out</div><div id=userComments>out</div><div class=\'ad-container\'>out</div>b</article>', "a b"),
    ('<article class="comment">out</article><article>kept</article>', "kept"),
    ('<article class=x class=comment>kept</article>', "kept"),
])
def test_attributes_decide_as_a_whole(page, want):
    assert article(page) == want


@pytest.mark.parametrize("piece", ["<div>", "<span>", "</x>", "<p>", "<li>", "<b></i>", "<a href='", '<a "', "<!--", "<", "&", "<table><tr><td>"])
def test_hostile_nesting_takes_linear_time(piece):
    page = "<div>" * 20_000 + piece * (1_000_000 // len(piece)) + "<p>end</p>"
    began = time.process_time()
    webtext.blocks(page)
    assert time.process_time() - began < 60  # a quadratic walk takes hours


def test_small_shards():
    none, one, two = (np.arange(n, dtype=np.uint64) + np.uint64(1) for n in (0, 1, 2))
    for pages in ([none, none], [none, one], [one, one], [none, none, none, two], [two, one]):
        hashes, n = webtext.repeats(pages)
        assert len(hashes) == len(n) == 0


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in webtext.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def own(i, n=20):
    return " ".join(f"w{i}x{k}" for k in range(n))


NOTICE = "this site tells you about its rules again and again"


def test_declared_articles_keep_what_they_share(spark):
    rows = [(i, "http://h.example/x", f"<article><p>{NOTICE}</p><p>{own(i)}</p></article>") for i in range(30)]
    assert texts(spark, rows) == {i: f"{NOTICE} {own(i)}" for i in range(30)}


def test_boilerplate_of_a_section_of_a_large_host_goes(spark):
    rows = [(i, "http://h.example/x", f"<div>{own(i)}</div>" + f"<div>{NOTICE}</div>" * (i % 20 == 0)) for i in range(2000)]
    assert texts(spark, rows) == {i: own(i) for i in range(2000)}


def test_undeclared_near_copies_keep_their_text(spark):
    body = own(0, 200)
    rows = [(i, "http://h.example/x", f"<div>{body} {i}</div>") for i in range(40)]
    assert texts(spark, rows) == {i: f"{body} {i}" for i in range(40)}


def test_a_very_long_page(spark):
    body = " ".join(f"word{k}" for k in range(100_000))
    rows = [(i, "http://h.example/x", f"<nav>menu</nav><div>{NOTICE}</div><div>{own(i)}</div>") for i in range(5)]
    rows += [(9, "http://h.example/long", f"<div>{NOTICE}</div><p>{body}</p>")]
    found = texts(spark, rows)
    assert found[9] == body and found[0] == own(0)


def test_what_an_article_does_not_declare_as_its_text_goes_by_repeats(spark):
    links = "home products about us contact imprint press jobs blog help"
    shared = "the same lead stands over each part of this series"
    page = lambda i: (f"<article><ul><li>{links}</li></ul><h1>{shared}</h1><p>{shared} <b>{i}</b></p>"  # noqa: E731
                      f"<div>{NOTICE}</div><blockquote><div>{shared}</div></blockquote>{own(i)}</article>")
    rows = [(i, "http://h.example/x", page(i)) for i in range(30)]
    # an article that mostly consists of repeats is a copy; two pages are too few for boilerplate
    rows += [(100 + i, "http://g.example/x", f"<article>{NOTICE} {own(i, 9)}</article>") for i in range(30)]
    rows += [(200 + i, "http://f.example/x", f"<article>{NOTICE} {own(i)}</article>") for i in range(2)]
    found = texts(spark, rows)
    assert {i: found[i] for i in range(30)} == {i: f"{shared} {shared} {i} {shared} {own(i)}" for i in range(30)}
    assert {i: found[100 + i] for i in range(30)} == {i: f"{NOTICE} {own(i, 9)}" for i in range(30)}
    assert {i: found[200 + i] for i in range(2)} == {i: f"{NOTICE} {own(i)}" for i in range(2)}
