"""Pages of a host whose rows are mostly copies of one page."""

from quire.llm import webtext


def test_copies_count_as_one_page(spark):
    menu = "home products about us contact imprint press jobs blog help"
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(20))
    page = lambda i: f"<div>{menu}</div><div>{text(i)}</div>"
    rows = [(i, "http://h.example/x", page(max(i - 3000, 0))) for i in range(3031)]
    rows += [(9000 + i, "http://g.example/x", f"<article>{menu} {text(max(i - 100, 0))}</article>") for i in range(130)]
    found = webtext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {
        i: text(max(i - (3000 if i < 9000 else 9100), 0)) for i, _, _ in rows}
