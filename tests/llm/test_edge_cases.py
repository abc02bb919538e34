"""Every operator and stage on nulls, empty and repeated rows, an empty table,
and extra columns whose names clash with its own."""

import pytest

import corpus_pipeline
from quire.llm import (embeddings, langid, lines, mixing, outliers, packing, simhash, simple8b, webtext,
                       wordpiece)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "fp long, slot string, n_lines string, _source string, ids string, kept string, path string")
LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, LONG, "en", "a"), (1, LONG, "en", "a"),  # a repeated row
    (2, None, "en", "a"), (3, "", "de", None), (4, " \n\t ", None, "b"),
    (None, LONG, "en", "a"), (5, LONG, None, None), (6, "Ünder größe 42!", "de", "b"),
    (7, "word " * 30_000, "en", "b"),  # very long
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA)


OPERATORS = {
    "pack": packing.pack,
    "mix": mixing.mix,
    "near_duplicates": simhash.near_duplicates,
    "quality": outliers.quality,
    "token_counts": wordpiece.token_counts,
    "round_trip": simple8b.round_trip,
    "dedup_lines": lines.dedup_lines,
    "identify": langid.identify,
    "identified": langid.identified,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hostile_rows(spark, name):
    found = [r.asDict() for r in OPERATORS[name](frame(spark, ROWS)).collect()]
    ids = [r["doc_id"] for r in found]
    if name in ("pack", "mix"):
        assert set(ids) == {r[0] for r in ROWS}
    elif name == "identified":
        assert set(ids) <= {r[0] for r in ROWS} and 6 in ids and 3 not in ids
    else:
        assert sorted(ids, key=str) == sorted((r[0] for r in ROWS), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).collect() == []


@pytest.mark.parametrize("rows", [ROWS, []], ids=["hostile", "empty"])
def test_pipeline_stages(spark, rows):
    docs = frame(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.scratch_table(stage(spark, docs, ""), name)
        if name != "pack":
            assert docs.columns == columns
    assert (docs.count() > 0) == bool(rows)


def test_embeddings_edge_cases(spark):
    schema = "vec_id long, embedding array<float>, label int, e string, id string, links string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]),
            (10, [0.0, 1.0])]
    found = sorted(map(tuple, embeddings.near_duplicates(
        spark.createDataFrame([(*r, 0, "x", "x", "x") for r in rows], schema)).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert found == sorted([(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (None, 0, None, False), *alone], key=str)
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_pages_edge_cases(spark):
    schema = "page_id long, url string, html string, host string, text string, site string"
    rows = [(1, None, None), (2, "not a url", ""), (None, "http://a.b/c", "<article><p>x &amp; y</article>"),
            (3, "http://a.b/c", "<p>unclosed <b>bold"), (3, "http://a.b/c", "<p>unclosed <b>bold")]
    found = sorted(map(tuple, webtext.extract(
        spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)).collect()), key=str)
    assert found == sorted([(1, None, "", 0), (2, "not a url", "", 0), (None, "http://a.b/c", "x & y", 5),
                            (3, "http://a.b/c", "unclosed bold", 13), (3, "http://a.b/c", "unclosed bold", 13)], key=str)
    assert webtext.extract(spark.createDataFrame([], schema)).collect() == []
