import pytest
from pyspark.errors import AnalysisException

from conftest import rows
from quire.sources import csv as C
from quire.sources import lines as L


def lines_df(spark, data):
    return spark.createDataFrame([(x,) for x in data], "value string")


# --- article lines (S1, S2, quirk Q1) ---------------------------------------

def test_parse_article_offsets(spark):
    line = "X<page><title>Some title</title><text>body text here</text></page>YY"
    assert rows(L.parse_articles(lines_df(spark, [line]))) == [("Some title", "body text here")]


def test_parse_article_first_delimiter_wins(spark):
    line = "X<page><title>T</title><text>a </title><text> b</text></page>YY"
    assert rows(L.parse_articles(lines_df(spark, [line]))) == [("T", "a </title><text> b")]


def test_parse_article_custom_offsets(spark):
    line = "<page><title>T</title><text>body</text></page>"
    got = rows(L.parse_articles(lines_df(spark, [line]), prefix_len=13, suffix_len=14))
    assert got == [("T", "body")]


def test_parse_article_malformed(spark):
    good = "X<page><title>T</title><text>body</text></page>YY"
    bad = ["X<page><title>no delimiter</page>YY",       # no delimiter
           "X</title><text>title too early</text></page>YY",  # delimiter inside the prefix
           "X<page><title>T</title><text>short"]          # less than the suffix left
    for line in bad:
        with pytest.raises(Exception, match="malformed article line"):
            L.parse_articles(lines_df(spark, [line])).collect()
    articles, rejects = L.parse_articles(lines_df(spark, [good] + bad), mode="permissive")
    assert rows(articles) == [("T", "body")]
    assert sorted(r[0] for r in rows(rejects)) == sorted(bad)


def test_read_articles_from_file(spark, tmp_path):
    p = tmp_path / "articles.dat"
    p.write_text("X<page><title>A</title><text>Scala rocks</text></page>YY\n"
                 "X<page><title>B</title><text>Java too</text></page>YY\n", encoding="utf-8")
    assert sorted(rows(L.read_articles(spark, str(p)))) == [("A", "Scala rocks"), ("B", "Java too")]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        L.read_lines(spark, str(tmp_path / "nope.dat")).collect()


# --- posting lines (S3, S4, quirks Q2, Q3) ----------------------------------

def test_parse_postings_optional_fields(spark):
    data = ["1,7,,,5,", "1,7,,,5", "1,7,9,,5,Scala", "1,7,,,5,Scala,Java", "2,8,,7,-3,"]
    got = rows(L.parse_postings(lines_df(spark, data)))
    assert got == [(1, 7, None, None, 5, None), (1, 7, None, None, 5, None), (1, 7, 9, None, 5, "Scala"),
                   (1, 7, None, None, 5, "Scala"), (2, 8, None, 7, -3, None)]
    assert L.parse_postings(lines_df(spark, data)).schema == L.POSTING_SCHEMA


def test_parse_postings_strict_fails(spark):
    for bad in ["1,x,,,5,", "1,7"]:
        with pytest.raises(Exception):
            L.parse_postings(lines_df(spark, [bad])).collect()


def test_parse_postings_permissive_rejects(spark):
    good, rejects = L.parse_postings(lines_df(spark, ["1,x,,,5,", "1,7", "1,7,,,5,Scala", "2,9,,z,1,"]),
                                     mode="permissive")
    assert rows(good) == [(1, 7, None, None, 5, "Scala")]
    assert sorted(r[0] for r in rows(rejects)) == ["1,7", "1,x,,,5,", "2,9,,z,1,"]


def test_read_postings_from_file(spark, tmp_path):
    p = tmp_path / "postings.csv"
    p.write_text("1,1,,,0,Scala\n2,2,,1,4,\n", encoding="utf-8")
    assert rows(L.read_postings(spark, str(p))) == [(1, 1, None, None, 0, "Scala"), (2, 2, None, 1, 4, None)]


# --- wide CSV (S5, S6) ------------------------------------------------------

def test_read_csv_infers_and_returns_columns(spark, tmp_path):
    p = tmp_path / "wide.csv"
    p.write_text("tucaseid,telfs,t010101,t050101\n\"20030100013280\",1,60,120\n\"20030100013344\",5,30,0\n")
    names, df = C.read_csv(spark, str(p))
    assert names == ["tucaseid", "telfs", "t010101", "t050101"]
    assert dict(df.dtypes)["t010101"] == "int"
    schema = C.row_schema(names)
    names2, df2 = C.read_csv(spark, str(p), schema=schema)
    assert names2 == names and dict(df2.dtypes)["t010101"] == "double"
    assert rows(df2)[0] == ("20030100013280", 1.0, 60.0, 120.0)


def test_typed_rows(spark):
    df = spark.createDataFrame([("id1", "1", "2.5"), ("id2", "3", "4")], "a string, b string, c string")
    out = C.typed_rows(df)
    assert out.dtypes == [("a", "string"), ("b", "double"), ("c", "double")]
    assert rows(out) == [("id1", 1.0, 2.5), ("id2", 3.0, 4.0)]
    with pytest.raises(Exception, match="not a number in column b"):
        C.typed_rows(spark.createDataFrame([("id", "x")], "a string, b string")).collect()
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a number in column b"):
            C.typed_rows(spark.createDataFrame([("id", "x")], "a string, b string")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_sql_string_round_trip(spark):
    from quire.functions.text import vocab_array
    terms = ["O'Reilly", "a\\b", "C++", '"q"', "f\u00fcr", "tab\there", "back\\'quote", "x\\n", "new\nline"]
    assert spark.range(1).select(vocab_array(terms).alias("a")).first()[0] == terms


def test_strict_postings_fail_without_ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for bad in ["1,x,,,5,", "1,7", "1,7,y,,5,"]:
            with pytest.raises(Exception, match="malformed posting line"):
                L.parse_postings(lines_df(spark, [bad])).collect()
        assert rows(L.parse_postings(lines_df(spark, ["1,7,,,5,"]))) == [(1, 7, None, None, 5, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
