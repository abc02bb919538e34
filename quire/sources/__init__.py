"""Readers and parsers (article lines, posting lines, wide CSV) and the
views over the shared Parquet tables that stand in for the original programs'
external input files."""

from quire.sources.tables import (table, articles_view, article_lines_view, postings_view,
                                  posting_lines_view, wide_view, wide_minute_columns)
from quire.sources.lines import (read_lines, parse_articles, parse_postings, read_articles,
                                 read_postings, POSTING_SCHEMA)
from quire.sources.csv import read_csv, typed_rows

__all__ = [
    "table", "articles_view", "article_lines_view", "postings_view", "posting_lines_view",
    "wide_view", "wide_minute_columns", "read_lines", "parse_articles", "parse_postings",
    "read_articles", "read_postings", "POSTING_SCHEMA", "read_csv", "typed_rows",
]
