"""Line-oriented sources: article markup lines and comma-separated postings.

Files are read by `spark.read.text`, split into partitions by the file
source, and parsed by column expressions — no driver-side list, no per-row
Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.checks import must_hold, once

TITLE_DELIMITER = "</title><text>"

POSTING_SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType(), True),
    T.StructField("id", T.LongType(), True),
    T.StructField("accepted_answer", T.LongType(), True),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("score", T.IntegerType(), True),
    T.StructField("tag", T.StringType(), True),
])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Distributed UTF-8 line reader: one row (`value`) per line. A missing
    path raises Spark's own AnalysisException."""
    return spark.read.text(path)


def parse_articles(lines: DataFrame, line_col: str = "value", prefix_len: int = 14,
                   suffix_len: int = 16, mode: str = "strict"):
    """(title, text) from markup lines.

    The title runs from character `prefix_len` (0-based) to the *first*
    `</title><text>`; the text from after that delimiter to `suffix_len`
    characters before the end. A line is malformed when the delimiter is
    missing, starts inside the prefix, or leaves less than the suffix
    behind. `mode="strict"` fails the job on such a line;
    `mode="permissive"` returns a pair `(articles, rejects)`.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    # the delimiter's place and the length, found once a line: no rule folds a generator into its uses
    line = F.col(line_col)
    marks = F.struct(F.instr(line, TITLE_DELIMITER).alias("pos"), F.length(line).alias("size"))
    found = lines.select(line.alias("_line"), once(marks).alias("_at"))
    line, pos = F.col("_line"), F.col("_at.pos")  # 1-based, 0 when absent
    text_start = pos + F.lit(len(TITLE_DELIMITER))
    text_end = F.col("_at.size") - F.lit(suffix_len)
    ok = (pos > prefix_len) & (text_end >= text_start - 1)
    title = line.substr(F.lit(prefix_len + 1), pos - F.lit(1 + prefix_len))
    text = line.substr(text_start, text_end - text_start + 1)
    if mode == "strict":
        return must_hold(found, ok, F.concat(F.lit("malformed article line: "), F.coalesce(line.substr(1, 80), F.lit("null")))).select(
            title.alias("title"), text.alias("text"))
    return (found.where(ok).select(title.alias("title"), text.alias("text")),
            found.where(~F.coalesce(ok, F.lit(False))).select(line.alias(line_col)))


def read_articles(spark: SparkSession, path: str, **kw) -> DataFrame:
    return parse_articles(read_lines(spark, path), **kw)


# (name, type, optional) of the first five comma-separated fields; the
# sixth (tag) is free text.
POSTING_FIELDS = [("posting_type", "int", False), ("id", "bigint", False),
                  ("accepted_answer", "bigint", True), ("parent_id", "bigint", True),
                  ("score", "int", False)]


def parse_postings(lines: DataFrame, line_col: str = "value", mode: str = "strict"):
    """Postings from `type,id,[accepted],[parent],score[,tag]` lines.

    Fields 0, 1 and 4 are mandatory integers, 2 and 3 are empty or an
    integer, field 5 (tag) is optional and anything after it is ignored; an
    empty tag is null. `mode="strict"` fails the job on the first malformed
    line; `mode="permissive"` returns a pair `(postings, rejects)` where
    rejects holds the lines that did not parse. Validity is checked
    explicitly, so both modes behave the same with ANSI mode on or off.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    # two generators: the line is split once, and each field cast once for check and result
    found = lines.select(F.col(line_col).alias("_line"), once(F.split(F.col(line_col), ",")).alias("_fields"))
    line, fields = F.col("_line"), [F.get("_fields", i) for i in range(len(POSTING_FIELDS) + 1)]
    values = [F.nullif(text, F.lit("")).try_cast(dtype).alias(name)
              for text, (name, dtype, _) in zip(fields, POSTING_FIELDS)]
    values.append(F.nullif(fields[-1], F.lit("")).alias("tag"))
    found = found.select("_line", "_fields", once(F.struct(*values)).alias("_posting"))
    ok = F.lit(True)
    for text, (name, _, optional) in zip(fields, POSTING_FIELDS):
        value = F.col(f"_posting.{name}")
        ok = ok & ((text.isNotNull() & ((text == "") | value.isNotNull())) if optional else value.isNotNull())
    if mode == "strict":
        message = F.concat(F.lit("malformed posting line: "), F.coalesce(line.substr(1, 80), F.lit("null")))
        return must_hold(found, ok, message).select("_posting.*")
    return found.where(ok).select("_posting.*"), found.where(~F.coalesce(ok, F.lit(False))).select(line.alias(line_col))


def read_postings(spark: SparkSession, path: str, mode: str = "strict"):
    return parse_postings(read_lines(spark, path), mode=mode)
