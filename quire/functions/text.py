"""Token and vocabulary expressions for the article operators."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Vocabularies up to here travel inside the plan, as a literal array; larger
# ones are a table that the articles' tokens are joined with.
LITERAL_TERMS = 2_048


def check_vocab(vocab: Sequence[str]) -> list[str]:
    """Validate a vocabulary: non-empty, no duplicate terms."""
    terms = list(vocab)
    if not terms:
        raise ValueError("vocabulary must not be empty")
    if any(not isinstance(t, str) or t == "" for t in terms):
        raise ValueError("vocabulary terms must be non-empty strings")
    dupes = sorted(t for t, n in Counter(terms).items() if n > 1)
    if dupes:
        raise ValueError(f"duplicate vocabulary terms: {dupes[:20]}")
    return terms


def tokens(text: Column | str) -> Column:
    """Split on a single space, exactly: tabs and newlines do not separate
    and punctuation stays attached ("Java," is not "Java")."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(c, " ")


def mentions(text: Column | str, term: str) -> Column:
    """True when `term` is one of the space-separated tokens of `text`
    (case-sensitive, whole token)."""
    return F.array_contains(tokens(text), F.lit(term))


def sql_string(value: str) -> str:
    """`value` as a Spark SQL string literal (backslash escapes, the parser
    default)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def vocab_array_sql(vocab: Sequence[str]) -> str:
    return "array(" + ", ".join(sql_string(t) for t in vocab) + ")"


def vocab_array(vocab: Sequence[str]) -> Column:
    """The vocabulary as an array literal (one expression, however many terms)."""
    return F.expr(vocab_array_sql(vocab))


def vocab_rows(spark: SparkSession, vocab: Sequence[str]) -> DataFrame:
    """(term): a row per vocabulary term, from a literal of the plan."""
    return spark.range(0, 1, 1, 1).select(F.explode(vocab_array(vocab)).alias("term"))


def term_index(value: Column | str, vocab: Sequence[str]) -> Column:
    """0-based position of the whole `value` in the ordered vocabulary,
    -1 when absent, null when `value` is null."""
    c = F.col(value) if isinstance(value, str) else value
    return F.array_position(vocab_array(vocab), c) - F.lit(1)


Vocabulary = Sequence[str] | DataFrame


def vocab_table(spark: SparkSession, vocab: Vocabulary) -> DataFrame:
    """(idx, term) of a vocabulary given as a list, in its order, or already as
    such a table, whose terms must be non-empty and not repeat."""
    if isinstance(vocab, DataFrame):
        found = vocab.select(F.col("idx").cast("bigint").alias("idx"), "term")
        n, usable, distinct = found.agg(
            F.count(F.lit(1)), F.count_if(F.col("term") != ""), F.count_distinct("term")).first()
        if not n == usable == distinct:
            raise ValueError("a vocabulary table needs non-empty terms without duplicates")
        if not n:
            raise ValueError("vocabulary must not be empty")
        return found
    terms = check_vocab(vocab)
    return spark.createDataFrame(pa.table({"idx": pa.array(range(len(terms)), pa.int64()), "term": pa.array(terms)}))


def is_literal(vocab: Vocabulary) -> bool:
    return not isinstance(vocab, DataFrame) and len(vocab) <= LITERAL_TERMS
