"""The shared Parquet tables and the input views built from them.

The original programs read three external files (article lines, posting lines, a
wide survey CSV) that are not shipped. These views derive inputs of the same
shape from the shared tables, inside Spark, so every query's work grows with
the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- articles -------------------------------------------------------------

def articles_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(title, text): one article per document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("title"),
                       F.col("text"))


def article_lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line): one markup line per document, 14 characters before the
    title and 16 after the text, newlines of the text folded to spaces."""
    docs = table(spark, sf_dir, "documents")
    line = F.concat(F.lit("X<page><title>doc"), F.col("doc_id").cast("string"),
                    F.lit("</title><text>"), F.translate(F.col("text"), "\n", " "),
                    F.lit("</text></page>YY"))
    return docs.select("doc_id", line.alias("line"))


# --- postings -------------------------------------------------------------

def postings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from orders, answers from line items (see `postings_from`)."""
    return postings_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def pair_postings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings with 15 tags, an order's priority and status in one."""
    orders = table(spark, sf_dir, "orders")
    return postings_from(orders.withColumn("o_orderpriority", F.concat_ws("/", "o_orderpriority", "o_orderstatus")),
                         table(spark, sf_dir, "lineitem"))


def postings_from(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Questions from orders, answers from line items, in the posting schema
    (posting_type, id, accepted_answer, parent_id, score, tag). Operators
    that filter on the posting type read one table per side, so order-key
    bucketing of the inputs carries through to their joins."""
    questions = orders.select(
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") * 10 + 1).alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(0).alias("score"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("tag"))
    answers = lines.select(
        F.lit(2).alias("posting_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.col("l_orderkey").alias("parent_id"),
        (F.floor(F.col("l_extendedprice") / 100).cast("int") - F.lit(300)).alias("score"),
        F.lit(None).cast("string").alias("tag"))
    return questions.unionByName(answers)


def posting_lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line): the postings as comma-separated text lines, empty optional fields."""
    p = postings_view(spark, sf_dir)
    opt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return p.select(F.concat_ws(",", F.col("posting_type").cast("string"), F.col("id").cast("string"),
                                opt("accepted_answer"), opt("parent_id"),
                                F.col("score").cast("string"), opt("tag")).alias("line"))


# --- wide survey table ----------------------------------------------------

# The activity-minute columns of the wide fixture, in column
# order; the column at position i sums the quantities of parts with
# l_partkey % 20 == i.
WIDE_MINUTE_COLUMNS = [
    "t010101", "t010102", "t030101", "t110101", "t180101", "t180301", "t050101",
    "t050102", "t180501", "t020101", "t040101", "t060101", "t080101", "t120101",
    "t130101", "t150101", "t160101", "t180201", "t170101", "t500101",
]


def wide_minute_columns() -> list[str]:
    return list(WIDE_MINUTE_COLUMNS)


def wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One respondent per order with at least one line item (see `wide_from`)."""
    return wide_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def wide_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One respondent per order with at least one line item: id, three codes
    and 20 minute columns.

    The line items are summed per order *before* the join (partial + final
    aggregation on l_orderkey), so the join is 1:1 on the order key and no
    order with many lines becomes a hot join key. When both tables are
    bucketed by order key into the same number of buckets, the aggregate
    and the join run without any exchange.
    """
    orders = orders.select("o_orderkey", "o_custkey")
    lines = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    minutes = (lines.groupBy("l_orderkey")
               .agg(*[F.expr(f"sum(CASE WHEN l_partkey % 20 = {i} THEN l_quantity * 10 ELSE 0.0 END)").alias(name)
                      for i, name in enumerate(WIDE_MINUTE_COLUMNS)]))
    joined = orders.join(minutes, orders.o_orderkey == minutes.l_orderkey, "inner")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("tucaseid"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("telfs"),
        (F.col("o_orderkey") % 2 + 1).cast("int").alias("tesex"),
        (F.lit(15) + F.col("o_custkey") % 66).cast("int").alias("teage"),
        *WIDE_MINUTE_COLUMNS)
