"""Postings stored by explicit partitioning, so that pairing and scoring need no shuffle.

    write_postings(postings, "posts", buckets=512, path="s3://...")
    posts = read_postings_tables(spark, "posts")
    shuffle_free(scored_postings(posts))   # the frame, or an error that names the exchange

Questions are bucketed by their id and answers by their parent's, into the
same number of buckets, sorted by the key in each; a join or an aggregate by
question then reads bucket i of both tables in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.postings import ANSWER, QUESTION, answers, questions
from quire.sources.lines import POSTING_SCHEMA

#: The two tables of a name, and the key that each is bucketed by.
SIDES = {"questions": "id", "answers": "parent_id"}


def write_postings(postings: DataFrame, name: str, buckets: int, path: str | None = None, mode: str = "error") -> None:
    """Write `postings` as the tables name_questions and name_answers, below
    `path` if given, else in the warehouse.

    Rows are dealt to their buckets in one shuffle a side, so each bucket is
    one file. Answers without a parent belong to no question and are left
    out, as are postings of other types.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    rows = postings.select(POSTING_SCHEMA.fieldNames())
    sides = {"questions": questions(rows), "answers": answers(rows).where(F.col("parent_id").isNotNull())}
    for side, key in SIDES.items():
        writer = (sides[side].drop("posting_type").repartition(buckets, key).write
                  .bucketBy(buckets, key).sortBy(key).mode(mode))
        if path:
            writer = writer.option("path", f"{path}/{side}")
        writer.saveAsTable(f"{name}_{side}")


def read_postings_tables(spark: SparkSession, name: str) -> DataFrame:
    """The postings of `write_postings` in the posting schema. Each side's type
    is a constant of the plan, so an operator that filters on it reads one table."""
    def side(kind: str, code: int) -> DataFrame:
        return spark.table(f"{name}_{kind}").select(
            F.lit(code).alias("posting_type"), *[c for c in POSTING_SCHEMA.fieldNames() if c != "posting_type"])

    return side("questions", QUESTION).unionByName(side("answers", ANSWER))


def exchanges(df: DataFrame) -> list[str]:
    """The exchanges of a frame's plan, broadcasts left out."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [line.strip(" +-:*()0123456789") for line in plan.splitlines()
            if "Exchange" in line and "BroadcastExchange" not in line]


def shuffle_free(df: DataFrame) -> DataFrame:
    """`df`, if its plan moves no rows between tasks; else an error."""
    found = exchanges(df)
    if found:
        raise ValueError(f"the plan shuffles: {found[0]}")
    return df
