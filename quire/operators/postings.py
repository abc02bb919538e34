"""Question/answer operators: split by posting type, pair answers with their
question, best-answer score per question, and per-tag score vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.geometry import int_div
from quire.functions.hashing import md5_prefix32
from quire.functions.text import Vocabulary, check_vocab, is_literal, term_index, vocab_table

QUESTION, ANSWER = 1, 2
DEFAULT_SPREAD = 50_000


def questions(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("posting_type") == QUESTION)


def answers(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("posting_type") == ANSWER)


#: A hot question has more answers than this share of a shuffle partition's mean;
#: it is cut into pieces of that size.
PIECES_PER_PARTITION = 16
#: Hot questions at most (by their measure: more answers than 1 in so many of all).
MAX_HOT = 65_536


def hot_questions(postings: DataFrame, partitions: int | None = None) -> DataFrame:
    """(hot_id, pieces): the questions with so many answers that a shuffle into
    `partitions` tasks would be uneven, and the pieces to cut each into.

    One pass over the answers' parent ids: a frequent-items sketch per task,
    merged into one, holds every id with more than 1 in `MAX_HOT` of the
    answers or a sixteenth of a partition's mean, whichever is more; its
    counts set the number of pieces. So the result has `MAX_HOT` rows at
    most, whatever the data. It runs one job here.
    """
    spark = postings.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(MAX_HOT, PIECES_PER_PARTITION * partitions)
    # the sketch's error is under 4 in its number of entries
    n, items = (answers(postings).where(F.col("parent_id").isNotNull())
                .agg(F.count(F.lit(1)), F.expr(f"approx_top_k(parent_id, {most}, {8 * most})")).first())
    piece = max(1, -(-n // most))
    hot = [f"{item['item']}:{-(-item['count'] // piece)}" for item in items or [] if item["count"] > piece]
    rows = spark.range(0, 1, 1, 1).select(F.explode(F.split(F.lit(",".join(hot)), ",")).alias("r")).where("r <> ''")
    return rows.select(F.substring_index("r", ":", 1).cast("bigint").alias("hot_id"),
                       F.substring_index("r", ":", -1).cast("int").alias("pieces"))


def grouped_postings(postings: DataFrame, split_hot: bool = True) -> DataFrame:
    """Questions paired with their answers, in long form: one row per
    (question, answer) with `qid` and both postings' fields prefixed q_/a_.

    Inner equi-join on q.id = a.parent_id: unanswered questions and answers
    without a parent drop out. The grouping of the original is the `qid`
    column; no per-question list is built, so a question with a huge number
    of answers is many rows.

    With `split_hot` the answers of each of the `hot_questions` are dealt by
    hash to pieces of about equal size, the question is repeated for each
    piece, and the join key is (id, piece); every other question keeps one
    piece. So a hot question's answers spread over many tasks, with AQE on or
    off, and nothing else is repeated. The output is the same.
    """
    q = questions(postings).select(*[F.col(c).alias(f"q_{c}") for c in postings.columns])
    a = answers(postings).select(*[F.col(c).alias(f"a_{c}") for c in postings.columns])
    if split_hot:
        hot = F.broadcast(hot_questions(postings))  # MAX_HOT rows at most
        pieces = F.coalesce("pieces", F.lit(1))
        q = (q.join(hot, F.col("q_id") == F.col("hot_id"), "left")
             .withColumn("q_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("hot_id", "pieces"))
        a = (a.where(F.col("a_parent_id").isNotNull()).join(hot, F.col("a_parent_id") == F.col("hot_id"), "left")
             .withColumn("a_piece", F.pmod(F.xxhash64("a_id", "a_score"), pieces).cast("int")).drop("hot_id", "pieces"))
        cond = (F.col("q_id") == F.col("a_parent_id")) & (F.col("q_piece") == F.col("a_piece"))
    else:
        cond = F.col("q_id") == F.col("a_parent_id")
    return (q.join(a, cond, "inner")
            .select(F.col("q_id").alias("qid"), *[F.col(f"q_{c}") for c in postings.columns],
                    *[F.col(f"a_{c}") for c in postings.columns]))


def grouped_posting_blocks(postings: DataFrame, block_size: int = 10_000) -> DataFrame:
    """The answers of each question in bounded blocks: (qid, block, n, n_answers, answers).

    A question with n_answers answers has ceil(n_answers / block_size)
    blocks; an answer's block goes by a hash of its id and score and its
    number among equal ones in runs of block_size, so a block holds about
    `block_size` answers however hot the question is. `answers` is the
    sorted array of (id, score), copies included, and `n` their number.
    Unanswered questions and answers without a question drop out; a repeated
    question id yields its blocks once.

    Equal answers are counted before the shuffle. Totals reach the answers
    over (id, piece), with the pieces of `hot_questions`, so a hot question's
    answers spread over many tasks and no other question is repeated.
    """
    if block_size < 1:
        raise ValueError("block_size must be positive")
    size = F.lit(block_size).cast("bigint")
    a = (answers(postings).where(F.col("parent_id").isNotNull())
         .groupBy(F.col("parent_id").alias("qid"), "id", "score").agg(F.count(F.lit(1)).alias("copies")))
    totals = a.groupBy("qid").agg(F.sum("copies").alias("n_answers"))
    asked = questions(postings).select(F.col("id").alias("qid")).distinct().join(totals, "qid")
    hot = hot_questions(postings)
    asked = (asked.join(F.broadcast(hot), F.col("qid") == F.col("hot_id"), "left")
             .withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
             .drop("hot_id", "pieces"))
    a = (a.join(F.broadcast(hot), F.col("qid") == F.col("hot_id"), "left")
         .withColumn("piece", F.pmod(F.xxhash64("id", "score"), F.coalesce("pieces", F.lit(1))).cast("int"))
         .drop("hot_id", "pieces"))
    nblocks = F.ceil(F.col("n_answers") / size).cast("bigint")
    key = F.concat_ws(":", "id", "score", "run")
    return (a.join(asked, ["qid", "piece"])
            .withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), int_div(F.col("copies") - F.lit(1), size))))
            .withColumn("in_run", F.least(size, F.col("copies") - F.col("run") * size))
            .withColumn("block", F.shiftright(md5_prefix32(key) * nblocks, 32))
            .groupBy("qid", "block")
            .agg(F.sum("in_run").alias("n"), F.first("n_answers").alias("n_answers"),
                 F.array_sort(F.flatten(F.collect_list(
                     F.array_repeat(F.struct("id", "score"), F.col("in_run").cast("int"))))).alias("answers")))


def scored_postings(postings: DataFrame, unique_ids: bool = True) -> DataFrame:
    """Every answered question with `high_score`: the best answer score,
    floored at 0.

    The answers are reduced to one row per parent first (max with map-side
    combine), then joined to the questions — the join never sees more than
    one answer row per question, whatever the answer skew. Question ids are
    taken as unique; with `unique_ids=False` a repeated id is first reduced
    to its smallest row (fields in order), so each id is scored once. That
    reduction is partial before the shuffle (copies collapse map-side) and
    shares the join's partitioning, at the price of a sort-based aggregate.
    """
    best = (answers(postings).where(F.col("parent_id").isNotNull())
            .groupBy(F.col("parent_id").alias("qid")).agg(F.max("score").alias("max_score")))
    q = questions(postings)
    if not unique_ids:
        rest = [c for c in postings.columns if c != "id"]
        q = (q.groupBy("id").agg(F.min(F.struct(*rest)).alias("q"))
             .select("id", *[F.col(f"q.{c}").alias(c) for c in rest]))
    return (q.join(best, F.col("id") == F.col("qid"), "inner")
            .select(*postings.columns, F.greatest(F.lit(0), F.col("max_score")).alias("high_score")))


def vector_postings(scored: DataFrame, vocab: Vocabulary, spread: int = DEFAULT_SPREAD) -> DataFrame:
    """(x, y) = (index of the tag in `vocab` * spread, high_score) for
    questions whose whole tag is a vocabulary term; others drop out. A
    vocabulary table (idx, term) or a long list is joined, broadcast or not
    by the planner's measure."""
    if spread <= 0:
        raise ValueError("spread must be positive, or the tag cannot be recovered from x")
    if is_literal(vocab):
        idx = term_index("tag", check_vocab(vocab))
        known = scored.where(idx >= 0)
    else:
        idx = F.col("idx")
        known = scored.join(vocab_table(scored.sparkSession, vocab), F.col("tag") == F.col("term"))
    return (known.select((idx * F.lit(spread)).cast("bigint").alias("x"),
                    F.col("high_score").cast("bigint").alias("y")))


def vector_count(vectors: DataFrame, expected: int | None = None) -> DataFrame:
    """One row `n` = number of vectors; with `expected`, the job fails when
    the count differs (checked when the row is computed)."""
    n = F.count(F.lit(1))
    if expected is None:
        return vectors.agg(n.alias("n"))
    checked = F.when(n == F.lit(expected), n).otherwise(
        F.raise_error(F.concat(F.lit("unexpected vector count: "), n.cast("string"))))
    return vectors.agg(checked.alias("n"))
