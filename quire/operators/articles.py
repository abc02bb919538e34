"""Article operators: term-mention filter, per-term counts, three ranking
strategies, and an inverted index (long form, plus bounded blocks).

A term is mentioned when it is one of the article's space-separated tokens
(exact, case-sensitive). Counts are per article, not per occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.geometry import int_div
from quire.functions.hashing import md5_prefix32
from quire.functions.text import (Vocabulary, check_vocab, is_literal, mentions, sql_string, term_index, tokens,
                                  vocab_array, vocab_rows, vocab_table)
from quire.operators.common import sort_bounded
from quire.session import ensure_checkpoint_dir


def mentions_filter(articles: DataFrame, term: str) -> DataFrame:
    """Articles whose text mentions `term`."""
    (term,) = check_vocab([term])
    return articles.where(mentions("text", term))


def occurrences_of_term(articles: DataFrame, term: str) -> DataFrame:
    """One row, `n`: the number of articles that mention `term`."""
    (term,) = check_vocab([term])
    return articles.agg(F.count_if(mentions("text", term)).alias("n"))


def _present_terms(text: Column | str, vocab: Sequence[str]) -> Column:
    """Distinct vocabulary terms among the tokens of `text` (at most one
    entry per term however long the article is). The vocabulary is the
    hashed side; the tokens are streamed once."""
    return F.array_intersect(tokens(text), vocab_array(vocab))


def _ordered(counts: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """(term, n) ordered by n desc, ties in vocabulary order (at most
    |vocab| rows, sorted in one partition)."""
    return sort_bounded(counts.withColumn("idx", term_index("term", vocab)),
                        F.desc("n"), F.asc("idx")).select("term", "n")


def _zero_filled_counts(keyed: DataFrame, vocab: Sequence[str], weight: Column | None = None) -> DataFrame:
    """Count rows (or sum `weight`) per term of `keyed` (a `term` column),
    keeping terms with no rows as 0. The vocabulary is unioned in as one
    zero-weight row per term, so the result is a single partial/final
    aggregate — no join."""
    zeros = vocab_rows(keyed.sparkSession, vocab).select("term", F.lit(0).cast("bigint").alias("w"))
    ones = keyed.select("term", (F.lit(1) if weight is None else weight).cast("bigint").alias("w"))
    return ones.unionByName(zeros).groupBy("term").agg(F.sum("w").cast("bigint").alias("n"))


def rank_terms(articles: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(term, n) for every vocabulary term, most mentioned first; zeros kept.

    One scan: the text is split once per article, then one `count_if` per
    term runs in a single global aggregate (partial per task, final over
    one row per task); the one-row result is unpivoted. A vocabulary table or
    a long list goes by `rank_terms_by_join`.
    """
    if not is_literal(vocab):
        return rank_terms_by_join(articles, vocab)
    vocab = check_vocab(vocab)
    present = articles.select(_present_terms("text", vocab).alias("present"))
    return _unpivoted(present, vocab, lambda i, t: f"array_contains(present, {sql_string(t)})")


def _unpivoted(rows: DataFrame, vocab: Sequence[str], holds: Callable[[int, str], str]) -> DataFrame:
    """The ranking by one count per term in a single global aggregate."""
    # one SQL expression per term: planning stays cheap for a long vocabulary
    counts = rows.agg(*[F.expr(f"count_if({holds(i, t)}) AS c{i}") for i, t in enumerate(vocab)])
    pairs = ", ".join(f"{sql_string(t)}, c{i}" for i, t in enumerate(vocab))
    return _ordered(counts.selectExpr(f"stack({len(vocab)}, {pairs}) AS (term, n)"), vocab)


def rank_terms_agg(articles: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Same ranking by fan-out and keyed aggregation: one (term) row per
    article and mentioned term, counted with map-side combine."""
    if not is_literal(vocab):
        return rank_terms_by_join(articles, vocab)
    vocab = check_vocab(vocab)
    keyed = articles.select(F.explode(_present_terms("text", vocab)).alias("term"))
    return _ordered(_zero_filled_counts(keyed, vocab), vocab)


#: A vocabulary table is broadcast up to this size, measured before the join.
BROADCAST_BYTES = 64 << 20


def _small(terms: DataFrame) -> bool:
    """Whether a vocabulary's terms and places fit the broadcast bound (one small job)."""
    (size,) = terms.agg(F.sum(F.octet_length("term") + F.lit(32))).first()
    return (size or 0) <= BROADCAST_BYTES


def _known_tokens(articles: DataFrame, terms: DataFrame, small: bool, *cols: str) -> DataFrame:
    """(term, *cols): each article's distinct tokens that are terms. A small
    vocabulary goes to the tokens, else both go to the terms' tasks; a hot
    term's tokens then are many rows of one key, which AQE splits."""
    tokens_ = articles.select(F.explode(F.array_distinct(tokens("text"))).alias("term"), *cols)
    known = terms.select("term")
    return tokens_.join(F.broadcast(known) if small else known.hint("merge"), "term", "left_semi")


def rank_terms_by_join(articles: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The ranking (term, n) over a vocabulary of any length, a list or a table (idx, term).

    An article's tokens are made distinct before anything moves. With a
    vocabulary of at most `BROADCAST_BYTES`, by measure, tokens outside it
    drop out at the scan; a larger one meets the tokens after they are
    counted, partially in each task, so that either way one row per task and
    token is shuffled, and no hot token is. Zeros are kept.
    """
    terms = vocab_table(articles.sparkSession, vocab)
    if _small(terms):
        found = _known_tokens(articles, terms, True)
    else:
        found = articles.select(F.explode(F.array_distinct(tokens("text"))).alias("term"))
    return _ranked(terms, found.groupBy("term").agg(F.count(F.lit(1)).alias("found")))


def _ranked(terms: DataFrame, counts: DataFrame) -> DataFrame:
    """(term, n) of a vocabulary table from its counts (term, found), zeros kept."""
    return (terms.join(counts, "term", "left").select("term", F.coalesce("found", F.lit(0)).alias("n"), "idx")
            .orderBy(F.desc("n"), "idx").select("term", "n"))


def inverted_index(articles: DataFrame, vocab: Vocabulary, with_text: bool = False) -> DataFrame:
    """Long-form inverted index: one (term, title[, text]) row per article and
    mentioned term. Narrow (no shuffle) for a literal or broadcast vocabulary;
    duplicate articles are retained. A hot term is just many rows, never one
    huge row."""
    cols = ["title"] + ["text"] * with_text
    if not is_literal(vocab):
        terms = vocab_table(articles.sparkSession, vocab)
        if with_text:
            articles = articles.withColumn("_text", F.col("text"))
            cols = ["title", F.col("_text").alias("text")]
        return _known_tokens(articles, terms, _small(terms), *cols)
    vocab = check_vocab(vocab)
    return articles.select(F.explode(_present_terms("text", vocab)).alias("term"), *cols)


def term_bitmaps(articles: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """(title, bits): for each article a bit per vocabulary term that it
    mentions, 64 to a bigint, in place of its text. All rankings and the index
    can be made from it, so it is what to keep when several are wanted: its
    size goes by the vocabulary, not by the texts."""
    vocab = check_vocab(vocab)
    places = F.transform(_present_terms("text", vocab),
                         lambda t: (F.array_position(vocab_array(vocab), t) - 1).cast("int"))

    def word(k: int) -> Column:
        own = F.filter("places", lambda p: (p >= 64 * k) & (p < 64 * k + 64))
        return F.aggregate(own, F.lit(0).cast("bigint"),
                           lambda acc, p: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), p % 64)))

    return articles.select("title", places.alias("places")).select(
        "title", F.array(*[word(k) for k in range(-(-len(vocab) // 64))]).alias("bits"))


def _bit(i: int) -> str:
    return f"(shiftright(bits[{i // 64}], {i % 64}) & 1L) = 1L"


def rank_bitmaps(bitmaps: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """`rank_terms` from `term_bitmaps` over the same vocabulary."""
    return _unpivoted(bitmaps, check_vocab(vocab), lambda i, _: _bit(i))


def index_bitmaps(bitmaps: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """The long-form index (term, and the other columns) from `term_bitmaps`."""
    vocab = check_vocab(vocab)
    terms = ", ".join(f"IF({_bit(i)}, {sql_string(t)}, NULL)" for i, t in enumerate(vocab))
    rest = [c for c in bitmaps.columns if c != "bits"]
    return bitmaps.select(F.explode(F.expr(f"array_compact(array({terms}))")).alias("term"), *rest)


def rank_bitmaps_agg(bitmaps: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """`rank_terms_agg` from `term_bitmaps` over the same vocabulary."""
    vocab = check_vocab(vocab)
    return _ordered(_zero_filled_counts(index_bitmaps(bitmaps, vocab), vocab), vocab)


def rank_terms_using_index(index: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Ranking from an index: the size of each vocabulary term's posting list.

    A long-form index counts by its rows, a block index (with columns `block`
    and `n`) by the blocks' sizes; of the latter only term and n are read.
    Rows for other terms are not counted, so the result has exactly |vocab| rows."""
    weight = F.col("n") if {"block", "n"} <= set(index.columns) else F.lit(1)
    if not is_literal(vocab):
        terms = vocab_table(index.sparkSession, vocab)
        counts = index.groupBy("term").agg(F.sum(weight.cast("bigint")).alias("found"))
        return _ranked(terms, counts)
    vocab = check_vocab(vocab)
    return _ordered(_zero_filled_counts(index.where(F.col("term").isin(vocab)), vocab, weight), vocab)


def inverted_index_blocks(index: DataFrame, vocab: Vocabulary, block_size: int = 10_000,
                          materialize: bool = True) -> DataFrame:
    """Posting lists in bounded blocks: (term, block, n, titles, n_term, n_titles).

    Each term's postings are cut into ceil(n_term / block_size) blocks by a
    hash of the title, so a block holds about `block_size` postings however
    hot the term is. The copies of one title go by the same hash in runs of
    at most block_size / 16, each run after the first to a block of its own
    hash, so neither does a title with very many copies fill one block. Per
    block: `titles` is the sorted array of its titles, copies included, and
    `n` their number; per term, repeated on each of its blocks: `n_term`
    postings and `n_titles` distinct titles (a null title counts as one). A
    term without postings gets one row (block 0, zeros, no titles).

    Plan: stage 1 counts (term, title), copies combined before the shuffle.
    With `materialize` it is checkpointed into `spark.checkpoint.dir`: the
    text is scanned once (one job runs here) and the per-term totals, the
    block cut and the empty-term rows all read the checkpoint. Without it
    the plan stays lazy and each of the three reads re-derives stage 1 from
    the text. The totals have at most |vocab| rows; those of a literal
    vocabulary are broadcast.
    """
    literal = is_literal(vocab)
    terms = vocab_rows(index.sparkSession, check_vocab(vocab)) if literal else vocab_table(index.sparkSession, vocab)
    if block_size < 1:
        raise ValueError("block_size must be positive")
    run_size = F.lit(max(1, block_size // 16)).cast("bigint")
    index = index.where(F.col("term").isin(vocab)) if literal else index.join(
        F.broadcast(terms) if _small(terms) else terms, "term", "left_semi")
    counted = index.groupBy("term", "title").agg(F.count(F.lit(1)).alias("copies"))
    if materialize:
        ensure_checkpoint_dir(index.sparkSession)
        counted = counted.checkpoint(eager=True)
    totals = counted.groupBy("term").agg(F.sum("copies").alias("n_term"), F.count(F.lit(1)).alias("n_titles"))
    totals = F.broadcast(totals) if literal else totals
    nblocks = F.ceil(F.col("n_term") / F.lit(block_size)).cast("bigint")
    key = F.concat(F.coalesce("title", F.lit("")), F.when(F.col("run") > 0, F.concat(F.lit("#"), "run")).otherwise(""))
    in_run = F.least(run_size, F.col("copies") - F.col("run") * run_size)
    last_run = int_div(F.col("copies") - F.lit(1), run_size)
    blocks = (counted.join(totals, "term")
              .withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), last_run)))
              .withColumn("block", F.shiftright(md5_prefix32(key) * nblocks, 32))
              .withColumn("in_run", in_run)
              .groupBy("term", "block")
              .agg(F.sum("in_run").alias("n"),
                   F.array_sort(F.flatten(F.collect_list(F.array_repeat("title", F.col("in_run").cast("int")))))
                   .alias("titles"),
                   F.first("n_term").alias("n_term"), F.first("n_titles").alias("n_titles")))
    empty = (terms.join(totals, "term", "left_anti")
             .select("term", F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("n"),
                     F.array().cast("array<string>").alias("titles"),
                     F.lit(0).cast("bigint").alias("n_term"), F.lit(0).cast("bigint").alias("n_titles")))
    return blocks.unionByName(empty)


def top_term(ranking: DataFrame, vocab: Sequence[str] | None = None, k: int = 1) -> DataFrame:
    """The first `k` rows of a ranking (term, n): most mentioned first, ties in
    vocabulary order, or by term without a vocabulary. Spark plans a top-k per
    task and a merge of those, with no sort of the whole ranking."""
    tie = F.col("term") if vocab is None else term_index("term", check_vocab(vocab))
    return ranking.orderBy(F.desc("n"), tie).limit(k)
