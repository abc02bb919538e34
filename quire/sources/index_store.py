"""A stored inverted index: written once, ranked and looked up without the corpus.

    write_index(articles, path, with_text=True)
    index = StoredIndex(spark, path)
    index.rank(vocab)                  # reads (term, n) of the blocks
    index.lookup(["Scala"], text=True) # decodes those terms' blocks, fetches their articles

Two Parquet tables below `path`: `blocks` (term, block, n, first, gaps), in
ranges of (term, block), and `articles` (doc, title[, text]) in order of doc.
An article's number `doc` is its place in the input, without holes. A block
holds up to `block_size` numbers of one term as the first one and the gaps
between neighbours. Files and row groups hold ranges of terms or of numbers,
so a lookup reads those that its filter can touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.geometry import int_div
from quire.functions.text import Vocabulary, check_vocab, is_literal, tokens, vocab_table
from quire.operators.articles import _known_tokens, _present_terms, _small, rank_terms_using_index
from quire.session import ensure_checkpoint_dir

BLOCKS = "term string, block bigint, n bigint, first bigint, gaps array<bigint>"
#: Articles whose postings are gathered in one group before blocks are cut.
CHUNK = 1 << 18


def numbered_articles(articles: DataFrame) -> DataFrame:
    """`articles` with `doc`, numbers 0, 1, ... in the order of the input's
    partitions. The frame is checkpointed, so that the numbers stay; one row
    per partition is summed to give each its first number."""
    ensure_checkpoint_dir(articles.sparkSession)
    placed = articles.withColumn("_m", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright("_m", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")  # a row per partition
            .withColumn("doc", F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_m", "_part", "_start"))


def _gaps(docs: Column) -> Column:
    """A sorted array's differences of neighbours, one less than its entries."""
    return F.transform(F.slice(docs, 2, F.greatest(F.lit(0), F.size(docs) - 1)), lambda d, i: d - F.get(docs, i))


def index_blocks(postings: DataFrame, block_size: int) -> DataFrame:
    """(term, block, n, first, gaps) from (term, doc).

    Postings are gathered by term and chunk of the articles, so that no group
    has more than `CHUNK`; a chunk's sorted numbers are cut into blocks. The
    chunks of a term that fits one block are put together first.
    """
    ensure_checkpoint_dir(postings.sparkSession)
    chunks = (postings.groupBy("term", int_div(F.col("doc"), F.lit(CHUNK).cast("bigint")).alias("chunk"))
              .agg(F.array_sort(F.collect_list("doc")).alias("docs")).checkpoint(eager=True))
    totals = chunks.groupBy("term").agg(F.sum(F.size("docs")).alias("n_term"))
    chunk = F.when(F.col("n_term") <= block_size, F.lit(0).cast("bigint")).otherwise(F.col("chunk"))
    whole = (chunks.join(totals, "term").withColumn("chunk", chunk).groupBy("term", "chunk")
             .agg(F.array_sort(F.flatten(F.collect_list("docs"))).alias("docs")))
    per_chunk = -(-CHUNK // block_size)
    cut = F.posexplode(F.transform(F.sequence(F.lit(1), F.size("docs"), F.lit(block_size)),
                                   lambda i: F.slice("docs", i, block_size)))
    return (whole.select("term", "chunk", cut.alias("k", "part"))
            .select("term", (F.col("chunk") * F.lit(per_chunk) + F.col("k")).alias("block"),
                    F.size("part").cast("bigint").alias("n"), F.get("part", F.lit(0)).alias("first"),
                    _gaps(F.col("part")).alias("gaps")))


def write_index(articles: DataFrame, path: str, vocab: Vocabulary | None = None, block_size: int = 10_000,
                with_text: bool = False) -> None:
    """Write the index of `articles` (title, text) to a new folder `path`.

    Terms are those of `vocab`, or every token without one. Duplicate articles
    have numbers of their own. With `with_text` the articles' table holds their
    texts too, for lookups that ask for them. A null text has no terms.
    """
    if block_size < 1:
        raise ValueError("block_size must be positive")
    rows = numbered_articles(articles.select("title", "text"))
    rows.select("doc", "title", *["text"] * with_text).write.parquet(f"{path}/articles")
    if vocab is None:
        postings = rows.select("doc", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    elif is_literal(vocab):
        postings = rows.select("doc", F.explode(_present_terms("text", check_vocab(vocab))).alias("term"))
    else:
        terms = vocab_table(rows.sparkSession, vocab)
        postings = _known_tokens(rows, terms, _small(terms), "doc")
    blocks = index_blocks(postings, block_size)
    blocks.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(f"{path}/blocks")


class StoredIndex:
    """An index that `write_index` wrote."""

    def __init__(self, spark: SparkSession, path: str):
        self.blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
        self.articles = spark.read.parquet(f"{path}/articles")

    def rank(self, vocab: Vocabulary) -> DataFrame:
        """(term, n), most mentioned first: the sizes of the terms' blocks."""
        return rank_terms_using_index(self.blocks.select("term", "block", "n"), vocab)

    def rank_all(self, k: int) -> DataFrame:
        """(term, n): the `k` most mentioned of all terms, ties by term."""
        sizes = self.blocks.groupBy("term").agg(F.sum("n").alias("n"))
        return sizes.orderBy(F.desc("n"), "term").limit(k)

    def postings(self, terms: Sequence[str]) -> DataFrame:
        """(term, doc) of some terms, decoded: a running total within each block."""
        known = self.blocks.where(F.col("term").isin(list(terms)))
        gaps = known.select("term", "block", F.posexplode(F.concat(F.array("first"), "gaps")).alias("at", "gap"))
        total = Window.partitionBy("term", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        return gaps.select("term", F.sum("gap").over(total).alias("doc"))

    def lookup(self, terms: Sequence[str], text: bool = False) -> DataFrame:
        """(term, title[, text]) of the articles that mention some terms."""
        if text and "text" not in self.articles.columns:
            raise ValueError("the index was written without texts")
        found = self.postings(terms).join(self.articles, "doc")
        return found.select("term", "title", *["text"] * text)
