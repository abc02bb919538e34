"""Ranked lexical search over norm buckets, in the manner of LEMP.

A document is the vector of its terms' impacts, a query the vector of its
terms' weights, and a score their product. Documents stand in order of their
vectors' lengths, the longest first, and are cut into buckets. By
Cauchy-Schwarz a query is done with a bucket, and with all that follow, once
the bucket's greatest length times the query's cannot reach the query's
threshold, the score of its tenth best document so far. Inside a bucket the
query's heaviest coordinates bound each vector's product: what they give,
plus the rest of the one length times the rest of the other. Only vectors
whose bound reaches the threshold are scored again, exactly and in integers.

Vectors hold the coordinates of the terms that some query has; a query's
length is taken over its own terms, a vector's over those coordinates. All
bounds are in doubles with a margin, and prune only what is surely below.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, running_start, scratch_table
from quire.llm.words import coded, slices, words_of

TOP = 10
BUCKET = 1024
FOCUS = 6
#: The longest vectors, searched first; their scores are the thresholds that all tasks start from.
SEED_ROWS = 8192
TEXT_BYTES = 4 << 20
#: Bytes of query text searched for together; more queries are searched in blocks.
BLOCK_BYTES = 4 << 20
MARGIN = 1e-9
NO_ID = np.iinfo(np.int64).max  # the place of a null id among equal scores


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The queries in blocks of about `BLOCK_BYTES` of text, a block at a time."""
    items = queries.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    items = items.where("text is not null").select(
        "*", F.octet_length("text").cast("long").alias("size"), F.xxhash64("item_id", "text").alias("h"))
    sized = running_start(items.withColumn("part", F.pmod("h", F.lit(64))), "part", ["h"], "size", "before")
    sized = scratch_table(sized.select("item_id", "text", F.floor(F.col("before") / BLOCK_BYTES).alias("block")), "queries")
    for (block,) in sorted(sized.select("block").distinct().collect()):
        yield [tuple(r) for r in sized.where(F.col("block") == block).select("item_id", "text").collect()]


def term_vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document: its number of terms, and how
    often it holds each term of `vocabulary` that it has."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                codes, bounds, words = coded(part.column(1))
                known = pc.fill_null(pc.index_in(words, value_set=wanted), -1).to_numpy(zero_copy_only=False)
                term = known[codes].astype(np.int64) if len(codes) else np.zeros(0, np.int64)
                doc = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                at = np.flatnonzero(term >= 0)
                pairs, tfs = np.unique(doc[at] * max(1, len(wanted)) + term[at], return_counts=True)
                of, term = np.divmod(pairs, max(1, len(wanted)))
                offsets = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds), pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])
            pa.default_memory_pool().release_unused()

    return map_arrow(docs, run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(vectors: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, length, terms, xs): a term's share in a document's score per
    unit of its weight; documents without a coordinate are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy(zero_copy_only=False)
            if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
                n = n.astype(object)
            m = 10 + np.asarray(90 * n * n_docs // n_terms, np.int64)
            tfs = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(n)), sizes)
            xs = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[of])
            length = np.sqrt(np.bincount(of, weights=xs.astype(float) ** 2, minlength=len(n)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(length), batch.column(2),
                 pa.ListArray.from_arrays(offsets, pa.array(xs, pa.int64()))], ["doc_id", "length", "terms", "xs"])

    return map_arrow(vectors.where("size(terms) > 0"), run, "doc_id long, length double, terms array<int>, xs array<long>")


class Query:
    """A query's terms, the heaviest first, and its length beyond each."""

    def __init__(self, terms: list[int], weight: np.ndarray):
        order = sorted(terms, key=lambda t: (-weight[t], t))
        self.terms = np.array(order, np.int64)
        self.weights = weight[self.terms] if order else np.zeros(0, np.int64)
        squares = self.weights.astype(float) ** 2
        self.length = math.sqrt(squares.sum())
        self.rest = math.sqrt(squares[FOCUS:].sum())


class Best:
    """The best documents of a query so far: by score, then by id."""

    def __init__(self, threshold: int, top: int):
        self.top, self.seed = top, threshold
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        """No document below it can be among the best; at least 1."""
        own = int(self.score[-1]) if len(self.score) == self.top else 1
        return max(1, self.seed, own)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score))[:self.top]
        self.score, self.id = score[order], ids[order]


class Bucket:
    """Vectors of similar length, by row for scoring and by term for bounds."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, xs: np.ndarray):
        self.ids, self.lengths, self.longest = ids, lengths, float(lengths.max())
        row = np.repeat(np.arange(len(ids)), sizes)
        by_term = np.argsort(terms, kind="stable")
        self.rows, self.xs = row[by_term], xs[by_term]
        self.units = self.xs / lengths[self.rows]
        self.begin = np.searchsorted(terms[by_term], np.arange(int(terms.max()) + 2)).tolist()

    def postings(self, term: int) -> slice:
        return slice(*self.begin[term:term + 2]) if term + 1 < len(self.begin) else slice(0, 0)

    def search(self, query: Query, best: Best) -> None:
        """Add the bucket's documents that may be among the query's best."""
        product, squares = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for term, weight in zip(query.terms[:FOCUS].tolist(), query.weights[:FOCUS].tolist()):
            at = self.postings(term)
            product[self.rows[at]] += weight * self.units[at]
            squares[self.rows[at]] += self.units[at] ** 2
        # the direction's product with the query, at most; then its length
        bound = product + np.sqrt(np.maximum(0.0, 1 - squares) + MARGIN) * query.rest
        left = bound * self.lengths * (1 + MARGIN) >= best.threshold
        if left.any():
            score = np.zeros(len(self.ids), np.int64)
            for term, weight in zip(query.terms.tolist(), query.weights.tolist()):
                at = self.postings(term)
                rows, xs = self.rows[at], self.xs[at]
                kept = left[rows]
                score[rows[kept]] += weight * xs[kept]
            good = np.flatnonzero(score >= best.threshold)
            if len(good):
                best.add(score[good], self.ids[good])


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    """Consecutive rows of (doc_id, length, terms, xs), `BUCKET` at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BUCKET):
            part = batch.slice(lo, BUCKET)
            yield Bucket(pc.fill_null(part.column(0), NO_ID).to_numpy(zero_copy_only=False),
                         part.column(1).to_numpy(zero_copy_only=False),
                         pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False),
                         part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                         part.column(3).flatten().to_numpy(zero_copy_only=False))


def search(ordered: DataFrame, queries: list[Query], seeds: list[int], top: int) -> DataFrame:
    """(query, doc_id, score): the best of each partition of `ordered`, whose
    files hold vectors by falling length."""
    shared = ordered.sparkSession.sparkContext.broadcast((queries, seeds))  # a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, seeds = shared.value
        best = [Best(s, top) for s in seeds]
        lengths = np.array([q.length for q in queries])
        thresholds = np.array([b.threshold for b in best])
        for bucket in buckets(batches):
            for k in np.flatnonzero(lengths * bucket.longest * (1 + MARGIN) >= thresholds).tolist():
                bucket.search(queries[k], best[k])
                thresholds[k] = best[k].threshold
        ids = np.concatenate([b.id for b in best] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), [len(b.id) for b in best]), pa.int32()),
             pa.array(ids, mask=ids == NO_ID),
             pa.array(np.concatenate([b.score for b in best] or [np.zeros(0, np.int64)]))], ["query", "doc_id", "score"])

    return map_arrow(ordered, run, "query int, doc_id long, score long")


def first(found: DataFrame, top: int) -> DataFrame:
    """The best `top` rows of each query, numbered."""
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def ranked(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each query with a score above 0.

    Equal scores go by ascending doc_id, null ids last; repeated rows are
    ranked one by one, as are repeated queries. A null or empty text has no
    terms: such a document is never found, such a query finds none. Empty
    tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = None
    for block in query_blocks(queries, item_col, item_text_col):
        wanted = [(item, set(words_of(text))) for item, text in block]
        vocabulary = sorted(set().union(*(words for _, words in wanted)))
        number = {w: k for k, w in enumerate(vocabulary)}
        vectors = scratch_table(term_vectors(rows, pa.array(vocabulary, pa.large_binary())), "term-vectors")
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's terms
            df[term] = n
        weight = weights(n_docs, df)
        plan = [Query([number[w] for w in words], weight) for _, words in wanted]
        long = impacts(vectors, n_docs, max(1, n_terms))
        ordered = scratch_table(long.repartitionByRange(F.desc("length"), "doc_id")
                                .sortWithinPartitions(F.desc("length"), "doc_id"), "norm-order")
        share = min(1.0, SEED_ROWS / max(1, n_docs))
        (least,) = ordered.agg(F.percentile_approx("length", 1 - share)).first()
        longest = ordered.where(F.col("length") >= F.lit(least or 0.0))
        seeds = [0] * len(plan)
        for k, score in (first(search(longest, plan, seeds, top), top).where(F.col("rank") == top)
                         .select("query", "score").collect()):  # a row per query of the block
            seeds[k] = score
        best = first(search(ordered, plan, seeds, top), top)
        ids = spark.createDataFrame([(k, item) for k, (item, _) in enumerate(wanted)], "query int, item_id long")
        part = best.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
