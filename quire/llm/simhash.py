"""SimHash near-duplicate groups with pivot distance tables.

A document's fingerprint is the bitwise majority of its shingles' 64-bit
hashes. Distinct fingerprints meet where enough of their bit blocks agree:
with `m` blocks and at most `d` differing bits, at least `m - d` blocks are
equal, so a row per choice of `m - d` blocks loses no pair. Among the
fingerprints that meet, a table of Hamming distances to reference
fingerprints (pivots) discards pairs whose coordinates differ by more than
`d` in any column (triangle inequality), and an exact bit count verifies
the survivors.

Exact copies collapse to one fingerprint before any comparison. Within a
meeting group only the edges of a spanning forest leave the task, so a group
of thousands of near copies yields a number of edges linear in its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import components, map_arrow, merge, scratch_table

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
N_PIVOTS = 16
SHINGLES_PER_BLOCK = 100_000
SMALL_GROUP = 64
PAIRS_AT_ONCE = 1_000_000


def shingle_hashes(text: str | None, words_per_shingle: int) -> list[int]:
    """XXH64 of each word shingle of the text, repeats included."""
    words = text.encode().lower().split() if text else []
    if not words:
        return []
    if len(words) <= words_per_shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    digest = xxhash.xxh64_intdigest
    shifted = [words[i:] for i in range(words_per_shingle)]
    return [digest(s, SEED) for s in map(b" ".join, zip(*shifted))]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes; a run of none gives zero."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        wins = (2 * counts > sizes[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(wins, axis=1, bitorder="little").view("<u8").ravel()
    return out


def text_fingerprints(texts: list[str | None], words_per_shingle: int) -> np.ndarray:
    parts, hashes, sizes = [], [], []

    def flush() -> None:
        parts.append(majority(np.array(hashes, np.uint64), np.array(sizes, np.int64)))
        hashes.clear()
        sizes.clear()

    for text in texts:
        own = shingle_hashes(text, words_per_shingle)
        hashes.extend(own)
        sizes.append(len(own))
        if len(hashes) >= SHINGLES_PER_BLOCK:
            flush()
    flush()
    return np.concatenate(parts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = text_fingerprints(batch.column(1).to_pylist(), words_per_shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, run, "doc_id long, fp long")


# --- candidate groups -------------------------------------------------------

def block_masks(n: int, max_bits: int) -> list[int]:
    """Bit masks of every choice of m - d blocks out of m, with m the least
    number of blocks whose keys are some bits longer than log2(n). Any m is
    exact; m only sets how many unrelated fingerprints share a key."""
    m = max_bits + 1
    while m < max_bits + 7 and 64 * (m - max_bits) / m < np.log2(max(n, 2)) + 3:
        m += 1
    cuts = [round(64 * i / m) for i in range(m + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, m - max_bits)]


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(n)], np.uint64)


def pivot_table(fp: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each reference, by column."""
    return np.bitwise_count(fp[None, :] ^ refs[:, None]).astype(np.int8)


def survivors(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray,
              max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (i, j), those no pivot discards and the bit count verifies."""
    for column in table:
        near = np.abs(column[i] - column[j]) <= max_bits
        i, j = i[near], j[near]
        if not len(i):
            return i, j
    near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
    return i[near], j[near]


def group_labels(key: np.ndarray, fp: np.ndarray, max_bits: int, refs: np.ndarray) -> np.ndarray:
    """For rows sorted by key: the least row linked to each row within its key.

    Small groups are compared by shifting all rows at once. A large group is
    ordered by its first pivot distance, so each block of rows meets only the
    window of rows whose distance is within `max_bits`.
    """
    n = len(key)
    labels = np.arange(n)
    bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(bounds)
    rows = np.repeat((sizes > 1) & (sizes <= SMALL_GROUP), sizes)
    table = pivot_table(fp, refs)
    room = np.repeat(bounds[1:], sizes) - np.arange(n)  # rows from here to the group's end
    for shift in range(1, min(SMALL_GROUP, int(sizes.max(initial=1)))):
        i = np.flatnonzero(rows & (room > shift))
        if not len(i):
            break
        merge(labels, *survivors(fp, table, i, i + shift, max_bits))
    for g in np.flatnonzero(sizes > SMALL_GROUP):
        order = bounds[g] + np.argsort(table[0, bounds[g]:bounds[g + 1]], kind="stable")
        first = table[0, order].astype(np.int64)
        ends = np.searchsorted(first, first + max_bits, side="right")
        lo = 0
        while lo < len(order):
            hi = lo + max(1, min(256, PAIRS_AT_ONCE // int(ends[lo] - lo)))
            width = np.arange(lo, ends[min(hi, len(order)) - 1])
            left = np.repeat(np.arange(lo, min(hi, len(order))), len(width))
            right = np.tile(width, min(hi, len(order)) - lo)
            ahead = right > left
            merge(labels, *survivors(fp, table, order[left[ahead]], order[right[ahead]], max_bits))
            lo = hi
    return labels


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS, n_pivots: int = N_PIVOTS) -> DataFrame:
    """(a, b): edges between the nodes of distinct fingerprints (fp, node) whose
    components are those of all pairs with at most `max_bits` differing bits."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(n, max_bits)]
    keys = F.array(*[F.xxhash64(F.lit(c), F.col("fp").bitwiseAND(F.lit(m))) for c, m in enumerate(signed)])
    keyed = distinct.select(F.explode(keys).alias("key"), "fp", "node")
    refs = pivots(n_pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * 3
        for batch in batches:
            cols = [np.concatenate([r, c.to_numpy()]) for r, c in zip(rest, batch.columns)]
            # the last key's group may go on in the next batch
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            rest = [c[cut:] for c in cols]
            if cut:
                yield edges(*[c[:cut] for c in cols])
        if len(rest[0]):
            yield edges(*rest)

    def edges(key: np.ndarray, fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        labels = group_labels(key, fp.view(np.uint64), max_bits, refs)
        own = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.RecordBatch.from_arrays([pa.array(node[labels[own]]), pa.array(node[own])], ["a", "b"])

    return map_arrow(keyed.repartition("key").sortWithinPartitions("key", "fp"), run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of `docs`.

    component_id is the smallest doc_id reachable over links of at most
    `max_bits` differing bits. Null and wordless texts have fingerprint zero
    and link like any other. Rows that share a doc_id are one document:
    their fingerprints' components are joined. Rows with a null doc_id get
    their fingerprint's component, or null when no other row has one.
    Repeated rows come back as often as they went in. An empty table gives
    no rows. Other columns are not read.
    """
    marked = scratch_table(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    distinct = scratch_table(marked.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"),
                             "distinct")
    shared_ids = (marked.where("doc_id is not null").groupBy("doc_id")
                  .agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("doc_id"))
    same_doc = (marked.join(shared_ids, "doc_id", "left_semi").join(distinct, "fp")
                .select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    edges = links(distinct, distinct.count(), max_bits).unionAll(same_doc)
    roots = components(edges)
    classes = (distinct.join(roots, "node", "left")
               .select(F.col("fp").alias("class_fp"), F.coalesce("root", "node").alias("component_id")))
    return (marked.join(classes, marked.fp == classes.class_fp, "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
