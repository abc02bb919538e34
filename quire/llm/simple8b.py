"""Token-id files in Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits of equally wide fields; the
selector says how many ids of which width. A field of all ones is an escape:
its id stands in the segment's escape list. Ids are coded in blocks of
`BLOCK` ids; a segment holds whole documents, its blocks' words and escapes,
and the offset of each block in both, so any block decodes alone and all
blocks decode as array operations.

Segment layout, little-endian: 6 u32 header (magic, documents, ids, blocks,
words, escapes); per document i64 id, u32 length and u8 null flag; per block
+ 1 u32 word offset and u32 escape offset; u64 words; u32 escapes. Segments
are stored as rows of a Parquet table, which reaches every store Spark reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, running_start, scratch_path
from quire.llm.tokens import encoder, tokenizer_path

MAGIC = 0x31423853
BLOCK = 1024
SEGMENT_IDS = 1 << 18
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
# Ids per word and bits per id, by selector.
SELECTORS = [(1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7),
             (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1)]
COUNTS = np.array([n for n, _ in SELECTORS])


def choose(table: np.ndarray) -> np.ndarray:
    """Selector at every position of the blocks (rows of `table`, padded by 60
    zeros): the fewest bytes of words and escapes per id. Widths that hold
    less than a quarter of the ids are not tried, nor are those wider than
    the narrowest that holds them all."""
    size = table.shape[1] - 60
    best = np.full((len(table), size), 65535, np.uint16)
    chosen = np.zeros((len(table), size), np.uint8)
    top = int(table.max(initial=0))
    if top < 1 << 16:
        table = table.astype(np.uint16)
    last = max(s for s, (_, width) in enumerate(SELECTORS) if top < (1 << width) - 1)
    for s, (n, width) in enumerate(SELECTORS):
        if s < last:
            continue
        over = table >= (1 << width) - 1 if top >= (1 << width) - 1 else np.zeros(table.shape, bool)
        if s > last and np.count_nonzero(over[:, :size]) > 0.75 * over[:, :size].size:
            break
        wide = np.zeros((len(table), table.shape[1] + 1), np.uint8)
        np.cumsum(over, axis=1, dtype=np.uint8, out=wide[:, 1:])
        cost = np.minimum((8 + 4 * np.arange(256)) * 840 // n, 65534).astype(np.uint16)
        cost = cost[wide[:, n:n + size] - wide[:, :size]]  # escapes: modulo 256, at most 60
        better = cost < best
        np.copyto(best, cost, where=better)
        chosen[better] = s
    return chosen


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, escapes, word offset of each block, escape offset of each block)."""
    n_blocks = -(-len(ids) // BLOCK)
    table = np.zeros((n_blocks, BLOCK + 60), np.uint32)
    padded = np.zeros(n_blocks * BLOCK, np.uint32)
    padded[:len(ids)] = ids
    table[:, :BLOCK] = padded.reshape(n_blocks, BLOCK)
    sizes = np.full(n_blocks, BLOCK)
    if n_blocks:
        sizes[-1] = len(ids) - (n_blocks - 1) * BLOCK
    chosen = choose(table)
    # walk all blocks side by side, a word each per step
    lane, at, steps = np.arange(n_blocks), np.zeros(n_blocks, np.int64), []
    while len(lane):
        selector = chosen[lane, at]
        steps.append((lane, at, selector))
        after = at + COUNTS[selector]
        going = after < sizes[lane]
        lane, at = lane[going], after[going]
    lane, at, selector = (np.concatenate([s[k] for s in steps]) if steps else np.zeros(0, np.int64) for k in range(3))
    order = np.lexsort((at, lane))
    lane, at, selector = lane[order], at[order], selector[order].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    flat, base = table.ravel(), lane * table.shape[1] + at
    where, values = [], []
    for s, (n, width) in enumerate(SELECTORS):
        rows = np.flatnonzero(selector == s)
        if not len(rows):
            continue
        fields = flat[base[rows][:, None] + np.arange(n)].astype(np.uint64)
        escape = fields >= (1 << width) - 1
        if escape.any():
            r, k = np.nonzero(escape)
            where.append(rows[r] * 64 + k)
            values.append(fields[escape])
            fields[escape] = (1 << width) - 1
        words[rows] |= np.bitwise_or.reduce(fields << (np.uint64(width) * np.arange(n, dtype=np.uint64)), axis=1)
    where = np.concatenate(where) if where else np.zeros(0, np.int64)
    values = np.concatenate(values) if values else np.zeros(0, np.uint64)
    order = np.argsort(where)
    blocks = np.arange(n_blocks + 1)
    return (words, values[order].astype(np.uint32), np.searchsorted(lane, blocks),
            np.searchsorted(lane[where[order] // 64], blocks))


def decode(words: np.ndarray, escapes: np.ndarray, word_at: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks, the last of which may be short."""
    out = np.zeros(n_ids, np.uint32)
    selector = (words >> np.uint64(60)).astype(np.int64)
    block = np.repeat(np.arange(len(word_at) - 1), np.diff(word_at))
    before = np.concatenate([[0], np.cumsum(COUNTS[selector])])
    base = block * BLOCK + before[:-1] - before[word_at[:-1]][block]
    limit = np.minimum((block + 1) * BLOCK, n_ids)
    escaped = []
    for s, (n, width) in enumerate(SELECTORS):
        rows = np.flatnonzero(selector == s)
        if not len(rows):
            continue
        at = base[rows][:, None] + np.arange(n)
        mask = np.uint64((1 << width) - 1)
        fields = (words[rows][:, None] >> (np.uint64(width) * np.arange(n, dtype=np.uint64))) & mask
        real = at < limit[rows][:, None]
        out[at[real]] = fields[real].astype(np.uint32)
        escaped.append(at[real & (fields == mask)])
    if escaped:
        out[np.sort(np.concatenate(escaped))] = escapes
    return out


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    words, escapes, word_at, escape_at = encode(ids)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(word_at) - 1, len(words), len(escapes)], "<u4")
    return b"".join([
        head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(lengths, "<u4").tobytes(),
        bytes(d is None for d in doc_ids), word_at.astype("<u4").tobytes(), escape_at.astype("<u4").tobytes(),
        words.astype("<u8").tobytes(), escapes.astype("<u4").tobytes()])


class Segment:
    """A parsed segment: document table, and ids decoded whole or by block."""

    def __init__(self, data: bytes):
        magic, n_docs, self.n_ids, n_blocks, n_words, n_escapes = np.frombuffer(data, "<u4", 6).tolist()
        if magic != MAGIC:
            raise ValueError("not a token-id segment")
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        self.doc_ids, self.lengths, self.null = take("<i8", n_docs), take("<u4", n_docs), take("u1", n_docs)
        self.word_at = take("<u4", n_blocks + 1).astype(np.int64)
        self.escape_at = take("<u4", n_blocks + 1).astype(np.int64)
        self.words, self.escapes = take("<u8", n_words), take("<u4", n_escapes)

    def ids(self) -> np.ndarray:
        return decode(self.words, self.escapes, self.word_at, self.n_ids)

    def block(self, k: int) -> np.ndarray:
        lo, hi = self.word_at[k], self.word_at[k + 1]
        return decode(self.words[lo:hi], self.escapes[self.escape_at[k]:self.escape_at[k + 1]],
                      np.array([0, hi - lo]), min(BLOCK, self.n_ids - k * BLOCK))


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, tokenizer: str = TOKENIZER) -> None:
    """Tokenise the documents and write their ids as segments in ascending
    doc_id order: (part, segment, n_docs, n_ids, data), parts in range order.

    A null text is empty (the end id alone). Null ids come first. Rows with
    equal ids are all written, ordered by a hash of their text.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer_path(tokenizer)).encode
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, pieces, size = [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4")
            data = pack_segment(doc_ids, [len(p) // 4 for p in pieces], ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())],
                ["part", "segment", "n_docs", "n_ids", "data"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_texts(batch.column(1))):
                doc_ids.append(doc_id)
                pieces.append(ids + end)
                size += len(pieces[-1]) // 4
                if size >= SEGMENT_IDS:
                    yield segment()
                    number, size = number + 1, 0
                    doc_ids.clear()
                    pieces.clear()
        if doc_ids:
            yield segment()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    map_arrow(ordered, run, "part int, segment int, n_docs long, n_ids long, data binary").write.parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) per document of the files;
    start counts the ids of all documents before it."""
    schema = "part int, segment int, n_docs long, n_ids long, data binary"
    files = spark.read.schema(schema).parquet(path)
    starts = running_start(files.select("part", "segment", "n_ids"), "part", ["segment"], "n_ids", "segment_start")
    names = ["part", "segment", "doc_id", "n_before", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*(c.to_pylist() for c in batch.columns)):
                found = Segment(data)
                raw = found.ids().astype("<u4").tobytes()
                n = len(found.lengths)
                ends = np.cumsum(found.lengths, dtype=np.int64)
                begins = ends - found.lengths
                cut = [raw[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                cols = [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int32)),
                        pa.array(found.doc_ids.astype(np.int64), mask=found.null.astype(bool)), pa.array(begins),
                        pa.array(found.lengths.astype(np.int64)), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(cut, pa.binary())] * with_ids, names)

    rows = map_arrow(files.select("part", "segment", "data"), run,
                     "part int, segment int, doc_id long, n_before long, n_tokens long, ids_crc32 long"
                     + ", ids binary" * with_ids)
    return (rows.join(starts.select("part", "segment", "segment_start"), ["part", "segment"])
            .select("doc_id", (F.col("segment_start") + F.col("n_before")).alias("start"),
                    "n_tokens", "ids_crc32", *["ids"] * with_ids))


def round_trip(docs: DataFrame, **how: str) -> DataFrame:
    """Write the documents' ids to the shared folder and read the files back.

    An empty table gives no rows; other columns are not read.
    """
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, **how)
    return read_ids(docs.sparkSession, path)
