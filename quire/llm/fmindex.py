"""Benchmark decontamination with an FM-index per shard of the corpus.

A shard is some megabytes of whole documents as word numbers, each document
closed by an end mark. Its suffixes are sorted; the word before each suffix,
in that order, is the Burrows-Wheeler transform, kept as a wavelet matrix of
bit rows with rank counts; suffix positions are kept for every `STEP`-th word
of a document. The index is a table with a row per shard, written once and
searched by any number of benchmarks.

A phrase is searched backwards: each word narrows the range of suffixes by
two ranks, all phrases of a benchmark side by side. The occurrences left are
walked back to a sampled position. Their words are the removal spans, merged
per document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, numbered, place, running_start, scratch_path, scratch_table
from quire.llm.words import coded, slices, words_of

WINDOW = 10
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SHARD_BYTES = 4 << 20
STEP = 16
#: Bytes of benchmark text searched for together; a larger benchmark is searched in blocks.
BLOCK_BYTES = 16 << 20
OCCURRENCES_AT_ONCE = 1 << 18
INDEX = ("shard long, n_docs int, n_words long, doc_ids binary, null_ids binary, bounds binary, words binary, "
         "word_ends binary, bits binary, counts binary, sampled binary, positions binary")


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence whose last code occurs once.

    As many codes as fit in 63 bits are sorted first; then only suffixes that
    still tie are sorted again, by the ranks of what follows, twice as far each time.
    """
    n = len(codes)
    width = max(1, int(codes.max()).bit_length())
    reach = min(63 // width, 8)
    key = np.zeros(n, np.int64)
    for k in range(reach):
        key <<= width
        key[:max(0, n - k)] |= codes[k:]
    order = np.argsort(key)
    first = np.ones(n, bool)
    sorted_key = key[order]
    np.not_equal(sorted_key[1:], sorted_key[:-1], out=first[1:])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    slots = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(slots):
        tied = order[slots]
        key = rank[tied] * (n + 1) + rank[np.minimum(tied + reach, n)] + 1
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[slots] = tied
        first = np.ones(len(slots), bool)
        np.not_equal(key[1:], key[:-1], out=first[1:])
        rank[tied] = np.maximum.accumulate(np.where(first, slots, 0))
        slots = slots[~(first & np.append(first[1:], True))]
        reach *= 2
    return order


class Wavelet:
    """Rank and access over a sequence of symbols, a row of bits per level."""

    def __init__(self, n: int, levels: int, bits: np.ndarray, counts: np.ndarray):
        self.n, self.levels, self.bits, self.counts = n, levels, bits.reshape(levels, -1), counts.reshape(levels, -1)
        self.zeros = n - np.array([self._ones(k, np.array([n]))[0] for k in range(levels)], np.int64)

    @classmethod
    def build(cls, symbols: np.ndarray, largest: int) -> Wavelet:
        n, levels = len(symbols), max(1, largest.bit_length())
        bits = np.zeros((levels, n // 64 + 1), np.uint64)
        for level in range(levels):
            bit = (symbols >> (levels - 1 - level) & 1).astype(bool)
            bits[level].view(np.uint8)[:-(-n // 8)] = np.packbits(bit, bitorder="little")
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        counts = np.zeros(bits.shape, np.uint32)
        np.cumsum(np.bitwise_count(bits[:, :-1]), axis=1, dtype=np.uint32, out=counts[:, 1:])
        return cls(n, levels, bits, counts)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.bits[level][word] & below).astype(np.int64)

    def follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where `at` comes to in the last level on the path of `symbol`: the
        symbol's begin there plus its rank before `at`."""
        for level in range(self.levels):
            ones = self._ones(level, at)
            set_ = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            at = np.where(set_, self.zeros[level] + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, place in the last level) of each position."""
        symbol = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            ones = self._ones(level, at)
            set_ = self._ones(level, at + 1) > ones
            symbol = symbol << 1 | set_
            at = np.where(set_, self.zeros[level] + ones, at - ones)
        return symbol, at


class Shard:
    """The FM-index of some documents; symbol 0 is the end mark, word k of the
    shard's word list is symbol k + 1."""

    def __init__(self, bounds: np.ndarray, n_symbols: int, transform: Wavelet, sampled: Wavelet, positions: np.ndarray):
        self.bounds, self.transform, self.sampled, self.positions = bounds, transform, sampled, positions
        symbols = np.arange(n_symbols)
        mirrored = np.zeros(n_symbols, np.int64)  # the last level has the symbols in order of their mirrored bits
        for k in range(transform.levels):
            mirrored = mirrored << 1 | symbols >> k & 1
        # how often each symbol occurs: where its path ends less where it begins
        self.begin = transform.follow(symbols, np.zeros(n_symbols, np.int64))
        times = transform.follow(symbols, np.full(n_symbols, transform.n)) - self.begin
        self.smaller = np.cumsum(times) - times

    @classmethod
    def build(cls, codes: np.ndarray, bounds: np.ndarray, n_words: int) -> Shard:
        docs = len(bounds) - 1
        starts = bounds[:-1] + np.arange(docs)  # every document has an end mark of its own
        ends = bounds[1:] + np.arange(docs)
        symbols = np.zeros(len(codes) + docs, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[ends] = False
        symbols[inside] = codes + 1
        distinct = symbols + docs - 1
        distinct[ends] = np.arange(docs)
        order = suffix_order(distinct)
        narrow = symbols.astype(np.uint16 if n_words < 1 << 16 else np.uint32)
        within = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, len(symbols))))
        mark = (within % STEP == 0)[order]
        return cls(bounds, n_words + 1, Wavelet.build(narrow[order - 1], n_words), Wavelet.build(mark.astype(np.uint8), 1),
                   order[mark].astype(np.uint32))

    def back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Suffixes smaller than symbol + (suffix at rank `at`)."""
        return self.smaller[symbol] + self.transform.follow(symbol, at) - self.begin[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high): the suffix range of each phrase that occurs.
        Phrases are rows of symbols, filled from the left; below 1 is no word."""
        own = np.arange(phrases.shape[1]) < lengths[:, None]
        live = np.flatnonzero((lengths > 0) & ((phrases > 0) | ~own).all(axis=1))
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.transform.n)
        done = []
        for k in range(phrases.shape[1]):
            over = lengths[live] == k
            done.append((live[over], low[over], high[over]))
            live, low, high = live[~over], low[~over], high[~over]
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - k].astype(np.int64)
            both = self.back(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = both[:len(live)], both[len(live):]
            some = low < high
            live, low, high = live[some], low[some], high[some]
        done.append((live, low, high))
        return tuple(np.concatenate([d[k] for d in done]) for k in range(3))

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to a sampled one. Every
        document's first word is sampled, so no walk leaves its document."""
        found = np.zeros(len(at), np.int64)
        open_, steps = np.arange(len(at)), 0
        while len(open_):
            here = at[open_]
            known = self.sampled._ones(0, here + 1) > (rank := self.sampled._ones(0, here))
            found[open_[known]] = self.positions[rank[known]].astype(np.int64) + steps
            open_, here = open_[~known], here[~known]
            symbol, end = self.transform.access(here)
            at[open_] = self.smaller[symbol] + end - self.begin[symbol]
            steps += 1
        return found

    def occurrences(self, phrases: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(phrase, document, first word in the document), some at a time."""
        phrase, low, high = self.search(phrases, lengths)
        starts = self.bounds[:-1] + np.arange(len(self.bounds) - 1)
        ends = np.cumsum(high - low)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, OCCURRENCES_AT_ONCE):
            number = np.arange(lo, min(lo + OCCURRENCES_AT_ONCE, int(ends[-1])))
            of = np.searchsorted(ends, number, "right")
            position = self.locate(low[of] + number - (ends[of] - (high[of] - low[of])))
            doc = np.searchsorted(starts, position, "right") - 1
            yield phrase[of], doc, position - starts[doc]


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The corpus as a table of shards (`INDEX`), each of whole documents with
    about `SHARD_BYTES` of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, 1, SHARD_BYTES):
                codes, bounds, words = coded(part.column(1))
                shard = Shard.build(codes, bounds, len(words))
                ids = part.column(0)
                ends = np.asarray(pc.binary_length(words)).cumsum()
                raw = {"doc_ids": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8"),
                       "null_ids": ids.is_null().to_numpy(zero_copy_only=False).astype("u1"),
                       "bounds": bounds.astype("<i8"), "words": b"".join(words.to_pylist()),
                       "word_ends": ends.astype("<i8"), "bits": shard.transform.bits.astype("<u8"),
                       "counts": shard.transform.counts.astype("<u4"), "sampled": shard.sampled.bits.astype("<u8"),
                       "positions": shard.positions.astype("<u4")}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([part.num_rows], pa.int32()), pa.array([len(codes)], pa.int64()),
                     *(pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in raw.values())],
                    ["shard", "n_docs", "n_words", *raw])
                number += 1
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, run, INDEX)


def opened(row: dict) -> tuple[Shard, pa.Array]:
    """The shard of an index row and its word list."""
    n = row["n_words"] + row["n_docs"]
    counts = np.frombuffer(row["counts"], "<u4")
    bits = np.frombuffer(row["bits"], "<u8")
    levels = len(bits) // (n // 64 + 1)
    sampled = np.frombuffer(row["sampled"], "<u8")
    rank = np.zeros(len(sampled), np.uint32)
    np.cumsum(np.bitwise_count(sampled[:-1]), dtype=np.uint32, out=rank[1:])
    ends = np.concatenate([[0], np.frombuffer(row["word_ends"], "<i8")])
    words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1,
                                  [None, pa.py_buffer(ends), pa.py_buffer(row["words"])])
    return Shard(np.frombuffer(row["bounds"], "<i8"), len(words) + 1, Wavelet(n, levels, bits, counts),
                 Wavelet(n, 1, sampled, rank), np.frombuffer(row["positions"], "<u4")), words


class Phrases:
    """The distinct windows of some items' texts, and the items of each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            codes = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
            width = min(window, len(codes))
            for k in range(len(codes) - width + 1 if codes else 0):
                windows.setdefault(tuple(codes[k:k + width]), set()).add(item)
        self.words = pa.array(list(vocabulary), pa.large_binary())
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.codes = np.full((len(windows), window), -1, np.int64)
        for row, w in enumerate(windows):
            self.codes[row, :len(w)] = w
        self.items = [sorted(found) for found in windows.values()]

    def symbols(self, words: pa.Array) -> np.ndarray:
        """The windows in a shard's symbols, 0 for a word it doesn't have."""
        at = pc.fill_null(pc.index_in(self.words, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.append(at + 1, 0)[self.codes]


def search(index: DataFrame, phrases: Phrases) -> DataFrame:
    """(shard, place, spans, items) of the documents with an occurrence: merged
    spans of word places [start, end), and the numbers of the items found."""
    shared = index.sparkSession.sparkContext.broadcast(phrases)  # BLOCK_BYTES of text at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                shard, words = opened(row)
                step = np.zeros(row["n_words"] + 1, np.int64)
                hits: dict[int, set[int]] = {}
                for phrase, doc, first in shard.occurrences(wanted.symbols(words), wanted.lengths):
                    start = shard.bounds[doc] + first
                    np.add.at(step, start, 1)
                    np.add.at(step, start + wanted.lengths[phrase], -1)
                    for d, p in np.unique(np.stack([doc, phrase], axis=1), axis=0).tolist():
                        hits.setdefault(d, set()).update(wanted.items[p])
                inside = (np.cumsum(step)[:-1] > 0).astype(np.int8)
                spans = []
                for d in hits:
                    lo, hi = shard.bounds[d], shard.bounds[d + 1]
                    edge = np.diff(inside[lo:hi], prepend=0, append=0)
                    spans.append([{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge > 0).tolist(),
                                                                         np.flatnonzero(edge < 0).tolist())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(hits), pa.int64()), pa.array(list(hits), pa.int32()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array([sorted(x) for x in hits.values()], pa.list_(pa.int64()))],
                    ["shard", "place", "spans", "items"])

    return map_arrow(index.drop("doc_ids", "null_ids"), run,
                     "shard long, place int, spans array<struct<start: long, end: long>>, items array<long>")


def listing(index: DataFrame) -> DataFrame:
    """(shard, place, doc_id, n_words) of every document of an index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, ids, null, bounds in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), shard)), pa.array(np.arange(len(ids), dtype=np.int32)),
                     pa.array(ids, mask=np.frombuffer(null, "u1").astype(bool)),
                     pa.array(np.diff(np.frombuffer(bounds, "<i8")))], ["shard", "place", "doc_id", "n_words"])

    return map_arrow(index.select("shard", "doc_ids", "null_ids", "bounds"), run,
                     "shard long, place int, doc_id long, n_words long")


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about `BLOCK_BYTES` of text, a block at a time."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    items = items.where("item_id is not null and text is not null").select(
        "*", F.octet_length("text").cast("long").alias("size"), F.xxhash64("item_id", "text").alias("h"))
    sized = running_start(items.withColumn("part", F.pmod("h", F.lit(64))), "part", ["h", "item_id"], "size", "before")
    sized = scratch_table(sized.select("item_id", "text", F.floor(F.col("before") / BLOCK_BYTES).alias("block")), "items")
    for (block,) in sorted(sized.select("block").distinct().collect()):
        yield [tuple(r) for r in sized.where(F.col("block") == block).select("item_id", "text").collect()]


def contamination(index: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, shard, place) per document of the index.

    spans are the merged word places [start, end) inside occurrences of a
    window: `window` consecutive words of an item, or all words of a shorter
    item. items are the ids of the items found, in order. Items with a null
    id, a null text or no word take no part; rows of one item id are one item.
    """
    empty = "shard long, place int, spans array<struct<start: long, end: long>>, items array<long>"
    found = None
    for block in benchmark_blocks(benchmark, id_col, text_col):
        part = search(index, Phrases(block, window))
        found = part if found is None else found.unionAll(part)
    found = index.sparkSession.createDataFrame([], empty) if found is None else found
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.array().cast("array<struct<start: long, end: long>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.get(acc, F.size(acc) - 1)["start"].alias("start"),
                F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))
    hits = found.groupBy("shard", "place").agg(
        merged.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return listing(index).join(hits, ["shard", "place"], "left").select(
        "doc_id", "n_words", F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"), "shard", "place")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """`contamination` of `docs`, with the index written to the shared folder.

    A null text has no words. Repeated rows and rows with a null id are
    searched one by one. An empty table gives no rows; other columns are not read.
    """
    path = scratch_path(docs.sparkSession, "fm-index")
    index(docs, id_col, text_col).write.parquet(path)
    shards = docs.sparkSession.read.schema(INDEX).parquet(path)
    return contamination(shards, benchmark, item_col, item_text_col, window)


def digest(found: DataFrame) -> DataFrame:
    """The verdict per document, with its items as a checksum."""
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def cleaned(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """`docs` with the spans removed from their texts, other columns as they are.

    A span's words go with what stands between them and up to the next word;
    texts without a span stay as they are, blanks included. Documents are told
    apart by id and text, so repeated rows are cleaned alike.
    """
    rows = numbered(docs)
    doc_id, text = place(docs, id_col), place(docs, text_col)
    keyed = rows.select("*", F.xxhash64(doc_id, text).alias("_h"), F.xxhash64(text, doc_id).alias("_k"))
    # the spans of each distinct (id, text), found once
    distinct = keyed.select("_h", "_k", text).dropDuplicates(["_h", "_k"])
    held = scratch_table(distinct.select("_h", "_k", F.col(text).alias("text"), F.monotonically_increasing_id().alias("n")),
                         "distinct-texts")
    found = decontaminate(held, benchmark, "n", "text", **how).where("n_hit > 0").select(
        F.col("doc_id").alias("n"), "spans")
    found = held.select("n", "_h", "_k").join(found, "n").select("_h", "_k", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = [without(t, s) if s else t for t, s in zip(batch.column(at).to_pylist(), batch.column("spans").to_pylist())]
            columns = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    joined = keyed.join(found, ["_h", "_k"], "left").select(*rows.columns, "spans")
    return map_arrow(joined, run, rows.schema).toDF(*docs.columns)


def without(text: str, spans: list[dict]) -> str:
    """A text less the words of each span and what follows up to the next word."""
    raw = text.encode()
    begin = [m.start() for m in WORD.finditer(raw)] + [len(raw)]
    kept, at = [], 0
    for span in spans:
        kept.append(raw[at:begin[span["start"]]])
        at = begin[span["end"]]
    return b"".join([*kept, raw[at:]]).decode()
