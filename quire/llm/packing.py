"""Packing by power-of-two decomposition.

Each document's ids, closed by an end id, are cut into as many pieces of the
longest length as fit, and the rest into pieces whose lengths are the powers
of two in its binary form. Every piece is a sequence of its own, so no
sequence crosses documents, none needs padding, and pieces of equal length
form a bucket. One pass over the documents, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, scratch_table
from quire.llm.tokens import encoder, tokenizer_path

MAX_LEN = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
SEQUENCES_PER_TASK_BITS = 40
DOCS_AT_ONCE = 512


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of a document's pieces, longest first; max_len is a power of two."""
    full, rest = divmod(n, max_len)
    return [max_len] * full + [1 << b for b in reversed(range(max_len.bit_length() - 1)) if rest >> b & 1]


def has_files(docs: DataFrame) -> bool:
    """Whether `docs` is a scan of files, whose rows know their places."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         end_id: int = END_ID, tokenizer: str = TOKENIZER, places: bool = False) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, bucket, ids), a row per piece.

    ids holds the piece's ids as little-endian unsigned 32-bit bytes; start is
    the number of the document's ids before it; bucket is log2(length). A
    sequence is one piece, so offset is 0. sequence_id is the task's number
    followed by a running number, unique over the table. With `places`, and if
    `docs` is a scan of files, the pieces also have file and row, the place of
    their document (see `in_file_order`). A null or empty text is the end id alone. Repeated rows and rows with a null doc_id are packed
    like any other. An empty table gives no rows. Other columns are not read.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.array([end_id], "<u4").tobytes()
    order = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    order = order if places and has_files(docs) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path(tokenizer)).encode
        sequence = TaskContext.get().partitionId() << SEQUENCES_PER_TASK_BITS
        for batch in batches:
            found = encode(batch.column(1))
            for lo in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(lo, DOCS_AT_ONCE)
                rows, starts, lengths, totals, pieces, numbers = [], [], [], [], [], []
                for row in range(part.num_rows):
                    ids = next(found) + end
                    start, total = 0, len(ids) // 4
                    cuts = piece_lengths(total, max_len)
                    numbers.extend(range(sequence, sequence + len(cuts)))
                    sequence += len(cuts)
                    for length in cuts:
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length)
                        totals.append(total)
                        pieces.append(ids[4 * start:4 * (start + length)])
                        start += length
                n, at = len(rows), pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(totals, pa.int64()),
                     pa.array(numbers, pa.int64()), pa.array(np.zeros(n, np.int64)),
                     pa.array([x.bit_length() - 1 for x in lengths], pa.int32()), pa.array(pieces, pa.binary()),
                     *(part.column(k).take(at) for k in range(2, part.num_columns))],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "bucket", "ids",
                     *part.schema.names[2:]])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *order)
    return map_arrow(rows, run, "doc_id long, start long, length long, doc_tokens long, "
                                "sequence_id long, offset long, bucket int, ids binary"
                                + ", file string, row long" * bool(order))


def in_file_order(pieces: DataFrame) -> DataFrame:
    """Pieces of `pack` with places, their sequences numbered from 0 without
    holes in the order in which the documents' rows were written, whatever
    tasks read them: by the file's numbers, part and file of the part, then by
    its path, the row's place in it, and the piece's in the document. Pieces
    without places keep their numbers.

    The pieces are written once. Each file's number of pieces is counted and
    summed over the files before it (a row per file), and its pieces are
    numbered among themselves, so a window holds one file's pieces, or one row
    per file, and no file's name reaches the driver.
    """
    if "file" not in pieces.columns:
        return pieces
    held = scratch_table(pieces, "pieces")
    number = lambda pattern: F.nullif(F.regexp_extract(F.regexp_extract("file", "[^/]*$", 0), pattern, 1), F.lit(""))
    part = F.coalesce(number(r"^part-(\d+)-").cast("decimal(38,0)"), F.lit("9" * 37).cast("decimal(38,0)"))
    of_part = F.coalesce(number(r"-c(\d+)\b").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    before = Window.orderBy("part", "of_part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = held.groupBy("file").agg(F.count("*").alias("n")).select("file", "n", part.alias("part"), of_part.alias("of_part"))
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("row", "start"))
    numbered = held.withColumn("within", within).join(files, "file")
    return numbered.withColumn("sequence_id", (F.col("base") + F.col("within") - 1).cast("long")).select(
        [c for c in pieces.columns if c not in ("file", "row")])


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the pieces in a folder per bucket, so that a reader draws batches
    of equal-length sequences."""
    packed.write.partitionBy("bucket").parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "bucket", *packed.columns[8:])
