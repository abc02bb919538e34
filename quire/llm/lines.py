"""Line dedup by pairwise alignment.

Documents that share a run of lines are aligned in pairs with patience diff,
and the aligned common blocks are deleted from the later document (by doc_id).
From each line starts a run, the fewest lines that reach the characters of a
deletable block; so every such block begins with a run that both documents
have, however short its lines are. Which pairs: every two holders of a rare
run (in at most `RARE` distinct texts), and for a more frequent run each
holder with the run's earliest holder and with the earliest one that has it
once, where it can be an anchor. The number of pairs stays linear in the
number of lines. A frequent run is a passage of its own besides: aligned with
the passage alone, as the earliest text has it that has it once, each later
holder has it as a common block wherever it stands, and loses it whether or
not one of its partners shows it. So no number of partners has to be tried. Exact copies align as a whole and are
settled by their digest before any pairing.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, numbered, place, renamed, scratch_table

RARE = 8
#: Frequent runs are broadcast up to this number, counted before the join.
BROADCAST_RUNS = 500_000
#: A common block is deleted when its lines have so many characters.
BLOCK_CHARS = 50


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], ascending in both. Anchors are
    the values that occur once on either side, in longest increasing order;
    between anchors equal ends are matched and the rest is aligned likewise.
    A gap with no such value stays unaligned."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        in_a, in_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        place = {a[i]: i for i in range(alo, ahi) if in_a[a[i]] == 1 and in_b[a[i]] == 1}
        anchors = [(place[b[j]], j) for j in range(blo, bhi) if b[j] in place]
        if not anchors:
            continue
        tails: list[int] = []  # least end of an increasing run, by length
        ends: list[int] = []
        before: list[int] = []
        for k, (i, _) in enumerate(anchors):
            at = bisect_left(tails, i)
            before.append(ends[at - 1] if at else -1)
            tails[at:at + 1] = [i]
            ends[at:at + 1] = [k]
        k, run = ends[-1], []
        while k >= 0:
            run.append(anchors[k])
            k = before[k]
        out += run
        i0, j0 = alo, blo
        for i, j in [*reversed(run), (ahi, bhi)]:
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
    return sorted(out)


def common_lines(a: list[int], b: list[int], b_chars: list[int], least: int = BLOCK_CHARS) -> list[int]:
    """Places in b of the aligned blocks with at least `least` characters."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(b_chars[k] for k in block) >= least:
                out += block
            block = []
        block.append(j)
        last = (i, j)
    return out


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, hashes, chars) per row with an id and a text: hash and
    length of each trimmed line, zeros for a blank one."""
    lines = F.transform(F.split(F.col(f"`{text_col}`"), "\n"), lambda s: F.btrim(s, F.lit(" \t\r\x0b\f")))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), digest(F.col(f"`{text_col}`")).alias("digest"),
                       lines.alias("lines")).where("doc_id is not null and digest is not null")
    return rows.select(
        "doc_id", "digest",
        F.transform("lines", lambda s: F.when(s == "", F.lit(0).cast("long")).otherwise(F.xxhash64(s))).alias("hashes"),
        F.transform("lines", lambda s: F.length(s)).alias("chars"))


def digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def run_keys(hashes: np.ndarray, chars: np.ndarray, sizes: np.ndarray,
             least: int = BLOCK_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end, hash) of the runs of some texts, whose lines stand one
    text after another, `sizes` lines each: from every line that isn't blank,
    the fewest lines with `least` characters."""
    n = len(hashes)
    powers = np.ones((2, n + 1), np.uint64)
    powers[:, 1:] = np.array([[_BASE], [_INVERSE]], np.uint64)
    powers = np.cumprod(powers, axis=1, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes.view(np.uint64) * powers[0, :n], dtype=np.uint64)])
    upto = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    text = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.flatnonzero(chars > 0)
    end = np.searchsorted(upto, upto[begin] + max(least, 1))  # lines before the run's end
    whole = end <= np.cumsum(sizes)[text[begin]]
    begin, end = begin[whole], end[whole]
    return text[begin], begin, end, ((sums[end] - sums[begin]) * powers[1, begin]).view(np.int64)


def runs(hashes: np.ndarray, chars: np.ndarray, sizes: np.ndarray,
         least: int = BLOCK_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, once) of the distinct runs of each text (see `run_keys`)."""
    owner, _, _, key = run_keys(hashes, chars, sizes, least)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])])[:len(key)])
    return owner[new], key[new], np.diff(new, append=len(key)) == 1


def held_runs(texts: DataFrame, least: int) -> DataFrame:
    """(doc, h, once): the distinct runs of each text (first, digest, hashes, chars)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            hashes, chars = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3))
            owner, key, once = runs(hashes, chars, sizes, least)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(key),
                                              pa.array(once)], ["first", "digest", "h", "once"])

    found = map_arrow(texts.select("first", "digest", "hashes", "chars"), run,
                      "first long, digest binary, h long, once boolean")
    return found.select(F.struct("first", "digest").alias("doc"), "h", "once")


def candidate_pairs(texts: DataFrame, least: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """((earlier, later), (digest, passages)): digests of distinct texts (first,
    digest, hashes, chars) that share a run and are to be aligned, and for each
    text the frequent runs that an earlier one has once.

    A frequent run's holders are found by a broadcast of the frequent runs, if
    they are few enough by count, so no run is gathered in one task."""
    held = scratch_table(held_runs(texts, least), "runs")
    stats = scratch_table(held.groupBy("h").agg(
        F.count("*").alias("n"), F.min("doc").alias("earliest"),
        F.min(F.when(F.col("once"), F.col("doc"))).alias("sole")).where("n > 1"), "shared-runs")
    frequent = stats.where(F.col("n") > RARE).drop("n")
    if frequent.count() <= BROADCAST_RUNS:
        frequent = F.broadcast(frequent)
    later = held.join(frequent, "h").where("earliest < doc")
    passages = later.where("sole < doc").groupBy(F.col("doc.digest").alias("digest")).agg(F.collect_set("h").alias("passages"))
    star = (later.select("doc", F.explode(F.array("earliest", "sole")).alias("e"))
            .where("e < doc").select(F.col("e.digest").alias("earlier"), F.col("doc.digest").alias("later")))
    rare = held.join(frequent.select("h"), "h", "left_anti").join(stats.where(F.col("n") <= RARE).select("h"), "h")
    lists = rare.groupBy("h").agg(F.sort_array(F.collect_list("doc")).alias("docs"))  # at most RARE of them
    each = lists.select("docs", F.posexplode("docs").alias("at", "d")).where("at > 0")
    every = each.select(F.explode(F.slice("docs", F.lit(1), F.col("at"))).alias("e"), "d").select(
        F.col("e.digest").alias("earlier"), F.col("d.digest").alias("later"))
    return star.unionAll(every).distinct(), passages


def passage_lines(texts: DataFrame, passages: DataFrame, least: int = BLOCK_CHARS) -> DataFrame:
    """(digest, place): the places of each text's frequent runs that an earlier text has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            hashes, chars = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
            owner, begin, end, key = run_keys(hashes, chars, sizes, least)
            found = batch.column(3)
            wanted = np.repeat(np.arange(len(sizes)), pc.list_value_length(found).to_numpy(zero_copy_only=False))
            # a text's number goes into the hash, so that each text has its own
            own = lambda o, k: k.view(np.uint64) ^ (o.astype(np.uint64) * np.uint64(_BASE))
            known = np.isin(own(owner, key), own(wanted, found.flatten().to_numpy(zero_copy_only=False)))
            step = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(step, begin[known], 1)
            np.add.at(step, end[known], -1)
            at = np.flatnonzero(np.cumsum(step)[:-1] > 0)
            text = np.repeat(np.arange(len(sizes)), sizes)[at]
            first = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), pa.array((at - first[text]).astype(np.int32))], ["digest", "place"])

    rows = texts.join(passages, "digest").select("digest", "hashes", "chars", "passages")
    return map_arrow(rows, run, "digest binary, place int")


def aligned_lines(texts: DataFrame, pairs: DataFrame, least: int = BLOCK_CHARS) -> DataFrame:
    """(digest, place): the places of each later text's common lines."""
    a = texts.select(F.col("digest").alias("earlier"), F.col("hashes").alias("a"))
    b = texts.select(F.col("digest").alias("later"), F.col("hashes").alias("b"), "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, places = [], []
            for d, *sides in zip(*(c.to_pylist() for c in batch.columns)):
                found = common_lines(*sides, least)
                digests += [d] * len(found)
                places += found
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(places, pa.int32())],
                                             ["digest", "place"])

    rows = pairs.join(a, "earlier").join(b, "later").select("later", "a", "b", "chars")
    return map_arrow(rows, run, "digest binary, place int")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: int = BLOCK_CHARS) -> DataFrame:
    """`docs` with the text rewritten, and n_lines and n_removed (lines; blank
    ones of a deleted block count). Input columns of those names are replaced.

    The document with the smaller id is the earlier one; texts that first
    occur at the same id are ordered by digest. A later exact copy loses all
    lines if they have `least` characters. Rows with a null id or a null text
    are returned unchanged; rows that repeat both id and text are one document
    and are treated alike. An empty table gives no rows.
    """
    table = scratch_table(line_table(docs, id_col, text_col), "lines")
    firsts = table.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    texts = (table.join(firsts, "digest").where("doc_id = first")
             .groupBy("digest", "first").agg(F.first("hashes").alias("hashes"), F.first("chars").alias("chars")))
    texts = scratch_table(texts, "texts")
    pairs, passages = candidate_pairs(texts, least)
    places = aligned_lines(texts, pairs, least).unionAll(passage_lines(texts, passages, least))
    removed = places.groupBy("digest").agg(F.collect_set("place").alias("removed"))
    found = (firsts.join(removed, "digest", "left").where("copies > 1 or removed is not null")
             .select(F.col("digest").alias("_digest"), F.col("first").alias("_first"), F.col("removed").alias("_removed")))
    doc_id, body = F.col(place(docs, id_col)), F.col(place(docs, text_col))
    rows = numbered(docs).withColumn("_own", digest(body)).join(found, F.col("_own") == F.col("_digest"), "left")
    lines = F.split(body, "\n")
    chars = F.length(F.translate(body, " \t\r\n\x0b\f", ""))
    copy = (doc_id > F.col("_first")) & (chars >= least)
    places = F.when(copy, F.sequence(F.lit(0), F.size(lines) - 1)).when(doc_id.isNotNull(), F.col("_removed"))
    places = F.coalesce(places, F.expr("cast(array() as array<int>)"))
    rows = rows.withColumn("_places", places).withColumn("_lines", lines)
    rows = (rows.withColumn("n_lines", F.when(body.isNotNull(), F.size("_lines")).cast("long"))
            .withColumn("n_removed", F.when(body.isNotNull(), F.size("_places")).cast("long")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_places"))
    text = F.when(F.size("_places") > 0, F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n"))
    return renamed(rows.withColumn(place(docs, text_col), text.otherwise(body)), docs, ("n_lines", "n_removed"))
