"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in hash order, fill blocks of `block_chars`
characters. Block j of a source with weight w is released at slot
floor(j / w) and due by slot ceil((j + 1) / w); among released blocks the
earliest deadline goes first. So at every slot each source has had its share
of the slots to within less than one block.

Weights are whole numbers that add up to about 2^40, so windows are exact and
no source has more or less than it was given. The whole mixture is scheduled
on the driver, in at most `MAX_SLOTS` slots: blocks of a mixture with more
characters are larger by what that takes. Every document finds its block, and
the block its slot, by arithmetic and one lookup. A source that holds less
than its share starts again from its first document: documents are repeated,
never dropped. A document stands whole in the block in which it begins, so in
characters a source is ahead of or behind its share by less than a block and
its longest text.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import numbered, place, renamed, running_start, scratch_table

BLOCK_CHARS = 65_536
MAX_SLOTS = 1 << 20
#: Default weights go by this power of a source's size: small sources gain.
ALPHA = 0.8
#: Sources that are scheduled one by one; by default weights, the smaller ones beyond it as one pool.
MAX_SOURCES = 10_000
POOL = "~"
ROWS_PER_PART = 4096
OUTPUTS = ("copy", "position", "block", "release", "deadline", "slot")


def whole_weights(weights: list[float]) -> list[int]:
    """The weights as whole numbers, 1 at least, that add up to about 2^40."""
    total = sum(weights)
    return [max(1, round(w / total * (1 << 40))) for w in weights]


def schedule(weights: list[int], counts: list[int]) -> list[list[int]]:
    """The slots of each source's blocks, earliest deadline first among released
    blocks; equal deadlines go to the earlier source. Where no block is
    released, at the end only, the next one to be released takes the slot."""
    total = sum(weights)
    out: list[list[int]] = [[] for _ in weights]
    due: list[tuple[int, int]] = []
    later = [(0, i) for i, n in enumerate(counts) if n]  # the release of each source's next block
    heapq.heapify(later)
    t = 0
    while due or later:
        while later and (later[0][0] <= t or not due):
            _, i = heapq.heappop(later)
            heapq.heappush(due, (-(-(len(out[i]) + 1) * total // weights[i]), i))
        _, i = heapq.heappop(due)
        out[i].append(t)
        if len(out[i]) < counts[i]:
            heapq.heappush(later, (len(out[i]) * total // weights[i], i))
        t += 1
    return out


def sources(rows: DataFrame, weights: dict[str | None, float] | None, alpha: float) -> list[tuple[str, int, int, float]]:
    """(key, size, rows, weight) of each source, by key, the pool of small ones
    last; the weights asked for are of the sources that there are."""
    per = scratch_table(rows.groupBy("_source").agg(F.sum("_size").alias("size"), F.count("*").alias("n")), "sources")
    if weights is not None:  # as many as the caller named
        given = {"" if k is None else f"={k}": w for k, w in weights.items()}
        found = [(r["_source"], r["size"], r["n"], given.get(r["_source"], 0.0))
                 for r in per.limit(len(given) + 1).collect()]
        if len(found) > len(given) or min((w for *_, w in found), default=1.0) <= 0:
            raise ValueError("every source needs a positive weight")
        return sorted(found)
    first = per.orderBy(F.desc("size"), "_source").limit(MAX_SOURCES)
    found = sorted((r["_source"], r["size"], r["n"], float(r["size"]) ** alpha) for r in first.collect())
    if len(found) == MAX_SOURCES:
        rest = per.join(first.select("_source"), "_source", "left_anti").agg(
            F.sum("size"), F.sum("n"), F.sum(F.pow("size", F.lit(alpha)))).first()
        found += [(POOL, *rest)] if rest[0] else []
    return found


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", block_chars: int = BLOCK_CHARS,
        alpha: float = ALPHA) -> DataFrame:
    """`docs` with copy, position, block, release, deadline and slot, a row per
    document and repetition; input columns of those names are replaced.

    position counts the characters of the source's stream before the row, and
    slot is the place of the row's block in the mixture. A null source is a
    source of its own. A null or empty text counts as one character. Given
    weights must name every source of `docs`; those of absent sources fall to
    the rest in proportion. Repeated rows follow one another. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    doc_id, text, source = (F.col(place(docs, c)) for c in (id_col, text_col, source_col))
    rows = numbered(docs).select("*", F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_source"),
                       F.greatest(F.lit(1), F.coalesce(F.length(text), F.lit(0))).cast("long").alias("_size"),
                       F.xxhash64(doc_id, text).alias("_hash"))
    found = sources(rows, weights, alpha)
    names, sizes, numbers, wanted = (list(c) for c in zip(*found)) if found else ([], [], [], [])
    shares = whole_weights(wanted)
    total = max(1, sum(shares))
    chars = max((-(-s * total // p) for s, p in zip(sizes, shares)), default=0)
    block_chars = max(block_chars, -(-chars // MAX_SLOTS))
    quotas = [chars * p // total for p in shares]
    slots = schedule(shares, [-(-q // block_chars) for q in quotas])
    plan = spark.createDataFrame(pa.table({
        "_group": pa.array(names, pa.string()), "_total": pa.array(sizes, pa.int64()),
        "_quota": pa.array(quotas, pa.int64()), "_share": pa.array(shares, pa.int64()),
        "_slots": pa.array(slots, pa.list_(pa.int32()))}))  # MAX_SLOTS slots and MAX_SOURCES rows, about

    n_parts = -(-sum(numbers) // ROWS_PER_PART) or 1
    own = F.broadcast(spark.createDataFrame(pa.table({"_own": pa.array(names, pa.string())})))
    rows = rows.join(own, F.col("_source") == F.col("_own"), "left").withColumn("_group", F.coalesce("_own", F.lit(POOL)))
    rows = running_start(rows.withColumn("_part", F.pmod("_hash", F.lit(n_parts))), "_part",
                         ["_hash", place(docs, id_col)], "_size", "_start", group=["_group"])
    rows = rows.join(F.broadcast(plan), "_group")
    copies = F.ceil((F.col("_quota") - F.col("_start")) / F.col("_total")).cast("int")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    rows = rows.withColumn("position", F.col("_start") + F.col("copy") * F.col("_total"))
    rows = rows.withColumn("block", F.floor(F.col("position") / block_chars))
    rows = (rows.withColumn("release", F.expr(f"block * {total}L div _share"))
            .withColumn("deadline", F.expr(f"-((-(block + 1) * {total}L - _share + 1) div _share)"))
            .withColumn("slot", F.get("_slots", F.col("block").cast("int")).cast("long")))
    return renamed(rows, docs, OUTPUTS)


def in_order(mixed: DataFrame) -> DataFrame:
    """The mixture's rows in slot order, in ranges of slots."""
    return mixed.repartitionByRange("slot", "position").sortWithinPartitions("slot", "position")
