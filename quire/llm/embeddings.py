"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated to the principal axes of their second moments, so
that the leading coordinates carry most of a product. Vectors in order of
their leading coordinates form tiles; two tiles are compared unless their
bounding boxes are too far apart. Inside a pair of tiles the product is
accumulated a few axes at a time; what is left is at most the product of the
suffix norms, and a pair is dropped as soon as that bound cannot reach the
threshold. Survivors are verified by the cosine of the original vectors.

Equal vectors collapse before any comparison and count by their number. A
pair of tiles returns a count and a component label per vector, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import components, map_arrow, merge, scratch_table

THRESHOLD = 0.95
TILE = 2048
LEADING = 8
ROWS_AT_ONCE = 512
#: Neighbouring partitions, and tiles in each, that form a group: 2 to this power.
GROUP_BITS = 2
SLACK = 1e-9


def usable(embedding: Column) -> Column:
    """Whether a vector has finite components, none null, and isn't zero."""
    x = embedding.cast("array<double>")
    return F.coalesce((F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(x, lambda v: v != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that squares neither vanish nor overflow
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """Principal axes (columns, the leading first) of the unit vectors' second
    moments, from dims * dims sums over all vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            u = unit(matrix(batch.column(0), dims))
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["k", "x"])

    moments = np.zeros(dims * dims)
    for k, x in map_arrow(vectors.select("e"), run, "k long, x double").groupBy("k").agg(F.sum("x")).collect():
        moments[k] = x
    return np.linalg.eigh(moments.reshape(dims, dims))[1][:, ::-1].copy()


def tiles(vectors: DataFrame, dims: int, rotation: np.ndarray, reach: float) -> DataFrame:
    """(tile, ids, times, data, lo, hi): up to TILE vectors in order of their
    leading coordinates, in cells as wide as linked vectors can be apart."""
    lead = min(LEADING, dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.floor(unit(matrix(batch.column(2), dims)) @ rotation[:, :min(4, dims)] / reach).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells.tolist(), pa.list_(pa.int32()))], ["id", "times", "e", "cell"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId() << 32, 0
        rest: list[pa.RecordBatch] = []

        def tile(rows: pa.Table) -> pa.RecordBatch:
            x = matrix(rows.column("e").combine_chunks(), dims)
            led = unit(x) @ rotation[:, :lead]
            return pa.RecordBatch.from_arrays(
                [pa.array([part + number]), *(pa.array([rows.column(c).to_numpy().astype("<i8").tobytes()])
                                              for c in ("id", "times")),
                 pa.array([x.astype("<f8").tobytes()]), pa.array([led.min(axis=0).tolist()]),
                 pa.array([led.max(axis=0).tolist()])], ["tile", "ids", "times", "data", "lo", "hi"])

        for batch in batches:
            rest.append(batch)
            while sum(b.num_rows for b in rest) >= TILE:
                table = pa.Table.from_batches(rest)
                yield tile(table.slice(0, TILE))
                number += 1
                rest = table.slice(TILE).to_batches()
        if sum(b.num_rows for b in rest):
            yield tile(pa.Table.from_batches(rest))

    placed = map_arrow(vectors.select("id", "times", "e"), place, "id long, times long, e array<double>, cell array<int>")
    ordered = placed.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").select("id", "times", "e")
    return map_arrow(ordered, build, "tile long, ids binary, times binary, data binary, "
                                     "lo array<double>, hi array<double>")


def tile_pairs(found: DataFrame, dims: int, reach: float) -> DataFrame:
    """(s, t): tiles s <= t whose boxes on the leading axes are within reach.
    Tiles meet by cell of the first axis, not all with all."""
    first = lambda c: F.floor(F.get(c, F.lit(0)) / reach)
    s = found.select(F.col("tile").alias("s"), F.col("lo").alias("slo"), F.col("hi").alias("shi"),
                     F.explode(F.sequence(first("lo"), first("hi"))).alias("cell"))
    t = found.select(F.col("tile").alias("t"), F.col("lo").alias("tlo"), F.col("hi").alias("thi"),
                     F.explode(F.sequence(first("lo") - 1, first("hi") + 1)).alias("cell"))
    gap = F.lit(0.0)
    for k in range(min(LEADING, dims)):
        away = F.greatest(F.lit(0.0), F.get("slo", F.lit(k)) - F.get("thi", F.lit(k)),
                          F.get("tlo", F.lit(k)) - F.get("shi", F.lit(k)))
        gap = gap + away * away
    met = s.join(t, "cell").where(gap <= reach * reach * (1 + SLACK))
    return met.select(F.least("s", "t").alias("s"), F.greatest("s", "t").alias("t")).distinct()


class Side:
    """A tile's vectors made ready for comparison: unit vectors, rotated ones,
    and the norms of what the accumulated axes leave."""

    def __init__(self, ids: bytes, times: bytes, data: bytes, rotation: np.ndarray):
        dims = len(rotation)
        self.ids, self.times = np.frombuffer(ids, "<i8"), np.frombuffer(times, "<i8")
        self.unit = unit(np.frombuffer(data, "<f8").reshape(-1, dims))
        self.rotated = self.unit @ rotation
        self.ends = sorted({min(k, dims) for k in (LEADING, 2 * LEADING, 4 * LEADING, dims)})
        self.suffix = [np.sqrt((self.rotated[:, k:] ** 2).sum(axis=1)) for k in self.ends]


def linked(x: Side, y: Side, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, links): blocks of rows of x and which rows of y they link to."""
    a, b = x.rotated, y.rotated
    for lo in range(0, len(a), ROWS_AT_ONCE):
        rows = slice(lo, lo + ROWS_AT_ONCE)
        product = np.zeros((len(a[rows]), len(b)))
        begin, i = 0, None
        for step, end in enumerate(x.ends):
            left = x.suffix[step][rows]
            if i is None:
                product += a[rows, begin:end] @ b[:, begin:end].T
                near = product + left[:, None] * y.suffix[step] >= threshold - SLACK
                if np.count_nonzero(near) * 10 < near.size:
                    i, j = np.nonzero(near)
                    total = product[i, j]
            else:
                total = total + np.einsum("ij,ij->i", a[lo + i, begin:end], b[j, begin:end])
                near = total + left[i] * y.suffix[step][j] >= threshold - SLACK
                i, j, total = i[near], j[near], total[near]
            begin = end
        links = np.zeros(product.shape, bool)
        if i is None:  # most pairs are near: verify the block at once
            links = x.unit[rows] @ y.unit.T >= threshold
        elif len(i):
            links[i, j] = np.einsum("ij,ij->i", x.unit[lo + i], y.unit[j]) >= threshold
        yield lo, links


def pair_links(x: Side, y: Side, same: bool, threshold: float) -> pa.RecordBatch:
    """(id, links, root) of the vectors linked between two tiles, or inside one."""
    ids, times = np.concatenate([x.ids, y.ids]), np.concatenate([x.times, y.times])
    n, labels, counts = len(x.ids), np.arange(len(ids)), np.zeros(len(ids))
    for lo, links in linked(x, y, threshold):
        hi = lo + len(links)
        if same:  # each pair once, no vector with itself
            links &= np.arange(lo, hi)[:, None] < np.arange(len(y.ids))
        counts[lo:hi] += links @ times[n:].astype(float)
        counts[n:] += times[lo:hi].astype(float) @ links
        i, j = np.nonzero(links)
        merge(labels, i + lo, j + (0 if same else n))
    if same:
        counts[:n] += counts[n:]
        counts[n:] = 0
    own = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[own]), pa.array(counts[own].astype(np.int64)), pa.array(ids[labels[own]])], ["id", "links", "root"])


def compare(found: DataFrame, pairs: DataFrame, dims: int, rotation: np.ndarray, threshold: float) -> DataFrame:
    """(id, links, root) per vector with a link in a pair of tiles: the number
    of vectors linked there, and the least row reached there.

    Tiles meet in the cells of a grid of tile groups, up to 16 neighbours in
    the tiles' order a group. A tile goes once to each cell in which it has a
    pair, not once for each pair; a cell holds the tiles of its one group and
    streams those of the other past them."""
    group = lambda c: F.shiftright(F.shiftright(c, 32), GROUP_BITS) * F.lit(1 << 31) + F.shiftright(
        F.col(c).bitwiseAND(F.lit((1 << 32) - 1)), GROUP_BITS)
    met = pairs.select(group("s").alias("down"), group("t").alias("across"), "s", "t")
    held = met.select("down", "across", F.lit(0).alias("kind"), F.col("s").alias("tile"),
                      F.array().cast("array<long>").alias("others")).distinct()
    passing = met.groupBy("down", "across", F.col("t").alias("tile")).agg(F.collect_list("s").alias("others"))
    needed = held.unionAll(passing.select("down", "across", F.lit(1), "tile", "others"))
    rows = needed.join(found.select("tile", "ids", "times", "data"), "tile").select(
        "down", "across", "kind", "tile", "others", "ids", "times", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sides = None, {}
        for batch in batches:
            for row in range(batch.num_rows):
                down, across, kind, tile, others, *data = (c[row].as_py() for c in batch.columns)
                if (down, across) != cell:
                    cell, sides = (down, across), {}
                side = sides[tile] if kind and tile in sides else Side(*data, rotation)
                if not kind:
                    sides[tile] = side
                for other in others:
                    yield pair_links(sides[other], side, other == tile, threshold)

    dealt = rows.repartition("down", "across").sortWithinPartitions("down", "across", "kind", "tile")
    return map_arrow(dealt, run, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors`.

    Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing, nor do rows with a null id (their
    component is null and they are not kept). Vectors of different length
    don't link. Equal vectors link with each other and count one by one, rows
    that repeat an id too. An empty table gives no rows. Other columns are not
    read.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    good = usable(F.col("v")) & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.when(good, F.col("v").cast("array<double>")).alias("e"))
    distinct = scratch_table(rows.where("e is not null").groupBy("e")
                             .agg(F.min("vec_id").alias("id"), F.count("*").alias("times")), "vectors")
    reach = float(np.sqrt(2 * (1 - threshold)))
    partial = None
    for (dims,) in sorted(distinct.select(F.size("e")).distinct().collect()):
        same = distinct.where(F.size("e") == dims)
        rotation = axes(same, dims)
        found = scratch_table(tiles(same, dims, rotation, reach), "tiles")
        pairs = tile_pairs(found.select("tile", "lo", "hi"), dims, reach)
        part = compare(found, pairs, dims, rotation, threshold)
        partial = part if partial is None else partial.unionAll(part)
    if partial is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    partial = scratch_table(partial, "links")
    counts = partial.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(partial.select(F.col("root").alias("a"), F.col("id").alias("b")))
    classes = (distinct.join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
               .select(F.col("e").alias("_e"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("_links"),
                       F.coalesce("root", "id").alias("_root")))
    joined = rows.join(classes, F.col("e") == F.col("_e"), "left")
    component = F.coalesce("_root", "vec_id")
    return joined.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
