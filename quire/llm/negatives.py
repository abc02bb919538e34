"""Hard-negative mining with Four-Russians scoring.

Components become integers. A candidate's integers are kept as bit planes:
plane k holds bit k of every component, eight dimensions to a byte. For an
anchor and each group of eight dimensions a table of 256 subset sums is
filled by doubling; a plane's product with the anchor is then one lookup per
byte, and the planes' products, shifted by their places (the top one
negative, as in two's complement), add up to the exact score. An anchor's
tables stand side by side with those of other anchors, so that a byte looks
up many anchors at once.

Few pairs need all planes. Candidates are also kept in steps of a part of
their spread, in `STEP_BITS` planes, with the length of what the steps leave
out. The product with the steps comes from the same tables, and differs from
the score by at most that length times the anchor's. The first `FIRST_BITS`
planes show for most pairs that the score is below the least one that the
anchor still takes; what they leave is scored exactly. Where they leave too
much, the other planes follow, then those of the whole integers.

Anchors and candidates are dealt by hash to the rows and columns of a grid;
a cell streams its candidates past its anchors, so its memory is bounded by
its anchors, and it needs a copy of neither but for each cell of its column
or row. A first pass finds each anchor's positives among the rows of its
label, a second one the negatives in the window of each positive; both keep
a bounded number of rows per anchor and cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, scratch_table

POSITIVES = 5
NEGATIVES = 3
SCALE = 256
#: Anchors and candidates of a grid cell, about.
CELL_ANCHORS = 65_536
CELL_ROWS = 1 << 20
#: Candidates of a cell at least, where smaller cells would only make more tasks.
LEAST_ROWS = 1024
ANCHORS_AT_ONCE = 256
ROWS_AT_ONCE = 512
#: Candidates that go past a cell's anchors together, for which each anchor's tables are filled.
FEED_ROWS = 32_768
#: Planes of a candidate in steps, those looked at first, and the steps' reach in standard deviations.
STEP_BITS = 5
FIRST_BITS = 3
REACH = 2.5
#: Parts of a block's pairs above which the next plane of the steps follows, and all planes in the end.
NEXT_PLANE = 0.02
ALL_PLANES = 0.3
#: Pairs that are scored exactly at once.
PAIRS_AT_ONCE = 4096


def eligible(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): the rows that take part, with integer components."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{label_col}`").cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform("x", lambda v: F.floor(F.lit(float(SCALE)) * v).cast("long"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
                      & F.coalesce(finite, F.lit(False))).select("vec_id", "label", whole.alias("v"))


def planes_of(v: np.ndarray, bits: int) -> np.ndarray:
    """Rows of integers as (row, plane, group) bytes; dimension 8g + j is bit j of group g."""
    return np.stack([np.packbits((v >> k & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)], axis=1)


def integers_of(planes: np.ndarray) -> np.ndarray:
    """The integers of rows of bit planes, groups filled up by zeros."""
    found = np.zeros((len(planes), 8 * planes.shape[2]), np.int64)
    for k in range(planes.shape[1]):
        place = -(1 << k) if k == planes.shape[1] - 1 else 1 << k
        found += place * np.unpackbits(planes[:, k], axis=1, bitorder="little").astype(np.int64)
    return found


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(group, byte, anchor): the sum of an anchor's components whose bits the byte has."""
    groups = anchors.shape[1] // 8
    table = np.zeros((groups, 256, len(anchors)), anchors.dtype)
    parts = anchors.T.reshape(groups, 8, len(anchors))
    for j in range(8):
        np.add(table[:, :1 << j], parts[:, j:j + 1], out=table[:, 1 << j:2 << j])
    return table


def scores(planes: np.ndarray, table: np.ndarray, dtype: type | None = None) -> np.ndarray:
    """(row, anchor): exact products of candidates with the anchors of the
    tables, whose type holds a plane's product, as `dtype` holds a score."""
    rows, bits, groups = planes.shape
    total = np.zeros((rows, table.shape[2]), dtype or table.dtype)
    looked, plane = (np.empty(total.shape, table.dtype) for _ in range(2))
    for k in reversed(range(bits)):  # from the top: shift, then add
        np.take(table[0], planes[:, k, 0], axis=0, out=plane, mode="clip")
        for g in range(1, groups):
            np.take(table[g], planes[:, k, g], axis=0, out=looked, mode="clip")
            plane += looked
        if k == bits - 1:
            np.negative(plane, out=total, dtype=total.dtype)
        else:
            total += total
            total += plane
    return total


class Lists:
    """Bounded lists of the best candidates, `keep` for each of some slots."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.score, self.id = (np.zeros((slots, keep), np.int64) for _ in range(2))
        self.empty = np.ones((slots, keep), bool)
        #: The last score of a full list; a candidate must reach it.
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        old, new = np.unique(slot, return_inverse=True)
        place = np.concatenate((np.repeat(np.arange(len(old)), self.keep), new))
        score = np.concatenate((self.score[old].ravel(), score))
        ids = np.concatenate((self.id[old].ravel(), ids))
        empty = np.concatenate((self.empty[old].ravel(), np.zeros(len(slot), bool)))
        order = np.lexsort((ids, -score, empty, place))  # a list's first ones by score, then by id
        first = np.searchsorted(place[order], np.arange(len(old)))
        kept = order[first[:, None] + np.arange(self.keep)]
        self.score[old], self.id[old], self.empty[old] = score[kept], ids[kept], empty[kept]
        full = ~empty[kept[:, -1]]
        self.least[old[full]] = score[kept[full, -1]]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all candidates on the lists."""
        slot, at = np.nonzero(~self.empty)
        return slot, self.score[slot, at], self.id[slot, at]


class Rows:
    """Candidates with their integers, and in steps: v = middle + step * (n + 1/2) + rest
    with -2**(STEP_BITS - 1) <= n < 2**(STEP_BITS - 1), n as bit planes from the top."""

    def __init__(self, key: np.ndarray, ids: np.ndarray, label: np.ndarray, planes: np.ndarray, dtype: type):
        v = integers_of(planes)
        self.middle = np.floor(v.mean(axis=0))
        rest = v - self.middle
        half = 1 << STEP_BITS - 1
        self.step = max(REACH * float(rest.std()) / half, 1e-3)
        n = np.clip(np.floor(rest / self.step), -half, half - 1).astype(np.int64)
        self.length = float(np.sqrt((n * n).sum(axis=1, dtype=np.float64).max(initial=0)))
        #: By number of planes: what their steps leave out.
        self.rests = {bits: np.sqrt(((rest - self.in_steps(n, bits)) ** 2).sum(axis=1))
                      for bits in range(FIRST_BITS, STEP_BITS + 1)}
        order = np.argsort(self.rests[FIRST_BITS], kind="stable")  # neighbours have rests of one length
        self.rests = {bits: x[order] for bits, x in self.rests.items()}
        self.key, self.ids, self.label, self.planes, self.v = (
            x[order] for x in (key, ids, label, planes, v.astype(dtype)))
        self.steps = np.ascontiguousarray(planes_of(n[order], STEP_BITS).transpose(1, 2, 0)[::-1])

    def in_steps(self, n: np.ndarray, bits: int) -> np.ndarray:
        """What the first planes of n stand for, from the middle."""
        left = STEP_BITS - bits
        return self.step * ((n >> left) + 0.5) * (1 << left)


class Cell:
    """The anchors of a grid cell, past which its candidates go. An anchor has
    slots: windows of scores, each with a bounded list of its best candidates."""

    def __init__(self, rows: pa.Table, shape: tuple[int, int], wide: bool, keep: int, low: np.ndarray, high: np.ndarray,
                 slots: np.ndarray):
        self.shape = shape
        self.dtype = np.int64 if wide else np.int32
        self.key, self.label = (rows.column(c).to_numpy() for c in ("key", "label"))
        self.vectors = integers_of(unpacked(rows.column("data").combine_chunks(), shape)).astype(self.dtype)
        self.low, self.high = low, high
        self.anchor = np.repeat(np.arange(len(self.key)), slots)
        self.first = np.concatenate(([0], np.cumsum(slots)))
        self.number = np.arange(len(low)) - self.first[self.anchor]
        self.lists = Lists(len(low), keep)

    def allowed(self, rows: Rows, r: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Whether candidates r may stand on a list of anchors a."""
        raise NotImplementedError

    def enter(self, slots: np.ndarray) -> np.ndarray:
        """The least score that some slots still take; no score is the greatest number."""
        found = np.maximum(self.low[slots], self.lists.least[slots])
        return np.where(found <= self.high[slots], found, np.iinfo(np.int64).max)

    def past(self, anchors: np.ndarray, rows: Rows) -> None:
        """Put candidates on the lists of anchors that have slots."""
        for at in range(0, len(anchors), ANCHORS_AT_ONCE):
            Block(self, anchors[at:at + ANCHORS_AT_ONCE], rows).run()


class Block:
    """Some anchors of a cell, and candidates that go past them."""

    def __init__(self, cell: Cell, some: np.ndarray, rows: Rows):
        self.cell, self.some, self.rows = cell, some, rows
        self.vectors = cell.vectors[some]
        v = self.vectors.astype(np.float64)
        self.norm, total = np.sqrt((v * v).sum(axis=1)), v.sum(axis=1)
        self.base = v @ rows.middle
        self.terms = np.abs(v) @ np.abs(rows.middle)
        self.middles = rows.step * total
        # holds each plane's product, and those with the steps
        most = max(float(np.abs(v).sum(axis=1).max()), float(self.norm.max()) * rows.length) + 2
        dtype = next(t for t in (np.int16, np.int32, np.int64) if t is np.int64 or most < np.iinfo(t).max)
        self.table = subset_sums(self.vectors.astype(dtype))
        self.slots = np.concatenate([np.arange(*cell.first[a:a + 2]) for a in some.tolist()])
        sizes = cell.first[some + 1] - cell.first[some]
        self.begin, self.width = np.cumsum(sizes) - sizes, int(sizes.max())
        self.waiting: list[np.ndarray] = []

    def refresh(self) -> None:
        """The least score that a slot of each anchor still takes."""
        self.least = np.minimum.reduceat(self.cell.enter(self.slots), self.begin).astype(np.float64)

    def limits(self, bits: int, rest: float) -> np.ndarray:
        """The least product with the first planes of which the score may be on a list."""
        step = 1 << STEP_BITS - bits
        scale = self.rows.step * step
        base = self.base + 0.5 * step * self.middles
        slack = 1e-3 + 1e-9 * (np.abs(self.least) + self.terms + np.abs(self.middles) * step + self.norm * rest) / scale
        found = np.ceil((self.least - base - self.norm * rest) / scale - slack)
        most = np.iinfo(self.table.dtype)
        top = float(most.max) if most.bits < 64 else float(1 << 62)
        return np.clip(found, -top, top).astype(self.table.dtype)

    def run(self) -> None:
        n, wide = len(self.rows.key), len(self.some)
        totals, lookeds = (np.empty((ROWS_AT_ONCE, wide), self.table.dtype) for _ in range(2))
        self.refresh()
        begin = FIRST_BITS
        for lo in range(0, n, ROWS_AT_ONCE):
            hi = min(lo + ROWS_AT_ONCE, n)
            total, looked = totals[:hi - lo], lookeds[:hi - lo]
            for k in range(STEP_BITS):
                self.look(total, looked, k, slice(lo, hi))
                if k + 1 < begin:
                    continue
                rest = float(self.rows.rests[k + 1][lo:hi].max())
                left = total >= self.limits(k + 1, rest)
                if np.count_nonzero(left) <= NEXT_PLANE * total.size:
                    break
            begin = max(FIRST_BITS, k)  # later blocks need hardly more planes
            left = np.flatnonzero(left)
            if len(left) > ALL_PLANES * total.size:
                self.whole(slice(lo, hi))
            elif len(left):
                self.waiting.append(left + lo * wide)
                if sum(map(len, self.waiting)) >= PAIRS_AT_ONCE:
                    self.score()
        self.score()

    def look(self, total: np.ndarray, looked: np.ndarray, k: int, rows: slice) -> None:
        """Add plane k of the steps to the products of those before it."""
        if k:
            total += total
        for g, table in enumerate(self.table):
            np.take(table, self.rows.steps[k, g, rows], axis=0, out=looked if k or g else total, mode="clip")
            if k or g:
                total += looked
        if k == 0:  # the top plane, as in two's complement
            np.negative(total, out=total)

    def whole(self, rows: slice) -> None:
        """Score a block of pairs by all planes."""
        cell, some = self.cell, self.some
        found = scores(self.rows.planes[rows], self.table, cell.dtype)
        lowest, most = np.iinfo(cell.dtype).min, np.iinfo(cell.dtype).max
        fit = cell.allowed(self.rows, np.arange(rows.start, rows.stop)[:, None], some)
        keep = min(cell.lists.keep, len(found))
        for w in range(self.width):
            has = np.flatnonzero(cell.first[some] + w < cell.first[some + 1])
            own = slice(None) if len(has) == len(some) else has
            slot = cell.first[some[has]] + w
            low, high = (np.clip(x, lowest, most).astype(cell.dtype) for x in (cell.enter(slot), cell.high[slot]))
            ok = fit[:, own] & (found[:, own] >= low) & (found[:, own] <= high)
            # of each list the best of these rows
            best = np.where(ok, found[:, own], lowest)
            ok &= best >= np.partition(best, len(best) - keep, axis=0)[len(best) - keep]
            r, a = np.divmod(np.flatnonzero(ok), len(has))
            cell.lists.add(slot[a], best[r, a].astype(np.int64), self.rows.ids[rows][r])
        self.refresh()

    def score(self) -> None:
        """Score the waiting pairs exactly."""
        if not self.waiting:
            return
        r, a = np.divmod(np.concatenate(self.waiting), len(self.some))
        self.waiting = []
        found = products(self.rows.v, self.vectors, r, a)
        ok = found >= self.least[a]
        r, a, found = r[ok], a[ok], found[ok].astype(np.int64)
        ok = self.cell.allowed(self.rows, r, self.some[a])
        r, a, found = r[ok], a[ok], found[ok]
        if not len(r):
            return
        first, end = self.cell.first[self.some[a]], self.cell.first[self.some[a] + 1]
        for w in range(self.width):
            has = np.flatnonzero(first + w < end)
            slot = first[has] + w
            ok = (found[has] >= self.cell.enter(slot)) & (found[has] <= self.cell.high[slot])
            self.cell.lists.add(slot[ok], found[has[ok]], self.rows.ids[r[has[ok]]])
        self.refresh()


def products(v: np.ndarray, anchors: np.ndarray, r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact products of pairs of rows."""
    return np.einsum("ij,ij->i", v[r], anchors[a])


class Positives(Cell):
    """The best rows of each anchor's own label."""

    def __init__(self, rows: pa.Table, shape: tuple[int, int], wide: bool, keep: int):
        far, n = np.iinfo(np.int64), rows.num_rows
        super().__init__(rows, shape, wide, keep, np.full(n, far.min), np.full(n, far.max - 1), np.ones(n, np.int64))
        self.by_label = np.argsort(self.label, kind="stable")
        self.labels, begin = np.unique(self.label[self.by_label], return_index=True)
        self.ends = np.append(begin, len(self.label))

    def allowed(self, rows: Rows, r: np.ndarray, a: np.ndarray) -> np.ndarray:
        return rows.key[r] != self.key[a]

    def feed(self, key: np.ndarray, ids: np.ndarray, label: np.ndarray, planes: np.ndarray) -> None:
        own = np.searchsorted(self.labels, label)
        own[own == len(self.labels)] = 0
        for k in np.unique(own[self.labels[own] == label]).tolist():
            at = np.flatnonzero(label == self.labels[k])
            self.past(self.by_label[self.ends[k]:self.ends[k + 1]],
                      Rows(key[at], ids[at], label[at], planes[at], self.dtype))

    def result(self) -> pa.RecordBatch:
        slot, score, ids = self.lists.entries()
        return pa.RecordBatch.from_arrays([pa.array(self.key[slot]), pa.array(ids), pa.array(score)],
                                          ["key", "positive_id", "positive_score"])


class Negatives(Cell):
    """The best rows of other labels in the window of each anchor's positives."""

    def __init__(self, rows: pa.Table, shape: tuple[int, int], wide: bool, keep: int, least: int, most: int):
        at = rows.column("scores").combine_chunks()
        positive = at.flatten().to_numpy().astype(object)  # no overflow in the products
        super().__init__(rows, shape, wide, keep, np.array([-(-least * p // 100) for p in positive], np.int64),
                         np.array([most * p // 100 for p in positive], np.int64),
                         at.value_lengths().to_numpy(zero_copy_only=False))
        self.with_slots = np.flatnonzero(np.diff(self.first) > 0)

    def allowed(self, rows: Rows, r: np.ndarray, a: np.ndarray) -> np.ndarray:
        return rows.label[r] != self.label[a]

    def feed(self, key: np.ndarray, ids: np.ndarray, label: np.ndarray, planes: np.ndarray) -> None:
        self.past(self.with_slots, Rows(key, ids, label, planes, self.dtype))

    def result(self) -> pa.RecordBatch:
        slot, score, ids = self.lists.entries()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.key[self.anchor[slot]]), pa.array(self.number[slot].astype(np.int32)),
             pa.array(ids), pa.array(score)], ["key", "number", "negative_id", "negative_score"])


def unpacked(data: pa.Array, shape: tuple[int, int]) -> np.ndarray:
    """Rows of plane bytes as (row, plane, group)."""
    joined = b"".join(data.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(data), *shape)


def packed(rows: DataFrame, bits: int, dims: int) -> DataFrame:
    """(key, vec_id, label, data): rows of `eligible` with a number of their own
    and their bit planes; shorter vectors are filled up by zeros."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            v = np.zeros((batch.num_rows, dims), np.int64)
            v[np.arange(dims) < sizes[:, None]] = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            data = planes_of(v, bits).reshape(batch.num_rows, -1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * data.shape[1]
            planes = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], planes], ["key", "vec_id", "label", "data"])

    return map_arrow(rows.select(F.monotonically_increasing_id().alias("key"), "vec_id", "label", "v"), run,
                     "key long, vec_id long, label long, data binary")


def over_grid(anchors: DataFrame, rows: DataFrame, grid: tuple[int, int], make, schema: str) -> DataFrame:
    """The result of `make(anchors of a cell)` for every cell, after its
    candidates went past.

    anchors: (key, label, data, scores), rows: (key, vec_id, label, data).
    Each anchor goes to a row of the grid and each candidate to a column, and
    to every cell of it. In a cell anchors come before candidates.
    """
    down, across = grid
    cells = lambda first, step, n: F.explode(F.sequence(first, first + step * (n - 1), F.lit(step)))
    r, c = F.pmod(F.xxhash64("key"), F.lit(down)).cast("int"), F.pmod(F.xxhash64("key"), F.lit(across)).cast("int")
    a = anchors.select(cells(r * across, 1, across).alias("cell"), F.lit(0).alias("kind"), "key",
                       F.lit(0).cast("long").alias("vec_id"), "label", "data", "scores")
    b = rows.select(cells(c, across, down).alias("cell"), F.lit(1).alias("kind"), "key", "vec_id", "label", "data",
                    F.lit(None).cast("array<long>").alias("scores"))
    dealt = a.unionAll(b).repartitionById(down * across, "cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, past, rows = None, [], None, []

        def feed() -> None:
            if rows:
                part = pa.Table.from_batches(rows)
                rows.clear()
                past.feed(*(part.column(k).to_numpy() for k in (2, 3, 4)),
                          unpacked(part.column(5).combine_chunks(), past.shape))

        for batch in batches:
            cell_of, kind = (batch.column(k).to_numpy() for k in (0, 1))
            cuts = np.flatnonzero((np.diff(cell_of) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                if cell_of[lo] != cell:
                    if past is not None:
                        feed()
                        yield past.result()
                    cell, waiting, past = cell_of[lo], [], None
                if kind[lo] == 0:
                    waiting.append(part)
                elif waiting or past is not None:
                    if past is None:
                        past, waiting = make(pa.Table.from_batches(waiting)), []
                    rows.append(part)
                    if sum(map(len, rows)) >= FEED_ROWS:
                        feed()
        if past is not None:
            feed()
            yield past.result()

    return map_arrow(dealt, run, schema)


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", relabel: Column | None = None, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, least: int = 50, most: int = 95) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    Rows for which `is_anchor` (over `vec_id` and `label`) holds are anchors.
    An anchor's positives are the first `positives` other rows of its label by
    score, then by id; a positive's negatives are the first `negatives` rows of
    other labels whose score is from `least` to `most` percent of its own.
    `relabel`, over the same two columns, replaces the labels first.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. A shorter vector counts as filled up by zeros.
    Repeated rows are rows of their own, so copies of an anchor are its
    positives. Scores that may not fit in 64 bits are refused. An empty table
    gives no rows; other columns are not read.
    """
    out = ["anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"]
    spark = vectors.sparkSession
    rows = eligible(vectors, id_col, vector_col, label_col)
    if relabel is not None:
        rows = rows.withColumn("label", relabel.cast("long"))
    rows = rows.where("label is not null")
    marked = F.coalesce(is_anchor, F.lit(False))
    n, n_anchors, dims, low, high = rows.agg(
        F.count("*"), F.count_if(marked), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    bits = 1 + max((-(low or 0) - 1).bit_length() if (low or 0) < 0 else 0, max(high or 0, 0).bit_length())
    groups = max(1, -(-(dims or 1) // 8))
    if groups * 8 << 2 * (bits - 1) >= 1 << 63:
        raise ValueError("components too large for exact 64-bit scores")
    wide, shape = groups * 8 << 2 * (bits - 1) >= 1 << 31, (bits, groups)
    down = max(1, -(-n_anchors // CELL_ANCHORS))
    across = max(1, -(-n // CELL_ROWS), min(-(-2 * spark.sparkContext.defaultParallelism // down), n // LEAST_ROWS))
    grid = down, across

    table = scratch_table(packed(rows, bits, 8 * groups), "planes")
    anchors = table.where(marked)
    bare = anchors.select("key", "label", "data", F.lit(None).cast("array<long>").alias("scores"))
    found = over_grid(bare, table, grid, lambda a: Positives(a, shape, wide, positives),
                      "key long, positive_id long, positive_score long")
    by = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    chosen = scratch_table(found.withColumn("positive_rank", F.row_number().over(by))
                           .where(F.col("positive_rank") <= positives), "positives")
    # an anchor's few positives as arrays, in order of their ranks
    ranked = F.array_sort(F.collect_list(F.struct("positive_rank", "positive_id", "positive_score")))
    lists = chosen.groupBy("key").agg(ranked.alias("p"))
    full = scratch_table(anchors.withColumnRenamed("vec_id", "anchor_id").join(lists, "key"), "anchors")
    windows = full.select("key", "label", "data", F.col("p.positive_score").alias("scores"))
    found = over_grid(windows, table, grid, lambda a: Negatives(a, shape, wide, negatives, least, most),
                      "key long, number int, negative_id long, negative_score long")
    by = Window.partitionBy("key", "number").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    pair = F.get("p", F.col("number"))
    return best.join(full.select("key", "anchor_id", "p"), "key").select(
        "anchor_id", pair["positive_id"].alias("positive_id"), pair["positive_rank"].alias("positive_rank"), "rank",
        "negative_id", pair["positive_score"].alias("positive_score"), "negative_score").select(*out)
