"""Integer k-means over (x, y) score vectors: sampling of initial centres,
nearest-centre assignment, integer centroids, the iteration loop, and the
per-cluster summary (dominant label, share, size, median)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.geometry import UNROLLED, bands, int_div, nearest_center
from quire.functions.checks import must_hold, once
from quire.functions.hashing import md5_rank_key
from quire.functions.text import check_vocab, vocab_array
from quire.operators.common import sort_bounded
from quire.session import ensure_checkpoint_dir

DEFAULT_KERNELS = 45
DEFAULT_ETA = 20.0
DEFAULT_MAX_ITERATIONS = 120
DEFAULT_SEED = 42
# Below this spread the tags are not separable by x and centres are sampled
# over the whole space instead of per tag.
GLOBAL_SAMPLE_BELOW_SPREAD = 500

Centers = list[tuple[int, int, int]]  # (center_id, x, y)


def weighted_points(vectors: DataFrame, compact: bool = True) -> DataFrame:
    """(x, y, w). With `compact`, equal vectors collapse to one row with
    weight w (exact, since all later sums are integer sums); otherwise each
    vector keeps weight 1."""
    if compact:
        return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    return vectors.select("x", "y", F.lit(1).cast("bigint").alias("w"))


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into `spark.checkpoint.dir`: computed once now,
    read back by every later use, lineage cut (survives executor loss). Its
    partitions are those that AQE makes of the last shuffle."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def expect_vectors(points: DataFrame, expected: int | None) -> DataFrame:
    """`points`, if their weights add up to the `expected` number of vectors;
    else an error, before anything is computed from them. The weights of
    materialised points tell the number without the vectors' pipeline being
    run again, and exactly, also after a lost executor's tasks ran twice
    (which an accumulator of the materialisation would count twice)."""
    if expected is not None:
        (n,) = points.agg(F.coalesce(F.sum("w"), F.lit(0))).first()
        if n != expected:
            raise ValueError(f"unexpected vector count: {n}, not {expected}")
    return points


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.select("x", "y").distinct()


def _check_kernels(kernels: int) -> None:
    # the sample is numbered in one partition and collected: k rows, a parameter
    if kernels < 1:
        raise ValueError("kernels must be positive")


def sample_vectors(vectors: DataFrame, n_terms: int, kernels: int = DEFAULT_KERNELS,
                   seed: int = DEFAULT_SEED) -> DataFrame:
    """(center_id, x, y): `kernels / n_terms` distinct vectors per x (tag).

    Within each tag the vectors with the smallest seeded md5 key are taken
    (deterministic, and the same in any engine). `row_number() <= k` lets
    Spark insert a partial per-tag limit before the shuffle, so each task
    ships at most k rows per tag. The job fails when a tag has fewer than k
    distinct vectors or the total is not `kernels`. `center_id` orders the
    centres by (x, rank).
    """
    _check_kernels(kernels)
    if n_terms <= 0 or kernels % n_terms != 0:
        raise ValueError("kernels must be a multiple of the number of terms")
    per = kernels // n_terms
    ranked = (distinct_vectors(vectors)
              .withColumn("r", F.row_number().over(
                  Window.partitionBy("x").orderBy(md5_rank_key("x", "y", seed=seed), "y")))
              .where(F.col("r") <= per)
              # a valid sample has exactly `kernels` rows; one more is enough
              # to fail the size check below without gathering more
              .limit(kernels + 1))
    out = (ranked
           .withColumn("n_tag", F.count(F.lit(1)).over(Window.partitionBy("x")))
           .withColumn("n_all", F.count(F.lit(1)).over(Window.partitionBy()))
           .withColumn("cid", (F.row_number().over(Window.orderBy("x", "r")) - 1).cast("int")))
    ok = (F.col("n_tag") == per) & (F.col("n_all") == kernels)
    return must_hold(out, ok, f"sample needs {per} distinct vectors per tag and {kernels} in all").select(
        F.col("cid").alias("center_id"), "x", "y")


def sample_vectors_global(vectors: DataFrame, kernels: int = DEFAULT_KERNELS,
                          seed: int = DEFAULT_SEED) -> DataFrame:
    """(x, y): `kernels` distinct vectors with the smallest seeded md5 key
    over the whole space (top-k: a per-task partial limit, no full sort)."""
    _check_kernels(kernels)
    return (distinct_vectors(vectors)
            .orderBy(md5_rank_key("x", "y", seed=seed), "x", "y")
            .limit(kernels))


def number_centers(sample: DataFrame, kernels: int) -> DataFrame:
    """(center_id, x, y) with ids in (x, y) order; the job fails unless the
    sample holds exactly `kernels` rows (at most kernels + 1 are gathered
    to tell)."""
    _check_kernels(kernels)
    bounded = sample.select("x", "y").limit(kernels + 1)
    out = (bounded
           .withColumn("cid", (F.row_number().over(Window.orderBy("x", "y")) - 1).cast("int"))
           .withColumn("n_all", F.count(F.lit(1)).over(Window.partitionBy())))
    return must_hold(out, F.col("n_all") == kernels, f"sample must hold {kernels} vectors").select(
        F.col("cid").alias("center_id"), "x", "y")


def initial_centers(vectors: DataFrame, vocab: Sequence[str], spread: int,
                    kernels: int = DEFAULT_KERNELS, seed: int = DEFAULT_SEED) -> DataFrame:
    """Per-tag sample when tags are far apart, global sample otherwise."""
    if spread < GLOBAL_SAMPLE_BELOW_SPREAD:
        return number_centers(sample_vectors_global(vectors, kernels, seed), kernels)
    return sample_vectors(vectors, len(check_vocab(vocab)), kernels, seed)


def collect_centers(centers: DataFrame) -> Centers:
    """The k centre rows to the driver (k is a bounded parameter)."""
    return sorted((int(r[0]), int(r[1]), int(r[2])) for r in centers.select("center_id", "x", "y").collect())


#: Distinct x of the points, and pieces of their lines, up to which the bands travel in the plan.
MAX_LINES = 4_096
MAX_PIECES = 1 << 20


def lines_of(points: DataFrame, centers: Centers) -> list[int] | None:
    """The distinct x of the points, the lines that they lie on (for score
    vectors one for each tag); None if there are more than `MAX_LINES`, or so
    few centres that their distances are as quick."""
    if len(centers) <= UNROLLED:
        return None
    found = points.select("x").distinct().limit(MAX_LINES + 1).collect()
    return sorted(int(r[0]) for r in found) if len(found) <= MAX_LINES else None


def assign(points: DataFrame, centers: Centers, lines: Sequence[int] | None = None) -> DataFrame:
    """Points with the id of their nearest centre (ties: lower id).

    With the `lines` that the points lie on, each line's pieces (see `bands`)
    stand one after another in one table, and a point's piece is found by
    bisection over (x, y): about log2(lines * k) steps of plain arithmetic,
    whatever k is. The steps are projections of their own, which share one
    stage's generated code; conditions on the id stay above them. Without them, or where the table passes
    `MAX_PIECES`, all k distances are taken (`nearest_center`).
    """
    table = [(x, at, cid) for x in sorted(set(lines or [])) for at, cid in bands(x, centers)]
    if not table or len(table) > MAX_PIECES:
        return points.withColumn("center_id", nearest_center("x", "y", centers))
    xs, begins, ids = (F.split(F.lit(",".join(str(row[k]) for row in table)), ",").cast(f"array<{kind}>")
                       for k, kind in enumerate(("bigint", "bigint", "int")))
    found = points.withColumn("_at", F.lit(0))
    step = 1 << (len(table) - 1).bit_length() >> 1
    while step:  # the last piece that begins at or before the point
        there = F.col("_at") + F.lit(step)
        line = F.get(xs, there)
        before = (line < F.col("x")) | ((line == F.col("x")) & (F.get(begins, there) <= F.col("y")))
        found = found.withColumn("_at", F.when(before, there).otherwise(F.col("_at")))
        step >>= 1
    return found.select(*points.columns, once(F.get(ids, F.col("_at"))).alias("center_id"))


def kmeans_assign(points: DataFrame, centers: Centers) -> DataFrame:
    """(center_id, n): weight of the points closest to each centre."""
    return assign(points, centers, lines_of(points, centers)).groupBy("center_id").agg(F.sum("w").cast("bigint").alias("n"))


def _centroids(points: DataFrame, centers: Centers, lines: Sequence[int] | None = None) -> DataFrame:
    """(center_id, x, y) integer centroids of the non-empty clusters:
    per-axis weighted sum divided by the weight, truncated."""
    return (assign(points, centers, lines).groupBy("center_id")
            .agg(int_div(F.sum(F.col("x") * F.col("w")), F.sum("w")).alias("x"),
                 int_div(F.sum(F.col("y") * F.col("w")), F.sum("w")).alias("y")))


def kmeans_step(points: DataFrame, centers: Centers) -> DataFrame:
    """One update: (center_id, x, y) new centres; an empty cluster keeps its
    old centre."""
    rows = ", ".join(f"named_struct('center_id', {int(c)}, 'x', {int(x)}L, 'y', {int(y)}L)" for c, x, y in centers)
    old = points.sparkSession.range(0, 1, 1, 1).select(F.expr(f"inline(array({rows}))"))
    new = _centroids(points, centers, lines_of(points, centers))
    return (old.join(new.select("center_id", F.col("x").alias("nx"), F.col("y").alias("ny")), "center_id", "left")
            .select("center_id", F.coalesce("nx", "x").alias("x"), F.coalesce("ny", "y").alias("y")))


def movement(a: Sequence[tuple[int, int]], b: Sequence[tuple[int, int]]) -> float:
    """Sum over centres of the squared distance between old and new."""
    if len(a) != len(b):
        raise ValueError("centre lists differ in length")
    return float(sum((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 for p, q in zip(a, b)))


def converged(distance: float, eta: float = DEFAULT_ETA) -> bool:
    """The stop test: total movement strictly below `eta`."""
    return distance < eta


@dataclass
class KMeansResult:
    centers: Centers
    iterations: int
    moved: float
    # (iteration, center_id, x, y, new_x, new_y, moved) per centre and round
    trace: list[tuple[int, int, int, int, int, int, float]] = field(default_factory=list)

    def centers_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.centers, "center_id int, x bigint, y bigint")

    def trace_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.trace, "iteration int, center_id int, x bigint, y bigint, new_x bigint, new_y bigint, moved double")

    def totals_frame(self, spark) -> DataFrame:
        per_round: dict[int, float] = {}
        for it, _, x, y, nx, ny, _m in self.trace:
            per_round[it] = per_round.get(it, 0.0) + float((nx - x) ** 2 + (ny - y) ** 2)
        return spark.createDataFrame(sorted(per_round.items()), "iteration int, moved double")


# The debug trace lines of a k-means round and of the cap.
ROUND_HEADER = "Iteration: {it}\n  * current distance: {total}\n  * desired distance: {eta}\n  * means:"
ROUND_CENTER = "   {old:>20} ==> {new:>20}    distance: {moved:8.0f}"
CAP_MESSAGE = "Reached max iterations!"


def _print_round(it: int, total: float, eta: float, old: Centers, new: Centers) -> None:
    """Debug trace of one round: totals, then old ==> new per centre."""
    print(ROUND_HEADER.format(it=it, total=total, eta=eta))
    for (_, x, y), (_, nx, ny) in zip(old, new):
        moved = float((nx - x) ** 2 + (ny - y) ** 2)
        print(ROUND_CENTER.format(old=f"({x},{y})", new=f"({nx},{ny})", moved=moved))


class SavedRun:
    """The state of a k-means run in a folder of the cluster's shared store: its
    weighted points, its parameters, and each round's centres, a small table
    a round, committed whole by Spark's writer. A driver that is started
    again with the same folder goes on after the last round."""

    SCHEMA = ("iteration int, center_id int, x bigint, y bigint, new_x bigint, new_y bigint, moved double, "
              "run string")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _committed(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def points(self, build: Callable[[], DataFrame]) -> DataFrame:
        """The run's weighted points: as saved, or `build`'s, which are saved now."""
        if not self._committed("points"):
            build().select("x", "y", "w").write.mode("overwrite").parquet(f"{self.path}/points")
        return self.spark.read.schema("x bigint, y bigint, w bigint").parquet(f"{self.path}/points")

    def rounds(self, run: str) -> list[tuple]:
        """The trace of the rounds saved so far, in order; they must be of this `run`."""
        trace: list[tuple] = []
        n = 1
        while self._committed(f"rounds/{n}"):
            rows = self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/rounds/{n}").collect()  # k rows
            if {r["run"] for r in rows} != {run}:
                raise ValueError(f"{self.path} holds a run with other centres or parameters")
            trace += sorted(tuple(r)[:-1] for r in rows)
            n += 1
        return trace

    def add(self, run: str, n: int, rows: list[tuple]) -> None:
        frame = self.spark.createDataFrame([(*r, run) for r in rows], self.SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.path}/rounds/{n}")


def kmeans(points: DataFrame, centers: Centers, eta: float = DEFAULT_ETA,
           max_iterations: int = DEFAULT_MAX_ITERATIONS, checkpoint: bool = True,
           debug: bool = False, saved: SavedRun | None = None) -> KMeansResult:
    """Iterate assign + integer centroids until the total squared movement
    is below `eta` (the new centres are returned) or `max_iterations`
    updates have run.

    The weighted points are checkpointed once into `spark.checkpoint.dir`
    (lineage cut, survives executor loss; pass `checkpoint=False` when they
    already are); every round is then one small aggregate over them whose k
    result rows come back to the driver.

    With `saved` the points and each round's centres are kept in its folder,
    so a run whose driver is lost goes on where it was, with the same result.
    The folder belongs to one run: other initial centres or another eta are an error.
    """
    if not centers:
        raise ValueError("no initial centres")
    current = sorted(centers)
    run = hashlib.md5(repr((current, float(eta))).encode()).hexdigest()
    if saved is not None:
        pts = saved.points(lambda: points)
        trace = saved.rounds(run)
    else:
        pts = points.select("x", "y", "w")
        pts = materialize(pts) if checkpoint else pts
        trace = []
    lines = lines_of(pts, current)
    it, total = 0, float("inf")
    while True:
        it += 1
        done = trace[(it - 1) * len(current):it * len(current)]
        if done:
            updated = [(row[1], row[4], row[5]) for row in done]
        else:
            found = {int(r["center_id"]): (int(r["x"]), int(r["y"])) for r in _centroids(pts, current, lines).collect()}
            updated = [(cid, *found.get(cid, (x, y))) for cid, x, y in current]
            done = [(it, cid, x, y, nx, ny, float((nx - x) ** 2 + (ny - y) ** 2))
                    for (cid, x, y), (_, nx, ny) in zip(current, updated)]
            trace += done
            if saved is not None:
                saved.add(run, it, done)
        total = movement([c[1:] for c in current], [c[1:] for c in updated])
        if debug:
            _print_round(it, total, eta, current, updated)
        current = updated
        if converged(total, eta):
            break
        if it >= max_iterations:
            if debug:
                print(CAP_MESSAGE)
            break
    return KMeansResult(current, it, total, trace[:it * len(current)])


#: Bits of a score that one pass of the median's histogram tells apart.
DIGIT_BITS = 16


def group_medians(values: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """(key, median): the exact weighted median of integers per key: the middle
    one, or the floored mean of the two middle ones.

    Rank selection by a radix histogram. The values' range (one small job)
    gives the number of digits of `DIGIT_BITS`; for each digit, the highest
    first, one pass counts a group's rows per digit among those that share
    the digits found so far, and a running total picks the digit in which a
    middle rank falls. So a buffer holds 2^16 counts a group, partially
    aggregated before the shuffle, however many distinct values there are:
    scores within 65,536 take one pass, any 32-bit range two. Rows without a
    value, or with a weight below 1, don't count.
    """
    rows = values.select(F.col(key).alias("g"), F.col(value).cast("bigint").alias("v"),
                         F.col(weight).cast("bigint").alias("w")).where("v is not null and w > 0")
    low, high = rows.agg(F.min("v"), F.max("v")).first()
    digits = max(1, -(-(high - low).bit_length() // DIGIT_BITS)) if low is not None else 1
    # places as differences to the middle of the range, so that none overflows
    base = 0 if low is None else (low + high + 1) // 2
    top = DIGIT_BITS * digits
    offset = F.col("v") - F.lit(base).cast("bigint")
    rank = lambda n: [int_div(n + F.lit(1), F.lit(2).cast("bigint")), int_div(n, F.lit(2).cast("bigint")) + 1]
    sought = None  # (g, which, rank, prefix): the middle ranks, and the digits found
    for d in range(digits):
        shift = top - DIGIT_BITS * (d + 1)
        digit = F.shiftright(offset, shift) if shift < 64 else F.lit(0).cast("bigint")
        if sought is None:
            group = Window.partitionBy("g")
            counted = rows.groupBy("g", digit.alias("digit")).agg(F.sum("w").alias("n"))
            found = counted.withColumn("before", F.sum("n").over(group.orderBy("digit")) - F.col("n")).withColumn(
                "size", F.sum("n").over(group)).withColumn("which", F.explode(F.array(F.lit(0), F.lit(1))))
            first, second = rank(F.col("size"))
            found = found.withColumn("rank", F.when(F.col("which") == 0, first).otherwise(second))
        else:
            known = F.broadcast(sought.withColumnsRenamed({"g": "_g"}))  # two rows for each group
            near = F.col("g").eqNullSafe(F.col("_g")) & (F.shiftright(offset, shift + DIGIT_BITS) == F.col("prefix"))
            counted = (rows.join(known, near)
                       .groupBy("g", "which", "rank", digit.alias("digit")).agg(F.sum("w").alias("n")))
            upto = F.sum("n").over(Window.partitionBy("g", "which").orderBy("digit"))
            found = counted.withColumn("before", upto - F.col("n"))
        sought = (found.where((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n")))
                  .select("g", "which", (F.col("rank") - F.col("before")).alias("rank"), F.col("digit").alias("prefix")))
    middles = sought.groupBy("g").agg(F.min("prefix").alias("a"), F.max("prefix").alias("b"))
    half = F.col("a") + int_div(F.col("b") - F.col("a"), F.lit(2).cast("bigint"))
    return middles.select(F.col("g").alias(key), (half + F.lit(base).cast("bigint")).alias("median"))


def cluster_results(points: DataFrame, centers: Centers, vocab: Sequence[str],
                    spread: int) -> DataFrame:
    """(center_id, label, percent, size, median) per non-empty cluster,
    ordered by median then centre.

    label: the most common tag of the cluster (ties: first in vocabulary;
    null when no point carries a vocabulary tag); percent: its share of the
    cluster in percent; size: number of vectors; median: middle score, the
    integer mean of the two middles for even sizes.

    One aggregate per centre, with map-side combine: the size and one
    conditional count per tag (tag = x div spread; the vocabulary is bounded,
    so this is a fixed number of columns). Medians go by `group_medians`.
    """
    vocab = check_vocab(vocab)
    points = points.select("x", "y", "w")
    assigned = assign(points, centers, lines_of(points, centers))
    per_tag = [F.expr(f"sum(IF(x div {int(spread)} = {i}, w, 0)) AS n{i}") for i in range(len(vocab))]
    totals = assigned.groupBy("center_id").agg(F.sum("w").alias("size"), *per_tag)
    tops = [f"named_struct('n', n{i}, 'neg_idx', {-i})" for i in range(len(vocab))]
    top = F.expr(f"greatest({', '.join(tops)})" if len(tops) > 1 else tops[0])
    label = F.when(F.col("top.n") > 0, F.element_at(vocab_array(vocab), 1 - F.col("top.neg_idx")))
    medians = F.broadcast(group_medians(assigned, "center_id", "y", "w"))  # a row for each centre
    summary = totals.select("center_id", top.alias("top"), "size").join(medians, "center_id").select(
        "center_id",
        label.alias("label"),
        (F.lit(100.0) * F.col("top.n") / F.col("size")).alias("percent"),
        F.col("size").cast("bigint").alias("size"), "median")
    return sort_bounded(summary, "median", "center_id")  # at most k rows


# The report line format and header of the cluster report.
REPORT_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
REPORT_HEADER = ["Resulting clusters:",
                 "  Score  Dominant language (%percent)  Questions",
                 "================================================"]


def cluster_report(results: DataFrame) -> DataFrame:
    """(line): one formatted line per cluster, in the order of `results`."""
    return results.select(F.format_string(REPORT_FORMAT, "median", "label", "percent", "size").alias("line"))


def print_results(results: DataFrame) -> None:
    """Header and one line per cluster on stdout (k rows)."""
    print("\n".join(REPORT_HEADER + [r.line for r in cluster_report(results).collect()]))
