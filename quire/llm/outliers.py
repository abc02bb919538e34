"""Quality rules by robust multivariate outliers, in DataFrame functions only.

Each text gets its base statistics inside its own row. Texts that pass the
base rules form a transformed statistic vector each; per language and source
the minimum covariance determinant estimate of that vector is found by
concentration steps: the half of the group nearest to the current centre gives
the next mean and covariance. Steps go on from each of `STARTS` until the
determinant no longer falls; the least determinant of a group's starts is its
estimate. A document goes when its squared Mahalanobis distance exceeds
`CUTOFF`.

A step is one aggregate over (group, start, distance bin): counts, sums and
products combine before the shuffle, so a group with a third of all documents
reaches the reducer as a few rows per task, and no group is gathered anywhere.
Of the bin that crosses the half only the missing fraction counts, so copies
in one bin can't enter as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import scratch_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
VECTOR = ["v1", "v2", "v3", "v4"]
#: Least standard deviation of each coordinate; statistics that hardly vary
#: within a group (no symbols, no repeats) would else make it singular.
LEAST_SD = [0.06, 0.03, 0.15, 0.15]
#: The estimate's share of a group of n: (n + dimensions + 1) / 2 documents.
COVERED = 0.5
#: (quantile of the start's centre, spread of its variances: the least ones or
#: those of the coordinates' quartiles).
STARTS = [(0.5, "least"), (0.5, "quartiles"), (0.25, "quartiles"), (0.75, "quartiles")]
#: A start has converged when a step lowers its log-determinant by no more.
LEAST_FALL = 1e-3
#: Squared distance, far beyond the 99.999 % point (28.5) of a chi-square with
#: four degrees of freedom: clean text has heavier tails than a normal.
CUTOFF = 50.0
#: Groups with fewer documents are pooled by language, then over all.
MIN_GROUP = 40
BINS_PER_E = 32
#: Rows of groups' parameters that are broadcast, by count; more meet the documents in a shuffle.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Runs of characters outside space and U+0009 to U+000D."""
    return F.filter(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), lambda w: w != "")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines) per row; a null text has no words."""
    c = {k: F.col(f"`{v}`") for k, v in
         {"doc_id": id_col, "text": text_col, "lang": lang_col, "source": source_col}.items()}
    text = F.coalesce(c["text"], F.lit(""))
    rows = docs.select(
        c["doc_id"].cast("long").alias("doc_id"), c["lang"].alias("lang"), c["source"].alias("source"),
        words_of(text).alias("w"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda s: F.length(F.translate(s, " \t\x0b\f\r", "")) > 0).alias("lines"))
    # three-word windows in order of their hash: equal windows are neighbours
    window = lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"),
                                i.alias("i"))
    rows = rows.select(
        "doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.size("w") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size("w") - 3), window)))
        .otherwise(F.expr("cast(array() as array<struct<h: bigint, i: int>>)")).alias("windows"))
    repeated = F.filter("windows", lambda x, k: (F.get("windows", k + 1)["h"] == x["h"])
                        | (F.get("windows", k - 1)["h"] == x["h"]))
    places = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.size(F.array_distinct(places)).cast("long").alias("n_repeat_words"), "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vectors(stats: DataFrame) -> DataFrame:
    """`stats` with base_failed and the transformed vector (null where it failed)."""
    def part(c: str) -> Column:
        return F.col(c) / F.col("n_words")

    v = [F.log(part("word_chars")), F.log1p(part("n_symbols")), F.sqrt(part("n_repeat_words")),
         F.sqrt(F.col("n_dup_lines") / F.col("n_lines"))]
    marked = stats.withColumn("base_failed", base_failed())
    return marked.select("*", *[F.when(~F.col("base_failed"), e).alias(n) for n, e in zip(VECTOR, v)])


def with_groups(marked: DataFrame) -> DataFrame:
    """`marked` with its estimation group `grp`: language and source; small
    ones pooled by language, then over all; null if still under MIN_GROUP."""
    counts = scratch_table(marked.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n")), "groups")
    small = F.when(F.col("n") < MIN_GROUP, F.col("n")).otherwise(0)
    pools = counts.groupBy(F.col("lang").alias("_l")).agg(F.sum(small).alias("pool"))
    counts = counts.join(pools, F.col("lang").eqNullSafe(F.col("_l"))).drop("_l")
    rest = F.when((F.col("n") < MIN_GROUP) & (F.col("pool") < MIN_GROUP), F.col("n")).otherwise(0)
    (left,) = counts.agg(F.coalesce(F.sum(rest), F.lit(0))).first()
    grp = (F.when(F.col("n") >= MIN_GROUP, F.to_json(F.struct("lang", "source")))
           .when(F.col("pool") >= MIN_GROUP, F.to_json(F.struct("lang")))
           .when(F.lit(left) >= MIN_GROUP, F.lit("all")))
    keys = few(counts.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), grp.alias("grp")), counts)
    return (marked.join(keys, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
            .drop("_l", "_s"))


def few(df: DataFrame, counted: DataFrame) -> DataFrame:
    """`df` to be broadcast, if `counted`, which has as many rows, is small."""
    return F.broadcast(df) if counted.count() <= BROADCAST_ROWS else df


def start(rows: DataFrame) -> DataFrame:
    """(grp, start, m1..m4, c11..c44, logdet, moving): the centres and variances
    of `STARTS`, from coordinate quartiles to a thousandth."""
    cells = rows.select("grp", F.posexplode(F.array(*VECTOR)).alias("k", "x"))
    cells = cells.groupBy("grp", "k", F.round(F.col("x") * 1000).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("grp", "k")
    cells = cells.select("grp", "k", "bin", (F.sum("n").over(w.orderBy("bin")) / F.sum("n").over(w)).alias("upto"))
    names = {0.25: "low", 0.5: "mid", 0.75: "high"}
    quartiles = cells.groupBy("grp", "k").agg(
        *[(F.min(F.when(F.col("upto") >= q, F.col("bin"))) / 1000).alias(n) for q, n in names.items()])
    spread = F.pow((F.col("high") - F.col("low")) / 1.349, F.lit(2.0))
    flat = quartiles.groupBy("grp").agg(
        *[F.max(F.when(F.col("k") == k, F.col(n))).alias(f"{n}{k + 1}") for k in range(len(VECTOR))
          for n in names.values()],
        *[F.max(F.when(F.col("k") == k, spread)).alias(f"s{k + 1}") for k in range(len(VECTOR))])

    def one(number: int, q: float, kind: str) -> Column:
        means = [F.col(f"{names[q]}{k + 1}").alias(f"m{k + 1}") for k in range(len(VECTOR))]
        cov = [(F.lit(LEAST_SD[i] ** 2 if i == j else 0.0) + (F.col(f"s{i + 1}") if i == j and kind == "quartiles"
                                                              else F.lit(0.0))).alias(f"c{i + 1}{j + 1}")
               for i, j in lower()]
        return F.struct(F.lit(number).alias("start"), *means, *cov, F.lit(float("inf")).alias("logdet"),
                        F.lit(True).alias("moving"))

    return flat.select("grp", F.inline(F.array(*[one(i, *s) for i, s in enumerate(STARTS)])))


def lower() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(VECTOR)) for j in range(i + 1)]


def with_factor(params: DataFrame) -> DataFrame:
    """The lower Cholesky factor l11..l44 of each start's covariance."""
    for i, j in lower():
        cell = F.col(f"c{i + 1}{j + 1}")
        for k in range(j):
            cell = cell - F.col(f"l{i + 1}{k + 1}") * F.col(f"l{j + 1}{k + 1}")
        cell = F.sqrt(F.greatest(cell, F.lit(1e-12))) if i == j else cell / F.col(f"l{j + 1}{j + 1}")
        params = params.withColumn(f"l{i + 1}{j + 1}", cell)
    return params.select(F.col("grp").alias("_grp"), "start", *[f"m{i + 1}" for i in range(len(VECTOR))],
                         *[f"l{i + 1}{j + 1}" for i, j in lower()])


def with_distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    """`rows` with the squared distance `d2` to the centre of each `start` of their group."""
    joined = rows.join(few(with_factor(params), params), F.col("grp") == F.col("_grp"), "left")
    for i, name in enumerate(VECTOR):
        z = F.col(name) - F.col(f"m{i + 1}")
        for k in range(i):
            z = z - F.col(f"l{i + 1}{k + 1}") * F.col(f"z{k + 1}")
        joined = joined.withColumn(f"z{i + 1}", z / F.col(f"l{i + 1}{i + 1}"))
    d2 = sum((F.col(f"z{i + 1}") * F.col(f"z{i + 1}") for i in range(1, len(VECTOR))), F.col("z1") * F.col("z1"))
    return joined.select(*rows.columns, "start", d2.alias("d2"))


def consistency(share: float = COVERED) -> float:
    """What the covariance of a normal's central `share` (four dimensions) must
    be multiplied by to estimate that of the whole."""
    lo, hi = 0.0, 100.0
    for _ in range(200):
        x = (lo + hi) / 2
        lo, hi = (x, hi) if 1 - math.exp(-x / 2) * (1 + x / 2) < share else (lo, x)
    return share / (1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8))


def concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step of each start that still moves: mean and
    covariance of the group's nearest half. A start whose determinant does not
    fall keeps its estimate and moves no more."""
    binned = with_distance(rows, params.where("moving")).where("start is not null").withColumn(
        "bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_E).cast("long"))
    sums = [F.sum(v).alias(f"s_{v}") for v in VECTOR]
    sums += [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"p{i + 1}{j + 1}") for i, j in lower()]
    bins = binned.groupBy("grp", "start", "bin").agg(F.count("*").alias("n"), *sums)
    w = Window.partitionBy("grp", "start")
    before = F.sum("n").over(w.orderBy("bin")) - F.col("n")
    half = F.floor((F.sum("n").over(w) + len(VECTOR) + 1) * COVERED)
    near = bins.withColumn("share", F.least(F.lit(1.0), (half - before) / F.col("n"))).where("share > 0")
    cols = [c for c in bins.columns if c not in ("grp", "start", "bin")]
    total = near.groupBy("grp", "start").agg(*[F.sum(F.col(c) * F.col("share")).alias(c) for c in cols])
    factor = consistency()
    mean = [(F.col(f"s_{v}") / F.col("n")).alias(f"m{i + 1}") for i, v in enumerate(VECTOR)]
    cov = [(factor * (F.col(f"p{i + 1}{j + 1}") / F.col("n")
                      - F.col(f"s_{VECTOR[i]}") * F.col(f"s_{VECTOR[j]}") / F.col("n") / F.col("n"))
            + (LEAST_SD[i] ** 2 if i == j else 0.0)).alias(f"c{i + 1}{j + 1}") for i, j in lower()]
    step = total.select("grp", "start", *mean, *cov)
    logdet = sum((2 * F.log(f"l{i}{i}") for i in range(2, len(VECTOR) + 1)), 2 * F.log("l11"))
    dets = with_factor(step).select(F.col("_grp").alias("grp"), "start", logdet.alias("logdet"))
    step = step.join(dets, ["grp", "start"]).withColumn("moving", F.lit(True))
    step = step.select(F.col("grp").alias("_grp"), F.col("start").alias("_start"),
                       F.struct(*params.columns[2:]).alias("step"))
    old = params.withColumn("moving", F.lit(False)).select("grp", "start", F.struct(*params.columns[2:]).alias("old"))
    met = old.join(step, (F.col("grp") == F.col("_grp")) & (F.col("start") == F.col("_start")), "left")
    fell = F.col("step.logdet") < F.col("old.logdet") - LEAST_FALL
    return met.select("grp", "start", F.when(fell, F.col("step")).otherwise(F.col("old")).alias("p")).select(
        "grp", "start", "p.*")


def estimates(rows: DataFrame) -> DataFrame:
    """(grp, start, m1..m4, c11..c44, logdet, moving): each group's estimate of
    least determinant, after all its starts have converged."""
    params = scratch_table(start(rows), "centres")
    while not params.where("moving").isEmpty():  # each step lowers a determinant, and the least variances bound it
        params = scratch_table(concentrate(rows, params), "centres")
    best = params.groupBy("grp").agg(F.min(F.struct("logdet", "start")).alias("best"))
    best = best.select(F.col("grp").alias("_grp"), F.col("best.start").alias("_start"))
    chosen = params.join(best, (F.col("grp") == F.col("_grp")) & (F.col("start") == F.col("_start")))
    return scratch_table(chosen.select(params.columns), "estimates")


def quality(docs: DataFrame, **columns: str) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance) per row of `docs`.

    A null or empty text has no words and fails the base rules. distance is
    the squared Mahalanobis distance, null where the base rules failed or the
    row's group is too small for an estimate; such a row of the latter kind is
    kept. Null languages and sources form groups of their own. Repeated rows
    and rows with a null doc_id are judged like any other. An empty table
    gives no rows. Other columns are not read.
    """
    marked = scratch_table(vectors(statistics(docs, **columns)), "statistics")
    grouped = with_groups(marked)
    rows = grouped.where("not base_failed and grp is not null").select("grp", *VECTOR)
    judged = with_distance(grouped, estimates(rows))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", kept.alias("kept"), F.col("d2").alias("distance"))
