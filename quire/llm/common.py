"""Helpers the operators share: scratch tables in the cluster's shared folder,
running totals in two levels, and connected components of an edge table."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import quire
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.session import ensure_checkpoint_dir

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per context, so
    that tasks can import it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_quire_shipped", False):
        return
    root = Path(quire.__file__).resolve().parent
    handle, archive = tempfile.mkstemp(prefix="quire-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._quire_shipped = True


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """`df.mapInArrow(run, schema)` with the package on the workers, in batches
    of about `BATCH_BYTES` unless the session sets their size itself: an
    executor and its worker hold several batches a task, outside of the heap."""
    ship_package(df.sparkSession)
    conf = df.sparkSession.conf
    if BATCH_CONF not in conf.getAll:
        conf.set(BATCH_CONF, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, removed when the
    driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: lineage is
    cut, and a lost executor costs no recomputation beyond the write."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """`df` with its columns called c0, c1, ..., which no operator's own clash with."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> str:
    """What `numbered` calls the column `name` of `df`."""
    return f"c{[c.lower() for c in df.columns].index(name.lower())}"


def renamed(df: DataFrame, like: DataFrame, outputs: tuple[str, ...]) -> DataFrame:
    """The columns of `like` under their old names, and the operator's outputs,
    which replace columns of the same name (case-insensitive, as in Spark)."""
    taken = {n.lower() for n in outputs}
    old = [F.col(f"c{i}").alias(c) for i, c in enumerate(like.columns) if c.lower() not in taken]
    return df.select(*old, *outputs)


def running_start(parts: DataFrame, part: str, order: list[str], value: str, out: str,
                  group: list[str] | None = None) -> DataFrame:
    """`parts` with the exclusive running total of `value` over (part, order)
    within `group`, as column `out`; part and group columns hold no nulls.

    Two levels: totals per part are summed in one small window (a row per
    part and group), and each part's rows in a window of their own, so no
    window holds more than one part.
    """
    keys = [*(group or []), part]
    totals = parts.groupBy(*keys).agg(F.sum(value).alias("_total"))
    over_parts = Window.partitionBy(*[F.col(g) for g in group or []] or [F.lit(0)]).orderBy(part)
    bases = totals.select(*keys, (F.sum("_total").over(over_parts) - F.col("_total")).alias("_base"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = parts.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (inner.join(bases, keys).withColumn(out, (F.col("_base") + F.col("_within")).cast("long"))
            .drop("_base", "_within"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edge table (a, b): root is the
    smallest node reachable.

    Alternating large-star and small-star rounds. Every round is a grouped
    minimum (partially aggregated before its shuffle) joined back to the
    edges, and never makes more edges than it read; each round's edges are
    written to the shared folder, so plans stay short. A star forest is the
    fixed point, and the number of rounds is logarithmic in the longest path.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.where("a <> b").distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())

    current = scratch_table(clean(edges.where("a is not null and b is not null")
                                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))), "edges")
    seen = state(current)
    while seen[0]:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = clean(both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")))
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).unionAll(
            least.select(F.col("m").alias("a"), "b"))
        current = scratch_table(clean(small), "edges")
        now = state(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionAll(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of each pair (i, j); a class's label is its least row."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while (deeper := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = deeper
