"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder that iterative jobs cut lineage into.

On a cluster the session comes from the launcher; nothing here overrides
settings that are already present.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the local session starts with. On a cluster these come from the
# submit configuration instead; AQE re-plans joins and coalesces partitions at
# run time, skew-join splits hot partitions of a sort-merge join.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", app: str = "quire", driver_memory: str = "16g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A `local[cpus]` session with the settings above (tests, bench)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", driver_memory))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session without one gets a fresh folder of its own;
    on a cluster a missing setting is an error, because a machine-local
    folder does not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, removed when the
    driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire/{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
