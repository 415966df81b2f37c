"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  AQE re-plans joins and
# coalesces/splits shuffle partitions at runtime; skew-join splits a hot key
# into several tasks.  The UI stays off (it is a web server).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quarry") -> SparkSession:
    """Return the active session or build one with the library defaults.

    On a cluster the submitter supplies master and resources; locally we fall
    back to ``local[*]``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("SPARK_MASTER", "local[*]"))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; we only invent one (a
    fresh local folder) when nothing is configured, i.e. in local tests.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")     # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df, min_partitions: int | None = None):
    """Round-robin repartition a frame whose scan yields fewer partitions
    than the cluster can run at once, before CPU-heavy per-row work
    (tokenising, regex, JSON).  A large input already arrives in many
    splits, so on a cluster this is a no-op."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def ship_package(spark: SparkSession) -> str:
    """Zip this package and add it to the job, so that Python workers without
    an installed copy can import it.  Returns the archive's path."""
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-ship-"), "quarry.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)          # served by the driver to every executor
    return path
