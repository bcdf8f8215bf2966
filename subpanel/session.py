"""Session helpers: engine settings and the reliable checkpoint folder.

Nothing here creates hidden work. ``checkpoint_dir`` reads the cluster's
``spark.checkpoint.dir``; only a local-mode session (tests, the bench) gets a
scratch folder of its own when the setting is absent.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Engine settings every job in this package assumes. AQE re-plans joins and
# coalesces shuffle partitions at runtime, and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "subpanel", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's engine settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session conf.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local folder is only acceptable in
    local mode, where executors and driver share one disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running iterative or ranking operators")
        base = os.environ.get("TMPDIR", "/tmp")
        configured = tempfile.mkdtemp(prefix="subpanel-ckpt-", dir=base)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df):
    """Cut lineage by writing ``df`` to the reliable checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df):
    """``df`` written once as Parquet beside the checkpoints and read from there.

    For steps of a loop: unlike a checkpointed frame, which hands on the size
    estimate of the plan it came from (a product that grows with every join of
    every round), a file is planned by its own size.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "steps", spark.sparkContext.applicationId, uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_MATERIALIZED: dict = {}
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 16    # partitions that a task writes side by side, without sorting its rows first


def materialized(spark: SparkSession, sf_dir: str, name: str, build, partition_by=None):
    """Write ``build()`` once per session and input folder as parquet in the
    reliable checkpoint folder, then serve reads of it.

    A shared intermediate (the panel, the scored customer frame) is computed
    once instead of once per query; reading it back cuts lineage (a lost
    executor re-reads files instead of re-running joins), and keeps column
    pruning and filter pushdown, with partition pruning on ``partition_by``.
    The tasks of the last join, sized by AQE, write their rows of each
    partition straight to its files, neither shuffled nor sorted for it while
    there are at most ``OPEN_FILES`` partitions. The path holds the
    application id, so jobs that share a folder don't share files.
    """
    import hashlib

    app = spark.sparkContext.applicationId
    key = (app, os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir, name)
    found = _MATERIALIZED.get(key)
    if found is None:
        digest = hashlib.sha1(key[1].encode()).hexdigest()[:12]
        path = os.path.join(checkpoint_dir(spark), "tables", app, digest, name)
        df = build()
        writer = df.write.mode("overwrite")
        if partition_by:
            before = spark.conf.get(WRITERS, "0")
            spark.conf.set(WRITERS, str(OPEN_FILES))
            try:
                writer.partitionBy(partition_by).parquet(path)
            finally:
                spark.conf.set(WRITERS, before)
        else:
            writer.parquet(path)
        found = _MATERIALIZED[key] = (path, df.schema)
    path, schema = found
    return spark.read.schema(schema).parquet(path)
