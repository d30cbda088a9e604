"""Session settings and the shared checkpoint location.

The library never invents storage on a cluster: iterative operators cut
lineage with ``DataFrame.checkpoint()`` into the folder named by
``spark.checkpoint.dir``.  Only a local-mode session without that setting
(tests, a laptop) gets a scratch folder of its own.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every digest job relies on (UTC dates, AQE re-planning, Arrow
# batches for the few grouped-pandas steps, dynamic partition overwrite for
# the per-day report sink).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # per-digest top-k filters up to this size are planned as a map-side
    # WindowGroupLimit (partial top-k before the shuffle, no full group sort)
    "spark.sql.optimizer.windowGroupLimitThreshold": "40000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gazette") -> SparkSession:
    """A local-mode session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "before running iterative digest operators on a cluster"
        )
    path = tempfile.mkdtemp(prefix="gazette-ckpt-")
    sc.setCheckpointDir(path)
    return path
