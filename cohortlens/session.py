"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every stage assumes. AQE re-plans joins (broadcast vs sort-merge)
# and splits skewed join partitions at run time; UTC keeps calendar fields of
# any zone-aware input stable (all library date arithmetic is zone-free).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a cluster reading ~100 TB, applied only on a non-local master
# and only to keys the deployment did not set (spark-submit / builder):
# 512 MiB scan splits (~200 k scan tasks for 100 TB); a high initial shuffle
# partition count for the first, fact-sized shuffle (cleaning's dedup,
# RFM's per-invoice aggregate), which AQE coalesces to ~256 MiB partitions
# for every smaller shuffle after it; skewed join partitions above 1 GiB
# are split. Broadcast stays at Spark's 10 MiB default: every dimension
# broadcast is size-checked against it (``sources/sizing.py``).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def apply_cluster_sizing(spark: SparkSession) -> dict[str, str]:
    """Set ``CLUSTER_CONF`` keys the deployment left unset (non-local
    masters only); returns what was set."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return {}
    conf = sc.getConf()
    applied = {k: v for k, v in CLUSTER_CONF.items() if not conf.contains(k)}
    for k, v in applied.items():
        spark.conf.set(k, v)
    return applied


def build_session(
    master: str | None = None,
    app_name: str = "cohortlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_cluster_sizing(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when nothing is configured and the master is local (tests)
    do we create a scratch folder; a cluster without the setting is an
    error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: stage tables and checkpoints need "
            "a folder shared by the cluster (e.g. on HDFS or an object store)"
        )
    target = conf_dir or tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target
