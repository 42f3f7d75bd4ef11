"""Session defaults and the shared folder every staged table is written to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL_DIR_KEY = "ledgerline.local.dir"

# What the plans rely on in any session, also one that ``build_session`` did not make.
PLAN_SETTINGS = {
    # The views join the large tables by location and partition columns; the buckets are by
    # location alone, which is enough to leave both where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Records are narrow when they are shuffled and grow tenfold in the task that reads them, where
    # they are sorted. Merged to the default 64 MB, such a sort would spill.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def build_session(app_name: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    ``spark.sql.shuffle.partitions`` and ``spark.sql.files.maxPartitionBytes``
    depend on cluster and data, so they are left to the caller (``conf``); AQE
    merges small shuffle partitions and splits the skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **PLAN_SETTINGS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(spark: SparkSession) -> SparkSession:
    """Give a session the settings of the plans, but for those that its owner chose."""
    chosen = spark.sparkContext.getConf()
    for key, value in PLAN_SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can read: the cluster's ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets one private
    temporary folder. A cluster without it is refused, because a folder on one
    machine is lost to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    local = spark.conf.get(_LOCAL_DIR_KEY, None)
    if local is None:
        local = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set(_LOCAL_DIR_KEY, local)
    return local
