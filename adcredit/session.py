"""Session defaults and the shared scratch location."""

from __future__ import annotations


import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on sizes measured at run time (AQE), never on planner
    # estimates, which can be far off after aggregations at scale.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Small shuffles stay spread over the cores instead of collapsing into
    # one task; large ones are sized by the 64 MB advisory target as usual.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # no Python call-site capture per Column (a debugging aid; costly on the driver)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "adcredit",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """DATE(ts) and 7-day arithmetic are defined on UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def state_partitions(spark: SparkSession, per_core: int = 2):
    """Start streaming queries inside: their state gets at most ``per_core`` partitions a core.

    Every store of every state partition commits files in every micro-batch, however few rows changed, so that
    partitions counted for the shuffles of a large batch job cost a stream more than its rows do. A
    query takes the number when it starts, and its checkpoint keeps it; only the start belongs inside.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), per_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session (one JVM, tests) that names none gets a fresh private
    folder. On a cluster a machine-local folder would scatter the files over the executors'
    own disks, so a missing setting raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="adcredit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "ensure_utc", "state_partitions", "checkpoint_root", "shared_dir"]


