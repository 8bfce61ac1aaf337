"""Session helpers: the settings every job relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the marts depend on. Timestamps are wall-clock UTC (the source
# database ran in UTC), so bucketing must not shift with the session zone.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Streaming state lives in RocksDB (off-heap, spills to local disk, checkpointed
# incrementally) rather than in executor heap maps.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_rocksdb_state(spark: SparkSession) -> None:
    """Make RocksDB the state store for streams started from now on, unless the
    session already chose a non-default provider. A query keeps the provider
    recorded in its checkpoint."""
    key = "spark.sql.streaming.stateStore.providerClass"
    cur = spark.conf.get(key, None)
    if cur in (None, "", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        for k, v in STATE_STORE_DEFAULTS.items():
            spark.conf.set(k, v)


def build_session(app: str = "meterflow", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SQL_DEFAULTS)
    conf.update(STATE_STORE_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark, keep=set(extra or {}))
    return spark


def prepare(spark: SparkSession, keep: set[str] | None = None) -> SparkSession:
    """Pin the runtime SQL settings the library needs on an existing session
    (settings named in ``keep`` are left as the caller chose them)."""
    for k, v in SQL_DEFAULTS.items():
        if k not in (keep or ()) and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` names the shared, fault-tolerant folder on a
    cluster; it is read from the session. Only when it is unset (local tests)
    is a private temporary folder created and registered.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local context
        sc = None
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc is None or not sc.master.startswith("local"):
            # A machine-local folder is invisible to other executors and lost with the host.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        base = tempfile.mkdtemp(prefix="meterflow-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, *parts, uuid.uuid4().hex)


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage
    (never a local checkpoint): later branches read the written copy."""
    work_dir(df.sparkSession)   # makes sure a checkpoint folder is set (tests only)
    return df.checkpoint(eager=True)
