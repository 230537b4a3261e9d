"""Session settings the library relies on, and the shared folder for written state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Instants are UTC inside the engine; Shanghai wall time appears only at the
# raw input and in result tables. Casts between the two rely on this zone.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated JSON key keeps its last value instead of failing the row.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Runs that take what is there go on until minutes are closed, also over sources in Python.
    "spark.sql.streaming.triggerAvailableNowWrapper.enabled": "true",
    # Upload state changes rather than whole snapshots at each commit.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings of the whole application, only at its start: a job that goes on for ever gives back the checkpoints
# that nothing refers to any more.
LAUNCH_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that someone else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "ordertide", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session. Cluster sizing (cores, memory, shuffle partitions) stays with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **LAUNCH_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables and checkpoints that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder, since there one machine holds
    driver and executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="ordertide-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
