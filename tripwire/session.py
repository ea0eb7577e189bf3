"""Session settings and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC because alert times carry a literal `Z`.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Small buffers (a window's count, countries, latest row): hash far more than 128 groups
    # before falling back to sorting the input.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tripwire", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the engine's settings. `master` and partition count are
    only set when given: on a cluster they come from the deployment."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Runtime-settable part of BASE_CONF, for sessions built elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.objectHashAggregate.sortBased.fallbackThreshold",
                # State with timers (`suppress_repeats_stream`) needs this store; a checkpoint keeps its own.
                "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(key, BASE_CONF[key])


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    Taken from `spark.checkpoint.dir` (set by the cluster). Only a local session, as in
    tests, gets a fresh folder when it is unset; a cluster session raises.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tripwire-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)
