"""Session settings the jobs rely on, and the checkpoint folder."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for a cluster run; a caller's session keeps any value it already set.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange
    # downstream (the flagship chains two joins on the same key).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Broadcast only what was measured: no broadcast from static estimates
    # (a file-size estimate is no bound on decompressed rows); AQE converts a
    # join to broadcast once the side's stage has run and its size is known.
    # Explicit broadcast() hints remain for sets bounded by construction.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Remove checkpoint files once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` (or a folder already set on the context).
    Only a local-mode session without one gets a scratch folder, as in tests;
    a cluster session without a shared folder is an error, because a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
        conf_dir = tempfile.mkdtemp(prefix="possum-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for the body's jobs; the caller's come back after it."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skew_split(spark: SparkSession):
    """Split hot join keys while the body's jobs run, whatever the caller's session says."""
    return settings(spark, {k: RECOMMENDED_CONF[k] for k in (
        "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.adaptive.forceOptimizeSkewedJoin")})


def apply_recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    return builder
