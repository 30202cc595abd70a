"""Session construction and the shared scratch location.

Library code never invents a machine-local folder: scratch data and
stream checkpoints live under the session's ``spark.checkpoint.dir`` (a
shared folder on a cluster). Only when that setting is absent, as in a
bare local test session, is a default filled in.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

LOCAL_FALLBACK_CHECKPOINT_DIR = "/tmp/courtside-checkpoints"


def build_session(app: str = "courtside", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests, the bench and scripts. On a cluster the
    submitter's settings win; only unset values get these defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return root or ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Fill in ``spark.checkpoint.dir`` only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = LOCAL_FALLBACK_CHECKPOINT_DIR
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "courtside", f"{name}-{uuid.uuid4().hex[:12]}")
