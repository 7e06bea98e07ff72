"""Session and shared-storage helpers.

Library code never builds a SparkSession at import time; callers pass one in.
``local_session`` exists for tests, the bench and ad-hoc runs only.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cardwatch") -> SparkSession:
    """A local session for tests and benchmarks (cluster jobs get theirs from spark-submit)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in _BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) without one gets a private folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="cardwatch-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (the parent of the checkpoint directory).

    ``SparkContext.setCheckpointDir`` appends a random sub folder; written tables go next to
    it, under ``cardwatch/``, so every executor and every retry sees the same location.
    """
    ckpt = ensure_checkpoint_dir(spark).rstrip("/")
    root = ckpt.rsplit("/", 1)[0] if "/" in ckpt else ckpt
    return "/".join([root, "cardwatch", *parts])


def scope_of(sf_dir: str) -> str:
    """Stable short name for an input folder, so outputs of two inputs never collide."""
    name = os.path.basename(os.path.normpath(sf_dir))
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:8]
    return f"{name}-{digest}"
