"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a live session.  Skew handling is forced on:
# a hot key is expected, and one more exchange is cheaper than one huge task.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# For views: files are read and adaptive shuffles end in parts of a stated size, so larger inputs give more tasks and no larger
# ones.  Stateful streams keep ``spark.sql.shuffle.partitions``, as they run without adaptive planning.
SPREAD_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def tune(spark: SparkSession, conf: Mapping[str, str] = RUNTIME_CONF) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a
    local master may fall back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tidemill-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For a view that several later steps read, such as the right side of an
    as-of join: it is computed once and survives the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
