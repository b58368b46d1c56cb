"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import re
import tempfile

import anchorframe
from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Runtime SQL settings.  The skew-join switch is forced because a join on the
# entity key followed by an aggregation on the same key would otherwise keep a
# hot entity in one task: with it, the hot partition is split, each split
# pre-aggregates, and only the partial results meet again.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    # Python tasks carry the library's functions with them, so executors need no copy of it.
    cloudpickle.register_pickle_by_value(anchorframe)
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(master)
        .appName("anchorframe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that spark.checkpoint.dir names; all executors must share it.

    Only a local session, whose tasks run in this process, may do without; it gets a folder that goes when Python ends.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not re.fullmatch(r"local(\[[^-\]]*\])?", sc.master):
                raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
            own = tempfile.TemporaryDirectory(prefix="anchorframe-checkpoint-")
            atexit.register(own.cleanup)
            shared = own.name
        sc.setCheckpointDir(shared)
