"""Session helpers shared by the jobs, the bench and the tests."""

from __future__ import annotations

import os
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Wall-clock strings are plant-local; the session zone only has to be one
# without daylight saving, so that intervals and slices are regular.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a longer method: rows of a hundred columns would run interpreted. Beyond it Spark
    # generates a projection of many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Where a local session shares files when its configuration names no folder.
LOCAL_SHARED = "/tmp/shiftlake-shared"


def local_session(cpus: int | str = 8, memory: str = "12g", **settings: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shiftlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.python.unix.domain.socket.enabled", "true")
        # Recording the call site of every expression costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SESSION_CONF, **settings}.items():
        builder = builder.config(key, value)
    if not SparkConf().get("spark.checkpoint.dir", None) and "spark.checkpoint.dir" not in settings:
        builder = builder.config("spark.checkpoint.dir", LOCAL_SHARED)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on, on a session made elsewhere."""
    for key, value in {**SESSION_CONF, **STATE_STORE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. The setting cannot be
    made on a running session; ``local_session`` makes it in the builder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("start the session with spark.checkpoint.dir: a folder that all executors share")
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")
