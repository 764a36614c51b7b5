"""Written tables in the shared folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_SHARED = "/tmp/shiftlake-shared"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only a session with a local master may leave the setting out.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return LOCAL_SHARED


def fresh_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def staged(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
