"""Topic sinks: JSON texts to a broker, or to files where there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_json(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``value`` (inside ``foreachBatch``, or of a whole table)."""
    df.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_topic_files(df: DataFrame, folder: str, topic: str, batch_id: int | None = None) -> None:
    """File twin: one folder per topic and batch, overwritten when a batch is replayed."""
    name = f"{folder}/{topic}" if batch_id is None else f"{folder}/{topic}/batch={batch_id}"
    df.select("value").write.mode("overwrite" if batch_id is not None else "append").text(name)


def debug_print(df: DataFrame, run_mode: str, rows: int = 20) -> None:
    """Show a few rows unless the run mode is prod."""
    if run_mode.lower() != "prod":
        df.show(rows, truncate=False)
