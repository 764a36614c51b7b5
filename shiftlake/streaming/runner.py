"""Run a stateless job on a stream: every micro-batch through the job, its outputs to sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..sinks.files import ControlFiles
from .options import StreamOptions

Outputs = DataFrame | dict[str, DataFrame]


def run_job(feed: DataFrame, job: Callable[[DataFrame], Outputs], sinks: dict[str, Callable[[DataFrame, int], object]],
            options: StreamOptions) -> DataStreamWriter:
    """``job`` returns one frame (sink name ``out``) or a frame per name.

    Sinks get the batch id, so that a replayed batch can be recognized. The
    raw batch is kept while several sinks read it.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        several = len(sinks) > 1
        if several:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            result = job(batch)
            outputs = result if isinstance(result, dict) else {"out": result}
            for name, sink in sinks.items():
                sink(outputs[name], batch_id)
        finally:
            if several:
                batch.unpersist()

    return options.apply(feed).foreachBatch(each)


class CommittedSinks:
    """Several targets that show a micro-batch together or not at all.

    Each target has a folder per batch, and a marker is written after all of
    them; readers follow the markers. A batch that stopped between two targets
    has no marker: its replay overwrites what was written, so nothing is missing
    and nothing twice. A batch with a marker is left alone.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self._marks = ControlFiles(spark, f"{self._root}/marks", "batch")

    def write(self, outputs: dict[str, DataFrame], batch_id: int) -> bool:
        """Returns False when the batch had been committed before."""
        if batch_id in self._marks.numbers():
            return False
        for name, rows in outputs.items():
            rows.write.mode("overwrite").parquet(f"{self._root}/{name}/{batch_id}")
        self._marks.write(batch_id, {"targets": sorted(outputs)})
        return True

    def read(self, name: str) -> DataFrame | None:
        """Rows of the committed batches, or None before the first."""
        folders = [f"{self._root}/{name}/{n}" for n in self._marks.numbers() if name in self._marks.read(n)["targets"]]
        return self._spark.read.parquet(*folders) if folders else None


def run_fan_out(feed: DataFrame, job: Callable[[DataFrame], dict[str, DataFrame]], sinks: CommittedSinks,
                options: StreamOptions) -> DataStreamWriter:
    """``job`` returns a frame per target; the batch is computed once for all of them."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sinks.write(job(batch), batch_id)
        finally:
            batch.unpersist()

    return options.apply(feed).foreachBatch(each)
