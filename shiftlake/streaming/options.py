"""Options of a streaming run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


@dataclass(frozen=True)
class StreamOptions:
    """``interval_seconds`` of None processes what is there and stops.

    ``single_batch`` stops after one micro-batch. State with a time to live
    needs it in a run that is to end: processing time always goes on, so such
    a query never runs out of work by itself.

    The checkpoint folder has to be given in run mode prod; it holds offsets,
    state and carried rows, so it belongs on storage shared by all executors.
    """

    checkpoint: str | None
    run_mode: str = "test"
    interval_seconds: int | None = None
    single_batch: bool = False

    def __post_init__(self) -> None:
        if self.run_mode.lower() == "prod" and not self.checkpoint:
            raise ValueError("a prod run needs a checkpoint folder")

    def apply(self, df: DataFrame) -> DataStreamWriter:
        writer = df.writeStream
        if self.checkpoint:
            writer = writer.option("checkpointLocation", self.checkpoint)
        if self.single_batch:
            return writer.trigger(once=True)
        if self.interval_seconds is None:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=f"{self.interval_seconds} seconds")
