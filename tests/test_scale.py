"""Work that has to spread over tasks, and results that must not change by it."""

import datetime as dt

from pyspark.sql import functions as F

from shiftlake.plans.streams import cut_stream
from shiftlake.session import prepare
from shiftlake.streaming.options import StreamOptions


def test_cut_stream_spreads_a_micro_batch(spark, tmp_path):
    """Several files per micro-batch, also where a part of the time has few rows or none, and no batch takes rows of the next."""
    start = dt.datetime(2024, 1, 1)
    seconds = [*range(100), 350, None, 399]                       # four parts of 100 seconds; no time goes to the last
    rows = [(n, None if s is None else start + dt.timedelta(seconds=s)) for n, s in enumerate(seconds)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp")
    seen = {}

    def keep(batch, batch_id):
        seen[batch_id] = (batch.rdd.getNumPartitions(), sorted(r.event_id for r in batch.collect()))

    stream = cut_stream(events, "cut", parts=4, file_rows=6)
    StreamOptions(str(tmp_path / "checkpoint")).apply(stream).foreachBatch(keep).start().awaitTermination()
    assert [ids for _, ids in seen.values()] == [[*range(100)], [], [], [100, 101, 102]]
    assert seen[0][0] > 1


def test_wide_rows_run_in_compiled_code(spark):
    """Methods over 8,000 bytes of bytecode run interpreted for ever; a prepared session does not let Spark make any."""
    assert int(prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
