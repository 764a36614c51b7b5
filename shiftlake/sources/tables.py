"""Table sources: JDBC queries, CSV with declared columns, dimensions read again after a while."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.codes import quoted
from ..sinks.jdbc import JdbcTarget

log = logging.getLogger(__name__)

LOOKUP_REFRESH_SECONDS = 30 * 60
DEVICE_REFRESH_SECONDS = 12 * 3600


def jdbc_query(spark: SparkSession, target: JdbcTarget, query: str, fetch_size: int = 10_000,
               split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """Result of a query. ``split`` (column, low, high, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").options(**target.options()).option("fetchsize", fetch_size)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    return (reader.option("dbtable", f"({query}) q").option("partitionColumn", column)
            .option("lowerBound", low).option("upperBound", high).option("numPartitions", parts).load())


def csv_table(spark: SparkSession, path: str, columns: Sequence[str], quote: str = '"') -> DataFrame:
    """CSV without header; every declared column is a text."""
    return spark.read.schema(", ".join(f"`{c}` STRING" for c in columns)).option("quote", quote).csv(path)


def csv_view_ddl(name: str, path: str, columns: Sequence[str], quote: str = '"') -> str:
    """The same as a statement for an SQL script."""
    fields = ", ".join(f"`{c}` STRING" for c in columns)
    return f"CREATE OR REPLACE TEMPORARY VIEW {name} ({fields}) USING csv OPTIONS (path {quoted(path)}, quote {quoted(quote)})"


def jdbc_view_ddl(name: str, target: JdbcTarget, table: str) -> str:
    """JDBC table as a view, so that a script can read it or INSERT INTO it."""
    options = ", ".join(f"{k} {quoted(v)}" for k, v in {**target.options(), "dbtable": table}.items())
    return f"CREATE OR REPLACE TEMPORARY VIEW {name} USING jdbc OPTIONS ({options})"


class Refreshing:
    """A dimension that is read again once it is older than ``max_age`` seconds.

    ``get()`` is called per micro-batch. The new copy is read in full before
    it takes over; a failed or empty read keeps the one in use.
    """

    def __init__(self, load: Callable[[], DataFrame], max_age: float = LOOKUP_REFRESH_SECONDS,
                 clock: Callable[[], float] = time.monotonic):
        self._load, self._max_age, self._clock = load, max_age, clock
        self._current: DataFrame | None = None
        self._read_at = float("-inf")

    def get(self) -> DataFrame:
        if self._clock() - self._read_at >= self._max_age:
            self._refresh()
        if self._current is None:
            raise RuntimeError("the dimension could not be read yet")
        return self._current

    def _refresh(self) -> None:
        try:
            fresh = self._load().persist()
            if fresh.count() == 0:
                fresh.unpersist()
                log.warning("dimension is empty, the one in use stays")
            else:
                if self._current is not None:
                    self._current.unpersist()
                self._current = fresh
        except Exception:
            log.exception("dimension could not be read, the one in use stays")
        # Without any copy the next batch tries again.
        if self._current is not None:
            self._read_at = self._clock()
