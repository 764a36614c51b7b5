"""Keyed tables on Parquet: puts merge into the row of the same key, deletes remove it.

Every write makes a new version. Only the partitions a batch touches are
rewritten; the manifest of a version names the folder of every partition, and
readers follow the newest manifest. A batch id already in the manifest is not
applied again, so a replayed micro-batch changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import last_values, merge_rows, without_keys
from .files import ControlFiles

INSERT, DELETE = "INSERT", "DELETE"
_PART = "_part"


class KeyedTable:
    """``partition`` names a column that follows from the key (the production
    day of a key that holds the time). Without it the table is one partition."""

    def __init__(self, spark: SparkSession, path: str, key: str = "row_key", partition: str | None = None):
        self.spark, self.path, self.key, self.partition = spark, path.rstrip("/"), key, partition
        self._manifests = ControlFiles(spark, self.path, "manifest")

    def manifest(self) -> dict:
        numbers = self._manifests.numbers()
        return self._manifests.read(numbers[-1]) if numbers else {"version": 0, "parts": {}, "batches": {}}

    def read(self, columns: Sequence[str] | None = None) -> DataFrame | None:
        """Current rows, or None before the first write; reads only ``columns``."""
        out = self._read_parts(self.manifest()["parts"].values())
        return out if out is None or columns is None else out.select(*columns)

    def vacuum(self, keep: int = 10) -> None:
        """Remove the data that none of the newest ``keep`` versions refers to."""
        numbers = self._manifests.numbers()
        kept = {f.split("/")[1] for n in numbers[-keep:] for f in self._manifests.read(n)["parts"].values()}
        for n in numbers[:-keep]:
            self._manifests.remove(n)
        newest = numbers[-1] if numbers else 0
        for folder in self._manifests.children(f"{self.path}/data"):
            # A folder past the newest version belongs to a write under way.
            if folder not in kept and int(folder.split("-")[0][1:]) <= newest:
                self._manifests.remove_folder(f"{self.path}/data/{folder}")

    def _read_parts(self, folders) -> DataFrame | None:
        paths = [f"{self.path}/{f}" for f in sorted(folders)]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def _part(self, df: DataFrame) -> DataFrame:
        value = F.lit("all") if self.partition is None else F.coalesce(F.col(self.partition).cast("string"), F.lit("none"))
        return df.withColumn(_PART, F.regexp_replace(value, r"[^A-Za-z0-9_.-]", "_"))

    def put(self, rows: DataFrame, order: Sequence[str] = (), batch_id: int | None = None,
            source: str = "default") -> bool:
        """Merge rows; several rows of a key are reduced by ``order`` first.

        Returns False when the batch had been applied before.
        """
        rows = rows.where(F.col(self.key).isNotNull())
        if order:
            rows = last_values(rows, [self.key], order)
        return self._apply(rows, batch_id, source, lambda old, new: merge_rows(old, new, [self.key]))

    def delete(self, keys: DataFrame, batch_id: int | None = None, source: str = "default") -> bool:
        """Remove the keys. ``keys`` also holds the partition column, if there is one."""
        return self._apply(keys, batch_id, source,
                           lambda old, gone: without_keys(old, gone, [self.key]), only_existing=True)

    def merge(self, rows: DataFrame, batch_id: int | None, source: str, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Replace the touched partitions by what ``combine`` makes of their rows and the new ones (one per key)."""
        return self._apply(rows, batch_id, source, combine)

    def _apply(self, rows: DataFrame, batch_id: int | None, source: str,
               combine: Callable[[DataFrame, DataFrame], DataFrame], only_existing: bool = False) -> bool:
        before = self.manifest()
        if batch_id is not None and batch_id <= before["batches"].get(source, -1):
            return False
        version = before["version"] + 1
        rows = self._part(rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # One value per touched day, not per row.
            touched = {f"{_PART}={r[0]}" for r in rows.select(_PART).distinct().collect()}
            held = {name: folder for name, folder in before["parts"].items() if name in touched}
            old = self._read_parts(held.values())
            parts = {n: f for n, f in before["parts"].items() if n not in touched}
            merged = None
            if old is not None:
                merged = self._part(combine(old, rows.drop(_PART)))
            elif touched and not only_existing:
                merged = rows
            if merged is not None:
                # A folder per attempt: a writer that loses the race leaves the winner's data alone.
                folder = f"data/v{version:010d}-{uuid.uuid4().hex[:12]}"
                merged.write.mode("errorifexists").partitionBy(_PART).parquet(f"{self.path}/{folder}")
                parts |= {n: f"{folder}/{n}" for n in self._manifests.children(f"{self.path}/{folder}")}
        finally:
            rows.unpersist()
        batches = dict(before["batches"])
        if batch_id is not None:
            batches[source] = batch_id
        self._manifests.write(version, {"version": version, "parts": parts, "batches": batches})
        return True


def columns_of_map(df: DataFrame, record: str = "rec", names: Sequence[str] | None = None,
                   drop: Sequence[str] = ("row_key",)) -> DataFrame:
    """Map entries as text columns ``names``, the declared columns of the table.
    Without them one more pass collects the distinct keys of the batch."""
    if names is None:
        keys = df.select(F.explode(F.map_keys(record)).alias("n")).distinct()
        names = sorted(r.n for r in keys.collect())
    return df.select("*", *[F.try_element_at(record, F.lit(n)).alias(n) for n in names
                            if n not in df.columns and n not in drop]).drop(record)


def put_records(table: KeyedTable, records: DataFrame, convert: Callable[[DataFrame], DataFrame] | None = None,
                operation: str = INSERT, order: Sequence[str] = (), batch_id: int | None = None) -> bool:
    """Put or delete records after an optional conversion to ``row_key`` and columns."""
    rows = convert(records) if convert else records
    if operation == INSERT:
        return table.put(rows, order, batch_id)
    if operation == DELETE:
        kept = [table.key] + ([table.partition] if table.partition else [])
        return table.delete(rows.select(*kept).distinct(), batch_id)
    raise ValueError(f"unknown operation {operation!r}")


def put_routed(spark: SparkSession, root: str, rows: DataFrame, targets: Sequence[str], record: str = "rec",
               order: Sequence[str] = ("ts", "seq"), batch_id: int | None = None,
               partition: str | None = "day_date", names: Sequence[str] | None = None) -> None:
    """Routed rows into one table per target; ``targets`` comes from the table mapping, ``names`` are the tables' columns."""
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for target in sorted(set(targets)):
            own = columns_of_map(rows.where(F.col("target") == target), record, names)
            own = own.drop("target", "family", "topic", "event_type")
            KeyedTable(spark, f"{root}/{target}", partition=partition).put(own, order, batch_id)
    finally:
        rows.unpersist()


def fan_out(batch: DataFrame, writers: Sequence[tuple[Column | None, Callable[[DataFrame], None]]]) -> None:
    """One computed batch, several filtered writes."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for condition, write in writers:
            write(batch if condition is None else batch.where(condition))
    finally:
        batch.unpersist()
