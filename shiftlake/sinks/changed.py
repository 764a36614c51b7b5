"""Upserts and deletes in one ordered stream, merged into a keyed table.

Every row of the table keeps the position of the change it comes from, deleted
keys as tombstones. Of two changes of a key the one with the later position
wins, in whatever batch it arrives, so a late upsert cannot bring back what a
later delete removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import KeyedTable

GONE = "_gone"


def latest_changes(rows: DataFrame, key: str, position: Sequence[str]) -> DataFrame:
    """The last change of each key. Aggregated before the shuffle."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(*position)).alias("_c")).select("_c.*")


def apply_changes(table: KeyedTable, changes: DataFrame, position: Sequence[str], gone: Column, batch_id: int | None = None,
                  source: str = "default") -> bool:
    """Merge changes (key, partition column, ``position``, new values); ``gone`` tells deletes.

    Returns False when the batch had been applied before. Rows without a key
    are left out; a position has to be a total order within a key.
    """
    rows = changes.withColumn(GONE, F.coalesce(gone, F.lit(False))).where(F.col(table.key).isNotNull())
    return table.merge(latest_changes(rows, table.key, position), batch_id, source,
                       lambda old, new: latest_changes(old.unionByName(new, allowMissingColumns=True), table.key, position))


def live_rows(table: KeyedTable, columns: Sequence[str]) -> DataFrame:
    """The rows whose last change is no delete."""
    return table.read().where(~F.col(GONE)).select(*columns)
