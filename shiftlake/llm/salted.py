"""Lookups by a key that a third of all rows may share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that one task should get of a hot key.
ROWS_PER_SALT = 256
MOST_SALTS = 4096


def salts_for(rows: int) -> int:
    """How many parts to cut a hot key into, from the number of all rows."""
    return min(MOST_SALTS, max(16, rows // ROWS_PER_SALT))


def salt_of(*parts: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(salts)).cast("int")


def lookup(rows: DataFrame, table: DataFrame, key: str, salt: str) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per ``key``) without bringing a hot key together.

    The distinct (key, salt) pairs of ``rows`` fetch the table's columns first,
    a few per key; the rows then meet them by key and salt.
    """
    shares = rows.select(key, salt).distinct().join(table, key)
    return rows.join(shares, [key, salt], "left")
