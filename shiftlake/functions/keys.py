"""Row keys of the keyed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_prefix(c: Column) -> Column:
    return F.substring(F.md5(c), 1, 2)


def row_key(*parts: Column, suffix: Callable[[Column], Column] | None = None) -> Column:
    """``md5(a|b|c)[0:2]|a|b|c``, optionally extended by ``suffix``."""
    joined = F.concat_ws("|", *parts)
    key = F.concat(md5_prefix(joined), F.lit("|"), joined)
    return suffix(key) if suffix else key


def content_suffix(*cols: Column) -> Callable[[Column], Column]:
    """Suffix from a digest of the record, so that a replay hits the same key."""
    digest = F.substring(F.sha2(F.concat_ws("\x1f", *cols), 256), 1, 5)
    return lambda key: F.concat(key, F.lit("|"), digest)


def equipment_row_key(eqpid: Column, put_time: Column, tubeid: Column,
                      suffix: Callable[[Column], Column] | None = None) -> Column:
    """Equipment and time, plus the tube where there is one."""
    tube = F.when(tubeid != "", tubeid)
    return row_key(eqpid, put_time, tube, suffix=suffix)
