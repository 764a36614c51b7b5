"""String predicates and small string rewrites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Record formats accepted by every job.
EQP_ID_PATTERN = r"^[A-Z]\d-[A-Z]+\d{1,2}[A-Z]{0,}$"
DATE_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MIXED_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyyMMddHHmmss")

_BLANKS = " \t\r\n\x0b\x0c"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only the blank."""
    return F.btrim(c, F.lit(_BLANKS))


def not_blank(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_equipment_id(c: Column) -> Column:
    return F.coalesce(F.upper(strip(c)).rlike(EQP_ID_PATTERN), F.lit(False))


def is_date_time(c: Column) -> Column:
    """Right shape and a date that exists."""
    return F.coalesce(strip(c).rlike(DATE_TIME_PATTERN), F.lit(False)) & parse_second(c).isNotNull()


def parse_second(c: Column) -> Column:
    return F.try_to_timestamp(strip(c), F.lit(SECOND_FORMAT))


def parse_mixed(c: Column) -> Column:
    """Parse ``2020-07-30 08:51:58``, ``2020/07/30 08:51:58`` or ``20200730085158``."""
    return F.coalesce(*[F.try_to_timestamp(strip(c), F.lit(f)) for f in MIXED_FORMATS])


def format_second(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def contains_ignoring_case(c: Column, needle: str) -> Column:
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def hump_to_underscore(c: Column, lower: bool = True) -> Column:
    """``EqpID`` -> ``eqp_i_d``: each capital gets an underscore in front."""
    spaced = F.regexp_replace(c, r"(\p{Lu})", "_$1")
    stripped = F.regexp_replace(spaced, "^_", "")
    return F.lower(stripped) if lower else stripped


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)
