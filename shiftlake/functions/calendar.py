"""Plant calendar: shifts, shift switches, production days and weeks.

A production day starts at 07:30 in site group G and at 08:00 in groups Z and
T. Moving the clock back by that offset turns the day shift into hours 0-11
and the night shift into hours 12-23 of one calendar day, which gives every
rule below a closed form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_DAY = 12 * 3600
# Start of the production day in seconds, per site group.
DAY_START = {"G": 7 * 3600 + 1800, "Z": 8 * 3600, "T": 8 * 3600}
DAY_DATE_OFFSET = 8 * 3600
PLANT_UTC_OFFSET = 8 * 3600


def site_group(site: Column) -> Column:
    return F.substring(site, 1, 1)


def day_start(site: Column) -> Column:
    """Offset of the production day in seconds; null for an unknown group."""
    starts = ", ".join(f"'{letter}', {seconds}" for letter, seconds in DAY_START.items())
    return F.try_element_at(F.expr(f"map({starts})"), site_group(site))


def plus_seconds(ts: Column, seconds: Column | int) -> Column:
    moved = F.unix_timestamp(ts) + (F.lit(seconds) if isinstance(seconds, int) else seconds)
    return F.timestamp_seconds(moved)


def shift_label(ts: Column, site: Column) -> Column:
    """``yyyy-MM-dd-D`` or ``yyyy-MM-dd-N``."""
    moved = plus_seconds(ts, -day_start(site))
    return F.concat(F.date_format(moved, "yyyy-MM-dd"),
                    F.when(F.hour(moved) < 12, F.lit("-D")).otherwise(F.lit("-N")))


def shift_char(ts: Column, site: Column) -> Column:
    return F.right(shift_label(ts, site), F.lit(1))


def shift_start(ts: Column, site: Column) -> Column:
    """Moment the running shift began."""
    offset = day_start(site)
    moved = plus_seconds(ts, -offset)
    half = F.when(F.hour(moved) < 12, F.lit(0)).otherwise(F.lit(HALF_DAY))
    return plus_seconds(F.date_trunc("day", moved), offset + half)


def next_switch(ts: Column, site: Column) -> Column:
    """First shift switch after ``ts``; a switch moment itself counts as past."""
    return plus_seconds(shift_start(ts, site), HALF_DAY)


def day_date(ts: Column) -> Column:
    """Production day as text; the same eight hours for every site."""
    return F.date_format(plus_seconds(ts, -DAY_DATE_OFFSET), "yyyy-MM-dd")


def week_number(day: Column) -> Column:
    """Week of the week-based year: Monday start, week 1 holds 1 January."""
    monday = F.trunc(day, "week")
    week_year = F.year(F.date_add(monday, 6))
    first_monday = F.trunc(F.make_date(week_year, F.lit(1), F.lit(1)), "week")
    return (F.datediff(monday, first_monday) / 7 + 1).cast("int")


def year_label(day_text: Column) -> Column:
    return F.concat(F.lit("Y"), F.substring(day_text, 1, 4))


def month_label(day_text: Column) -> Column:
    return F.concat(F.lit("M"), F.substring(day_text, 6, 2))


def week_label(day_text: Column) -> Column:
    return F.concat(F.lit("W"), F.lpad(week_number(F.to_date(day_text)).cast("string"), 2, "0"))


def epoch_seconds(ts: Column) -> Column:
    """Epoch of a plant-local wall-clock value (the plant is at UTC+8)."""
    return F.unix_timestamp(ts) - PLANT_UTC_OFFSET
