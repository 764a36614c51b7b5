"""Code tables. The factory maps differ on purpose; see the README."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FACTORY_BY_SITE = {"Z2": "4", "Z3": "4", "T1": "3", "G1": "1"}
TESTER_FACTORY_BY_SITE = {"G1": "1", "Z1": "2", "T1": "3", "Z2": "4", "Z3": "4"}
ALARM_FACTORY_BY_LETTER = {"G": "1000", "Z": "2000", "T": "3000"}
MODULE_IDS = {
    "SDR": "1",
    "PCS 1": "2", "RINSE 1": "2", "RINSE 2": "2",
    "TEXTURE 1": "3", "TEXTURE 2": "3",
    "HU|HF": "4",
    "DIO3|HU": "5",
    "HWD": "6",
    "WAD 1": "7", "WAD 2": "7", "WAD 3": "7",
    "Unload Station": "8",
}
TERMINAL_MODULE = "Unload Station"
LOAD_STATE_CODES = {
    "Loading": "1",
    "Wait for Loading/Unload": "2",
    "Processing": "3",
    "Wait for process": "4",
    "Cooling time elapsed": "5",
    "Cooling": "6",
}
ORDER_TYPES = ("YP", "PL", "BY", "YZ", "LY", "CFX", "CC", "GSQ", "GSH", "CID")


def decode_with(c: Column, table: dict[str, str], default: str | None = None) -> Column:
    out = F.try_element_at(text_map(table), c)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_map(table: dict[str, str]) -> Column:
    """The table as one constant map."""
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in table.items()) + ")")


def site_of(eqpid: Column) -> Column:
    return F.substring(eqpid, 1, 2)


def device_type(eqpid: Column) -> Column:
    """``Z2-DF02`` -> ``DF``."""
    return F.regexp_replace(F.get(F.split(eqpid, "-"), F.lit(1)), r"\d+", "")


def factory_id(site: Column) -> Column:
    return decode_with(site, FACTORY_BY_SITE, "Other")


def tester_factory(site: Column) -> Column:
    return decode_with(site, TESTER_FACTORY_BY_SITE, "Other")


def alarm_factory(eqpid: Column) -> Column:
    return decode_with(F.substring(eqpid, 1, 1), ALARM_FACTORY_BY_LETTER, "Other")


def module_id(name: Column) -> Column:
    return decode_with(name, MODULE_IDS)


def load_state_code(state: Column) -> Column:
    return decode_with(state, LOAD_STATE_CODES, "0")


def order_type(comment: Column) -> Column:
    """First code contained in the comment, in the fixed order."""
    codes = F.expr("array(" + ", ".join(quoted(c) for c in ORDER_TYPES) + ")")
    found = F.filter(codes, lambda code: F.contains(F.upper(comment), code))
    return F.coalesce(F.get(found, F.lit(0)), F.when(comment.isNotNull(), F.lit("NORMAL")))


def bin_type(value: Column) -> Column:
    return F.when(value.isin("0", "100"), value).otherwise(F.lit("OTHER"))
