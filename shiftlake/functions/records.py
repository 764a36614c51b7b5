"""JSON text -> record map, and key normalization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import quoted, text_map
from .text import hump_to_underscore

RECORD = "map<string,string>"


def once(df: DataFrame, **computed: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    The optimizer copies the expression of a plain column into every filter
    and projection that uses it, which repeats a JSON parse dozens of times.
    A generator of one row keeps it in place. The other columns stay outside,
    so the scan still reads only what is used.
    """
    kept = [c for c in df.columns if c not in computed]
    row = F.struct(*[c.alias(n) for n, c in computed.items()])
    return df.select(*kept, F.inline(F.array(row)))


def parse_record(value: Column) -> Column:
    """JSON object -> map of texts; null when malformed. A JSON null keeps its key."""
    return F.from_json(value, RECORD)


def renamed_key(key: Column, mapping: dict[str, str], variant: str) -> Column:
    """The new key under one of the naming rules used by the jobs.

    ``rename_lower``: rename, then lower-case.  ``lower_rename``: lower-case,
    then rename.  ``lower``: lower-case.  ``rename_snake``: rename, otherwise
    camel humps to lower-case with underscores.
    """
    def renamed(source: Column, otherwise: Column) -> Column:
        return F.coalesce(F.try_element_at(text_map(mapping), source), otherwise) if mapping else otherwise

    if variant == "rename_lower":
        return F.lower(renamed(key, key))
    if variant == "lower_rename":
        return renamed(F.lower(key), F.lower(key))
    if variant == "lower":
        return F.lower(key)
    if variant == "rename_snake":
        return renamed(key, hump_to_underscore(key))
    raise ValueError(f"unknown naming rule {variant!r}")


def normalize_keys(df: DataFrame, record: str = "rec", mapping: dict[str, str] | None = None,
                   variant: str = "rename_lower", null_as_empty: bool = False) -> DataFrame:
    """Rewrite the keys of the map column ``record``.

    Where two keys fall together, the first non-null value in document order
    stays. Only records with a collision pay for the duplicate search.
    """
    mapping = mapping or {}

    def entry(e: Column) -> Column:
        value = F.coalesce(e["value"], F.lit("")) if null_as_empty else e["value"]
        return F.struct(renamed_key(e["key"], mapping, variant).alias("key"), value.alias("value"))

    pairs = once(df, _pairs=F.transform(F.map_entries(record), entry))
    pairs = pairs.withColumn("_names", F.transform("_pairs", lambda e: e["key"]))
    clash = F.size(F.array_distinct("_names")) < F.size("_names")
    ordered = F.concat(F.filter("_pairs", lambda e: e["value"].isNotNull()),
                       F.filter("_pairs", lambda e: e["value"].isNull()))
    first_only = F.filter(ordered, lambda e, i: ~F.exists(
        F.slice(ordered, F.lit(1), i), lambda earlier: earlier["key"] == e["key"]))
    merged = F.when(clash, F.map_from_entries(first_only)).otherwise(F.map_from_entries("_pairs"))
    return once(pairs, **{record: merged}).drop("_pairs", "_names")


def field(name: str, record: str = "rec") -> Column:
    return F.expr(f"try_element_at({record}, {quoted(name)})")


def has_keys(names: list[str], record: str = "rec") -> Column:
    """All keys are present; a null value still counts."""
    held = " AND ".join(f"map_contains_key({record}, {quoted(n)})" for n in names)
    return F.expr(f"coalesce({held}, false)")
