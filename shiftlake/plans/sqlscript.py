"""SQL script lists: ordered statements with session settings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Statement:
    sql: str
    order: int = 0


@dataclass(frozen=True)
class Setting:
    """A session setting with its declared type; a value that does not fit is an error before any statement runs."""

    name: str
    kind: str
    value: str

    def text(self) -> str:
        value = self.value.strip()
        if self.kind == "boolean":
            if value.lower() not in ("true", "false"):
                raise ValueError(f"setting {self.name} is boolean, not {self.value!r}")
            return value.lower()
        if self.kind in ("int", "long"):
            return str(int(value))
        if self.kind in ("float", "double"):
            return str(float(value))
        if self.kind == "string":
            return self.value
        raise ValueError(f"unknown type {self.kind!r} of setting {self.name}")


def run_script(spark: SparkSession, statements: Sequence[Statement],
               settings: dict[str, str | int | bool | float] | Sequence[Setting] | None = None) -> list[DataFrame]:
    """Apply the settings and run the statements by ``order``; equal orders keep their place.

    Any statement may refer to a setting as ``${name}``. DDL and INSERT run at
    once; the frame of a SELECT is returned unrun.
    """
    if settings is None or isinstance(settings, dict):
        texts = {n: str(v).lower() if isinstance(v, bool) else str(v) for n, v in (settings or {}).items()}
    else:
        texts = {s.name: s.text() for s in settings}
    for name, value in texts.items():
        spark.conf.set(name, value)
    return [spark.sql(s.sql) for s in sorted(statements, key=lambda s: s.order)]
