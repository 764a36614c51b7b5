"""JDBC sinks: append with quarantine, and update-or-insert through a staging table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        out = {"url": self.url, "driver": self.driver}
        if self.user is not None:
            out["user"] = self.user
        if self.password is not None:
            out["password"] = self.password
        return out


def append(df: DataFrame, target: JdbcTarget, table: str, required: Sequence[str] = (),
           bind: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Append the rows whose ``required`` columns are filled (dates that could be
    read). Returns the others."""
    rows = bind(df) if bind else df
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    rows.where(complete).write.format("jdbc").options(**target.options()).option("dbtable", table).mode("append").save()
    return rows.where(~complete)


def merge_statements(table: str, staging: str, key: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Update the rows whose key is staged, then insert the staged rows without one."""
    on = " AND ".join(f"s.{k} = {table}.{k}" for k in key)
    exists = f"SELECT 1 FROM {staging} s WHERE {on}"
    sets = ", ".join(f"{c} = (SELECT s.{c} FROM {staging} s WHERE {on})" for c in columns)
    names = ", ".join([*key, *columns])
    picked = ", ".join(f"s.{c}" for c in [*key, *columns])
    update = f"UPDATE {table} SET {sets} WHERE EXISTS ({exists})"
    insert = (f"INSERT INTO {table} ({names}) SELECT {picked} FROM {staging} s "
              f"WHERE NOT EXISTS (SELECT 1 FROM {table} WHERE {on})")
    return [update, insert] if columns else [insert]


def merge(spark: SparkSession, df: DataFrame, target: JdbcTarget, table: str, staging: str,
          key: Sequence[str], order: Sequence[str]) -> None:
    """Same end state as updating or inserting row by row in ``order``.

    Executors write the latest row per key into the staging table; the driver
    only sends the two statements, in one transaction. Running it again gives
    the same table.
    """
    columns = [c for c in df.columns if c not in {*key, *order}]
    latest = latest_per_key(df, key, order).select(*key, *columns)
    (latest.write.format("jdbc").options(**target.options()).option("dbtable", staging)
     .option("truncate", "true").mode("overwrite").save())
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(target.driver)
    con = jvm.java.sql.DriverManager.getConnection(target.url, target.user, target.password)
    try:
        con.setAutoCommit(False)
        for sql in merge_statements(table, staging, key, columns):
            statement = con.createStatement()
            statement.executeUpdate(sql)
            statement.close()
        con.commit()
    except Exception:
        con.rollback()
        raise
    finally:
        con.close()
