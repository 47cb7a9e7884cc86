"""Declared tables in the session's catalogue: defaults, lengths and NOT NULL kept on every insert.

A ``TableSpec`` becomes a Parquet table whose columns have ``DEFAULT`` values and
``VARCHAR(n)`` lengths; Spark fills the ones and refuses rows that break the
others. Spark does not keep NOT NULL of such tables, so an insert counts NULLs
first, in one aggregate over the rows to be inserted, and refuses the whole
insert with the counts. Columns are matched by name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from dimsmith.operators.constraints import enforce_not_null
from dimsmith.sources.model import TableSpec


def create_table(spark: SparkSession, spec: TableSpec, name: str, path: str, defaults: Mapping[str, str] | None = None) -> None:
    """``CREATE TABLE name`` at ``path``; ``defaults`` are SQL constants by column."""
    defaults = defaults or {}
    unknown = set(defaults) - set(spec.column_names)
    if unknown:
        raise ValueError(f"not columns of {spec.name}: {sorted(unknown)}")
    columns = []
    for c in spec.columns:
        kind = f"VARCHAR({c.max_length})" if c.max_length else c.dtype
        said = (c.comment or "").replace("\\", "\\\\").replace("'", "\\'")
        comment = f" COMMENT '{said}'" if said else ""
        columns.append(f"`{c.name}` {kind}{'' if c.nullable else ' NOT NULL'}"
                       f"{f' DEFAULT {defaults[c.name]}' if c.name in defaults else ''}{comment}")
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet LOCATION '{path}'")


def insert(rows: DataFrame, spec: TableSpec, name: str) -> None:
    """Append ``rows``; columns they lack take their default, or NULL where that is allowed.

    A declared column without a default that the rows lack is refused as NULL is."""
    spark = rows.sparkSession
    lacking = [c.name for c in spec.columns if not c.nullable and c.name not in rows.columns
               and "CURRENT_DEFAULT" not in spark.table(name).schema[c.name].metadata]
    if lacking:
        raise ValueError(f"no value for NOT NULL columns: {lacking}")
    enforce_not_null(rows, [c.name for c in spec.columns if not c.nullable and c.name in rows.columns])
    names = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"INSERT INTO {name} ({names}) SELECT {names} FROM {{rows}}", rows=rows)
