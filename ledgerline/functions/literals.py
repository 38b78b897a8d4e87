"""Small tables written out in the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def values_table(spark: SparkSession, rows: Sequence[tuple], columns: dict[str, str]) -> DataFrame:
    """A table of literals. The optimizer knows its size, unlike that of rows shipped from Python."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"cast({name} as {kind}) as {name}" for name, kind in columns.items())
    return spark.sql(f"select {casts} from values {body} as t({', '.join(columns)})")
