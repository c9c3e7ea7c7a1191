"""How registered queries present their columns, so that both engines agree on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(name: str, alias: str | None = None, decimals: int = 6) -> Column:
    """Six decimals. The tiny offset keeps exact ties from falling either way by their last bit."""
    return F.round(F.col(name) + 1e-9, decimals).alias(alias or name.split(".")[-1])


def r6_sql(expression: str, alias: str, decimals: int = 6) -> str:
    return f"round({expression} + 1e-9, {decimals}) AS {alias}"


def fixed_sql(expression: str, decimals: int) -> str:
    """DuckDB text of a double with fixed decimals, rounded as Spark's format_string does: half up from
    its shortest decimal form."""
    return f"CAST(CAST(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 24)) AS DECIMAL(38, {decimals})) AS VARCHAR)"


def wall(name: str, alias: str | None = None) -> Column:
    """An instant as zone-less UTC time, the type the tables' own timestamps have."""
    return F.col(name).cast("timestamp_ntz").alias(alias or name.split(".")[-1])
