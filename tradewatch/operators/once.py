"""Columns that cost much to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    The optimizer moves filters below a projection by repeating its expressions, so a filter on a
    parsed field would parse again for every row. It does not move them below a generator.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode_outer(F.array(values)).alias("__once")).select(*kept, "__once.*")
