"""Upserts and updates by key, written as joins that produce the table's next version."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.coerce import instant
from tradewatch.operators.skew import first_per_key

SETTLED = "settlement_ts IS NOT NULL"
CLOSED = "coalesce(closed, false)"


def one_per_key(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when two staged rows share a key. Copies are counted before the shuffle."""
    grouped = staged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.any_value(F.struct(*staged.columns)).alias("s")
    )
    clash = F.raise_error(F.concat(F.lit("more than one staged row for key "), F.concat_ws("|", *keys)))
    return grouped.select(*keys, F.when(F.col("n") > 1, clash).otherwise(F.col("s")).alias("s"))


def upsert(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    as_of: datetime,
    freeze_when: str = "false",
    stamp: str = "resolved_at",
    dedup_order: Sequence | None = None,
) -> DataFrame:
    """The table after the upsert: `target` columns, one row per key.

    A matched row takes all staged columns and a new stamp unless `freeze_when`, a SQL condition on
    the target row, holds. Unmatched staged rows are inserted, unmatched target rows stay. Two staged
    rows for one key are an error, or with `dedup_order` the first in that order counts. The result
    reads `target`: write it to a new path.
    """
    if dedup_order is None:
        incoming = one_per_key(staged, keys)
    else:
        incoming = first_per_key(staged, keys, dedup_order).select(*keys, F.struct(*staged.columns).alias("s"))
    current = target.select(
        *keys, F.struct(*target.columns).alias("t"), F.coalesce(F.expr(freeze_when), F.lit(False)).alias("frozen")
    )
    take = F.col("s").isNotNull() & (F.col("t").isNull() | ~F.col("frozen"))
    columns = []
    for name in target.columns:
        if name == stamp:
            new = instant(as_of)
        elif name in staged.columns:
            new = F.col("s")[name]
        else:
            new = F.lit(None)
        columns.append(F.when(take, new).otherwise(F.col("t")[name]).alias(name))
    return current.join(incoming, list(keys), "full_outer").select(*columns)
