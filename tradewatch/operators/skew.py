"""Joins, reductions and running sums that stay balanced when one key holds much of the data.

Salts come from the row's content and its partition number, never from a random generator or a
row counter: a task that is run again after an executor was lost gives every row the same salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_SALT = "__salt"
_FIXED_WIDTH = {"int", "bigint", "double", "timestamp", "timestamp_ntz", "date"}


def row_salt(df: DataFrame, salts: int) -> Column:
    """A salt in 0..salts-1; copies of a row spread by the partition they lie in.

    Texts are only hashed where a row has nothing of fixed width: payloads can be long.
    """
    short = [name for name, kind in df.dtypes if kind in _FIXED_WIDTH]
    content = [F.col(c) for c in short or df.columns]
    return F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(salts)).cast("int")


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", salts: int = 16
) -> DataFrame:
    """Join a large, possibly skewed `left` with a much smaller `right` (a dimension).

    Where Spark expects `right` to be below the session's broadcast threshold, this is a plain join: one copy of
    `right` is broadcast and nothing is shuffled. Otherwise each key of `left` is spread over `salts` tasks and `right` is
    repeated `salts` times; the copies, whose estimate would not grow with their number, are never broadcast.
    """
    if 0 <= estimated_bytes(right) <= broadcast_limit(left.sparkSession):
        return left.join(right, list(on), how)
    spread = left.withColumn(_SALT, row_salt(left, salts))
    copies = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies.hint("merge"), [*on, _SALT], how).drop(_SALT)


def estimated_bytes(df: DataFrame) -> int:
    """The size that the optimizer expects of a table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; -1 where broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    number = text.rstrip("bkmg")
    unit = text[len(number) : len(number) + 1]
    return int(number) * units.get(unit, 1)


def heavy_split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    weight: str,
    how: str = "inner",
    heavy: int = 1000,
    salts: int = 4096,
) -> DataFrame:
    """Join `left` with a table per key, `right`, where `right.weight` counts the key's left rows.

    The keys with the most rows are broadcast (never more than `heavy` rows, so the size is bounded
    whatever the data); their left rows are answered in place and then spread over the shuffle.
    Every other key holds at most 1/`heavy` of the left rows and is joined by a normal shuffle.
    Both uses of `right` read the same columns, so its exchange is computed once.
    """
    values = [c for c in right.columns if c not in on]
    # The lightest weight of a full top list is left to the shuffle: some of its rows may be cut off.
    whole = W.partitionBy(F.lit(0))
    top = (
        right.orderBy(F.desc(weight))
        .limit(heavy)
        .withColumn("__cut", F.when(F.count(F.lit(1)).over(whole) == heavy, F.min(weight).over(whole)))
        .filter(F.col("__cut").isNull() | (F.col(weight) > F.col("__cut")))
        .select(*on, F.struct(*values).alias("__top"))
    )
    tagged = left.join(F.broadcast(top), list(on), "left")
    keyless = F.lit(False)
    for key in on:
        keyless = keyless | F.col(key).isNull()
    # Salt 0 meets `right`; any other salt only spreads rows that need no partner from the shuffle.
    spread = tagged.withColumn(
        _SALT,
        F.when(F.col("__top").isNotNull() | keyless, F.lit(1) + row_salt(left, salts)).otherwise(F.lit(0)),
    )
    # Always 0, but not a literal: a literal would be folded out of the join key and undo the spreading.
    no_salt = F.pmod(F.col(weight), F.lit(1)).cast("int")
    rest = right.select(*on, F.struct(*values).alias("__rest"), no_salt.alias(_SALT))
    joined = spread.join(rest, [*on, _SALT], "left")
    found = joined.withColumn("__found", F.coalesce("__top", "__rest"))
    if how == "inner":
        found = found.filter(F.col("__found").isNotNull())
    return found.select(*left.columns, "__found.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key. Reduced before the shuffle, so a key of many copies costs little."""
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
        .select("__row.*")
    )


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
        .select("__row.*")
    )


def running_sums(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], block: int = 4096
) -> DataFrame:
    """Running sums of `values` per key along the whole-number column `order`, this row included.

    Adds ``run_<value>``. `(keys, order)` must be unique. A key is cut into blocks of `block`
    order steps that are summed on their own; only the block totals of a key meet in one task.
    """
    blocked = df.withColumn("__block", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    cell = [*keys, "__block"]
    before = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    totals = blocked.groupBy(*cell).agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    offsets = totals.select(
        *cell, *[F.coalesce(F.sum(f"__sum_{v}").over(before), F.lit(0)).alias(f"__before_{v}") for v in values]
    )
    inside = W.partitionBy(*cell).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = blocked.select("*", *[F.sum(v).over(inside).alias(f"__in_{v}") for v in values])
    return local.join(offsets, cell).select(
        *df.columns, *[(F.col(f"__in_{v}") + F.col(f"__before_{v}")).alias(f"run_{v}") for v in values]
    )
