"""Gapless numbers in a total order, without a window over all rows or over a large group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.operators.skew import running_sums
from tradewatch.session import shared_folder

#: monotonically_increasing_id() counts the rows of a task from its number shifted by so many bits.
_TASK_SHIFT = 33


def numbered(
    df: DataFrame,
    order: Sequence[Column | str],
    groups: Sequence[Column | str] = (),
    name: str = "number",
    ranks: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """`df` with a number from 0 for each row of its group (all rows, where no group is named), in ascending order.

    Rows are dealt by ranges of (group, order) and written so, each with its place in its task. The rows of a group in a
    task are counted; these counts are added up over the tasks in blocks, and a row's number is what the tasks before hold
    plus its place. Rows that compare equal are numbered as they are read and may lie in several tasks, so neither a large
    group nor a value that many rows share meets in one task. Nulls come first and form a group. An empty table stays empty.

    `ranks` names further columns: a row's number, in the same order, among the rows that agree in the given columns, and as
    ``<name>_first`` the smallest `name` of those rows. They come from the same counts by task, without another sort of all rows.
    """
    if groups and ranks:
        raise ValueError("ranks go with one order of all rows")
    names = [f"__by{k}" for k in range(len(order))]
    by = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(order, names, strict=True)]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
        F.struct(*(groups or [F.lit(0)])).alias("__group"),
        *[F.struct(*columns).alias(f"__of_{rank}") for rank, columns in (ranks or {}).items()],
        *by,
        F.monotonically_increasing_id().alias("__read"),
    )
    keys = ["__group", *names, "__read"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = dealt.drop(*names, "__read").withColumn("__at", F.monotonically_increasing_id())
    path = shared_folder(df.sparkSession, "numbered")
    dealt.write.parquet(path)
    placed = df.sparkSession.read.schema(dealt.schema).parquet(path)
    placed = placed.withColumn("__task", F.shiftright("__at", _TASK_SHIFT))
    shift = _before(placed, "__group").select("__group", "__task", (F.col("__before") - F.col("__from")).alias("__shift"))
    found = placed.join(shift, ["__group", "__task"]).withColumn(name, F.col("__at") + F.col("__shift"))
    for rank in ranks or {}:
        of = f"__of_{rank}"
        local = F.row_number().over(W.partitionBy("__task", of).orderBy("__at")) - 1
        parts = _before(placed, of)
        # the group's first row is the first one of its first task
        heads = parts.groupBy(of).agg(F.min("__from").alias("__head"), F.min("__task").alias("__task"))
        heads = heads.join(shift.drop("__group"), "__task").select(of, (F.col("__head") + F.col("__shift")).alias(f"{rank}_first"))
        parts = parts.join(heads, of).select(of, "__task", "__before", f"{rank}_first")
        found = found.withColumn("__local", local).join(parts, [of, "__task"]).withColumn(rank, F.col("__local") + F.col("__before"))
    more = [c for rank in ranks or {} for c in (rank, f"{rank}_first")]
    return found.select("__row.*", name, *more)


def _before(placed: DataFrame, group: str) -> DataFrame:
    """For each group and task: the group's rows in the tasks before, and the place of its first row in this one."""
    counts = placed.groupBy(group, "__task").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("__from"))
    sums = running_sums(counts, [group], "__task", ["n"])
    return sums.select(group, "__task", "__from", (F.col("run_n") - F.col("n")).alias("__before"))
