"""Connected components of a graph given as pairs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import stored


def _linked_to_least(pairs: DataFrame, keep_all: bool) -> DataFrame:
    """Each node's neighbours are linked to the least of them (or to the node itself, if that is less).

    With ``keep_all`` every neighbour above the node is linked, else all are linked, the node included.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    joined = pairs.join(least, "a")
    if keep_all:
        return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b").unionAll(own).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of ``pairs`` (a, b; two comparable values): root is the least node of its component.

    Each round keeps the components and shortens paths; it ends when a round changes nothing, after about the square
    of the logarithm of the nodes at most. Every round is a stored table. Pairs with a null are left out.
    """
    current = stored(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-pairs"
    )

    def mark(df):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    state = mark(current)
    while state[0]:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = _linked_to_least(both, keep_all=True).distinct()
        current = stored(_linked_to_least(up, keep_all=False), "component-pairs")
        before, state = state, mark(current)
        if state == before:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
