"""Which markets to follow, and how the set changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.coerce import blank_to_null


def open_tickers(markets: DataFrame, manual: DataFrame) -> DataFrame:
    """Active venue-A tickers and the manual ones, each once, in order."""
    active = markets.filter(F.col("status") == "active").select("ticker")
    return active.unionByName(manual.select("ticker")).filter(F.col("ticker").isNotNull()).distinct().orderBy("ticker")


def tradable_markets(markets: DataFrame) -> DataFrame:
    """Venue-B markets that are open, accept orders and have both tokens."""
    return markets.filter(
        ~F.coalesce("closed", F.lit(False))
        & F.coalesce("accepting_orders", F.lit(False))
        & blank_to_null(F.col("yes_token_id")).isNotNull()
        & blank_to_null(F.col("no_token_id")).isNotNull()
    ).select(F.col("id").alias("market_id"), "yes_token_id", "no_token_id")


def subscription_delta(current: DataFrame, desired: DataFrame, on: Sequence[str] = ("market_id",)) -> DataFrame:
    """Entries to add and to remove, marked in `change`; empty when the two sets are equal."""
    wanted = desired.select(*on).withColumn("__now", F.lit(False)).withColumn("__next", F.lit(True))
    present = current.select(*on).withColumn("__now", F.lit(True)).withColumn("__next", F.lit(False))
    return (
        wanted.unionByName(present)
        .groupBy(*on)
        .agg(F.bool_or("__now").alias("__now"), F.bool_or("__next").alias("__next"))
        .filter(F.col("__now") != F.col("__next"))
        .select(*on, F.when(F.col("__next"), "added").otherwise("removed").alias("change"))
    )


def delta_counts(delta: DataFrame) -> DataFrame:
    """One row: how many entries are new or gone, and whether anything changed."""
    added = F.count_if(F.col("change") == "added")
    removed = F.count_if(F.col("change") == "removed")
    return delta.agg(added.alias("added"), removed.alias("removed"), ((added + removed) > 0).alias("changed"))
