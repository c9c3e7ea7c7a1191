"""Recent trades, rolling baselines per market and z-scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.coerce import instant, local_time


def trades_between(trades: DataFrame, as_of: datetime, lookback: timedelta) -> DataFrame:
    """Priced trades with ``as_of - lookback < ts <= as_of``.

    Both bounds are literals and reach the scan. On a table partitioned by `trade_date` the day
    bounds are added too, because a partition column is not derived from `ts` by itself.
    """
    low, high = instant(as_of - lookback), instant(as_of)
    bounded = trades
    if "trade_date" in trades.columns:
        bounded = bounded.filter(F.col("trade_date").between(F.to_date(low), F.to_date(high)))
    return bounded.filter(
        (F.col("ts") > low) & (F.col("ts") <= high) & F.col("size").isNotNull() & F.col("price").isNotNull()
    )


def recent_trades(
    trades: DataFrame, as_of: datetime, lookback: timedelta = timedelta(minutes=30), zone: str = "America/Denver"
) -> DataFrame:
    return trade_facts(trades_between(trades, as_of, lookback), zone)


def trade_facts(trades: DataFrame, zone: str = "America/Denver", *more: Column) -> DataFrame:
    """What detection looks at of each trade."""
    return trades.select(
        "source",
        "market_id",
        "trade_id",
        "ts",
        local_time(F.col("ts"), zone).alias("trade_ts"),
        "price",
        "size",
        "side",
        (F.col("price") * F.col("size")).alias("notional"),
        *more,
    )


def rolling_baseline(
    trades: DataFrame,
    as_of: datetime,
    lookback: timedelta = timedelta(days=7),
    min_trades: int = 10,
    keys: Sequence[str] = ("market_id",),
    recent: timedelta = timedelta(minutes=30),
) -> DataFrame:
    """Mean and sample deviation of size and notional per market with enough history.

    `n_recent` counts the market's trades of the last `recent` in the same pass; the detection
    join uses it to recognise markets that hold much of the recent data.
    """
    notional = F.col("price") * F.col("size")
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return (
        trades_between(trades, as_of, lookback)
        .filter(known)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            F.count_if(F.col("ts") > instant(as_of - recent)).alias("n_recent"),
            F.avg("size").alias("average_size"),
            F.stddev_samp("size").alias("stddev_size"),
            F.avg(notional).alias("average_notional"),
            F.stddev_samp(notional).alias("stddev_notional"),
        )
        .filter(F.col("n_trades") >= min_trades)
    )


_MEASURES = ("size", "notional")


def baseline_cells(trades: DataFrame, keys: Sequence[str], every: timedelta) -> DataFrame:
    """Partial baselines that can be merged: count, mean and squared deviations per key, time cell and cell of arrival.

    A cell is named by its end. Cells can be stored and added to as trades arrive; a baseline at the end of any
    cell needs no single trade.
    """
    width = every // timedelta(microseconds=1)

    def cell(at: str) -> Column:
        return F.timestamp_micros((F.ceil(F.unix_micros(at) / F.lit(width)) * F.lit(width)).cast("bigint"))

    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    rows = trades.filter(known).select(
        *keys, cell("ts").alias("cell"), cell("ingested_at").alias("arrived"), "size", (F.col("price") * F.col("size")).alias("notional")
    )
    spread = [x for m in _MEASURES for x in (F.avg(m).alias(f"mean_{m}"), (F.var_pop(m) * F.count(m)).alias(f"squares_{m}"))]
    return rows.groupBy(*keys, "cell", "arrived").agg(F.count(F.lit(1)).alias("n"), *spread)


def _merged(parts: Column, measure: str) -> Column:
    """Count, mean and squared deviations of one measure over all cells of an ordered list."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def add(acc: Column, x: Column) -> Column:
        n = acc["n"] + x["n"]
        step = x[f"mean_{measure}"] - acc["mean"]
        return F.struct(
            n.alias("n"),
            (acc["mean"] + step * x["n"] / n).alias("mean"),
            (acc["squares"] + x[f"squares_{measure}"] + step * step * acc["n"] * x["n"] / n).alias("squares"),
        )

    return F.aggregate(parts, zero, add)


def _parts(*order: str) -> Column:
    """The cells of a group as one list, in an order that does not depend on how they were read."""
    values = [f"{x}_{m}" for m in _MEASURES for x in ("mean", "squares")]
    return F.array_sort(F.collect_list(F.struct(*order, "n", *values)))


def merged_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of several batches as one row per key, time cell and cell of arrival. A list holds at most one cell per batch."""
    parts = cells.groupBy(*keys, "cell", "arrived").agg(_parts().alias("parts"))
    total = parts.select(*keys, "cell", "arrived", *[_merged(F.col("parts"), m).alias(f"__{m}") for m in _MEASURES])
    values = [F.col(f"__{m}.{x}").alias(f"{x}_{m}") for m in _MEASURES for x in ("mean", "squares")]
    return total.select(*keys, "cell", "arrived", F.col(f"__{_MEASURES[0]}.n").alias("n"), *values)


def baseline_at(
    cells: DataFrame, wanted: DataFrame, keys: Sequence[str], lookback: timedelta, min_trades: int = 10
) -> DataFrame:
    """The baseline of each wanted (keys, __run), from the cells that lie in the lookback and had arrived by then.

    A key has at most one cell per time step and arrival, so the list that is merged is bounded by the lookback.
    """
    width = F.expr(f"INTERVAL {lookback // timedelta(seconds=1)} SECONDS")
    run = F.col("__run")
    met = cells.join(wanted, list(keys)).filter(
        (F.col("cell") <= run) & (F.col("cell") > run - width) & (F.col("arrived") <= run)
    )
    parts = met.groupBy(*keys, "__run", "n_recent").agg(_parts("cell", "arrived").alias("parts"))
    total = parts.select(*keys, "__run", "n_recent", *[_merged(F.col("parts"), m).alias(m) for m in _MEASURES])
    values = [
        x
        for m in _MEASURES
        for x in (F.col(m)["mean"].alias(f"average_{m}"), F.sqrt(F.col(m)["squares"] / F.nullif(F.col(m)["n"] - 1, F.lit(0))).alias(f"stddev_{m}"))
    ]
    return total.select(*keys, "__run", F.col("size.n").alias("n_trades"), "n_recent", *values).filter(
        F.col("n_trades") >= min_trades
    )


def zscore(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in deviations; NULL when the deviation is zero."""
    return (value - mean) / F.nullif(deviation, F.lit(0.0))
