"""Operational reports over trades, alerts and collector logs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.coerce import instant, iso_timestamp, json_object
from tradewatch.operators.once import computed_once


def source_summary(trades: DataFrame, as_of: datetime) -> DataFrame:
    """Trades, first and latest time per source on the day of `as_of`."""
    day = F.to_date(instant(as_of))
    start = F.date_trunc("day", instant(as_of))
    today = trades.filter((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))
    if "trade_date" in trades.columns:
        today = today.filter(F.col("trade_date") == day)
    return today.groupBy("source").agg(
        F.count(F.lit(1)).alias("trades"), F.min("ts").alias("first"), F.max("ts").alias("latest")
    )


def latest_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    """The `n` latest alerts, ties in the order of their ids."""
    return (
        alerts.orderBy(F.desc("detected_at"), "alert_id")
        .limit(n)
        .select("detected_at", "alert_id", "source", "market_id", "title", "side", "size", "price", "reason")
    )


def ingest_freshness(trades: DataFrame, source: str) -> DataFrame:
    return trades.filter(F.col("source") == source).agg(
        F.count(F.lit(1)).alias("trades"), F.max("ingested_at").alias("latest_ingest")
    )


def parsed_logs(lines: DataFrame) -> DataFrame:
    """Collector log lines (`value`) as event, idx, level and time."""
    fields = "event string, idx bigint, `timestamp` string, level string"
    return (
        computed_once(lines.select("value"), l=json_object(F.col("value"), fields))
        .filter(F.col("l").isNotNull())
        .select("l.event", "l.idx", "l.level", F.expr(iso_timestamp("l.timestamp")).alias("ts"))
    )


def subscribed_connections(
    logs: DataFrame, event: str, as_of: datetime, within: timedelta = timedelta(hours=1)
) -> DataFrame:
    """How many different connections subscribed within the lookback."""
    return logs.filter(
        (F.col("event") == event) & (F.col("ts") > instant(as_of - within)) & (F.col("ts") <= instant(as_of))
    ).agg(F.count_distinct("idx").alias("connections"))


def flapping(logs: DataFrame, events: list[str]) -> DataFrame:
    """Drops and reconnects per connection."""
    return logs.filter(F.col("event").isin(*events)).groupBy("idx", "event").agg(F.count(F.lit(1)).alias("n"))


def overlap_windows(trades: DataFrame, width: str = "30 minutes", every: str = "15 minutes") -> DataFrame:
    """Trades and notional per overlapping detection window."""
    return (
        trades.groupBy(F.window("ts", width, every).alias("w"), "source")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("price") * F.col("size")).alias("notional"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "source", "n", "notional")
    )


def late_arrivals(trades: DataFrame, tolerance: timedelta = timedelta(minutes=30)) -> DataFrame:
    """Per source and day: trades that landed too late for any detection run, and the longest delay."""
    delay = F.unix_micros("ingested_at") - F.unix_micros("ts")
    late = delay > F.lit(tolerance // timedelta(microseconds=1))
    return trades.groupBy("source", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("trades"), F.count_if(late).alias("late"), (F.max(delay) / 1e6).alias("max_delay_s")
    )
