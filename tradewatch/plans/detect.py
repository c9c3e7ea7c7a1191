"""Unusual-trade detection: recent trades against their market's rolling baseline."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.coerce import instant
from tradewatch.functions.text import alert_reason
from tradewatch.operators.baseline import (
    baseline_at,
    recent_trades,
    rolling_baseline,
    trade_facts,
    zscore,
)
from tradewatch.operators.enrich import market_profile
from tradewatch.operators.skew import first_per_key, heavy_split_join, salted_join
from tradewatch.session import stored


@dataclass(frozen=True)
class DetectParams:
    """Thresholds of the detection; the defaults are the production settings."""

    lookback: timedelta = timedelta(minutes=30)
    baseline: timedelta = timedelta(days=7)
    min_trades: int = 10
    min_notional: float = 1000.0
    price_cap: float = 0.90
    z_limit: float = 3.0
    combine: str = "and"
    keys: Sequence[str] = ("market_id",)
    zone: str = "America/Denver"
    volume_scale: float = 100.0
    dedup: str = "first"


def _large(trades: DataFrame, params: DetectParams) -> DataFrame:
    """The cheap tests; they come before any join, so only large trades are ever shuffled."""
    return trades.filter((F.col("notional") > params.min_notional) & (F.col("price") < params.price_cap))


def _flagged(large: DataFrame, baseline: DataFrame, on: Sequence[str], params: DetectParams) -> DataFrame:
    size_far = F.abs("size_zscore") > params.z_limit
    notional_far = F.abs("notional_zscore") > params.z_limit
    unusual = size_far & notional_far if params.combine == "and" else size_far | notional_far
    return (
        heavy_split_join(large, baseline, list(on), "n_recent")
        .withColumn("size_zscore", zscore(F.col("size"), F.col("average_size"), F.col("stddev_size")))
        .withColumn(
            "notional_zscore", zscore(F.col("notional"), F.col("average_notional"), F.col("stddev_notional"))
        )
        .filter(unusual)
        .withColumn("alert_id", F.sha2(F.concat("source", F.lit("|"), "trade_id"), 256))
    )


def unusual_trades(trades: DataFrame, as_of: datetime, params: DetectParams = DetectParams()) -> DataFrame:
    """Recent trades whose size and notional both lie far from the market's baseline."""
    baseline = rolling_baseline(trades, as_of, params.baseline, params.min_trades, params.keys, params.lookback)
    large = _large(recent_trades(trades, as_of, params.lookback, params.zone), params)
    return _flagged(large, baseline, params.keys, params)


def _as_alerts(
    found: DataFrame, markets_a: DataFrame, markets_b: DataFrame, series: DataFrame, params: DetectParams
) -> DataFrame:
    """Flagged trades (with detected_at) in the shape of the alerts table. They are few and stored once; only now, for
    their markets, are titles and volumes looked up."""
    found = stored(found, "candidates")
    if params.dedup == "first":
        found = first_per_key(found, ["alert_id"], [F.col("detected_at"), F.col("ts"), -F.col("size"), F.col("market_id")])
    profile = market_profile(found.select("market_id"), markets_a, markets_b, series, params.volume_scale)
    found = salted_join(found, profile, ["market_id"], "left")
    values = ("size", "size_zscore", "average_size", "notional", "notional_zscore", "average_notional", "volume", "volume_24h")
    return schemas.conform(found.withColumn("reason", alert_reason(*[F.col(c) for c in values])), schemas.ALERTS)


def enriched_alerts(
    trades: DataFrame,
    markets_a: DataFrame,
    markets_b: DataFrame,
    series: DataFrame,
    as_of: datetime,
    params: DetectParams = DetectParams(),
) -> DataFrame:
    """Unusual trades with titles, volumes and reason text, in the shape of the alerts table."""
    found = unusual_trades(trades, as_of, params).withColumn("detected_at", instant(as_of))
    return _as_alerts(found, markets_a, markets_b, series, params)


def run_of(at: str, every: timedelta) -> Column:
    """The end of the run that an instant belongs to: the first whole multiple of `every` not before it."""
    width = every // timedelta(microseconds=1)
    return F.timestamp_micros((F.ceil(F.unix_micros(at) / F.lit(width)) * F.lit(width)).cast("bigint"))


def judge_runs(
    new_trades: DataFrame,
    cells: Callable[[datetime, datetime], DataFrame],
    markets_a: DataFrame,
    markets_b: DataFrame,
    series: DataFrame,
    params: DetectParams = DetectParams(),
    every: timedelta = timedelta(minutes=15),
) -> DataFrame:
    """Alerts of new trades, each judged once, as of the run that its `ingested_at` falls into.

    The baseline of a run has the trades that were ingested by then, so the result does not depend on how trades are
    dealt into batches. Trades stamped after their run are not judged; those that come too late for it only count in
    baselines. No trade's own clock moves a run. `cells` gives the baseline cells that end between two instants; runs end where
    cells end, so no single trade of the past is read.
    """
    run = run_of("ingested_at", every)
    span = new_trades.agg(F.min(run).alias("low"), F.max(run).alias("high")).first()
    if span["high"] is None:
        return new_trades.sparkSession.createDataFrame([], schemas.ALERTS)
    low, high = (x.astimezone(timezone.utc) for x in (span["low"], span["high"]))
    width = F.expr(f"INTERVAL {params.lookback // timedelta(seconds=1)} SECONDS")
    large = _large(trade_facts(new_trades.filter("size IS NOT NULL AND price IS NOT NULL"), params.zone, run.alias("__run")), params)
    large = large.filter((F.col("ts") > F.col("__run") - width) & (F.col("ts") <= F.col("__run")))
    wanted = large.groupBy(*params.keys, "__run").agg(F.count(F.lit(1)).alias("n_recent"))
    past = cells(low - params.baseline, high)
    baseline = baseline_at(past, wanted, params.keys, params.baseline, params.min_trades)
    found = _flagged(large, baseline, [*params.keys, "__run"], params).withColumn("detected_at", F.col("__run"))
    return _as_alerts(found, markets_a, markets_b, series, params)


def detect_anomalies(
    trades: DataFrame,
    markets_a: DataFrame,
    markets_b: DataFrame,
    series: DataFrame,
    alerts: DataFrame,
    as_of: datetime,
    params: DetectParams = DetectParams(),
    known_since: timedelta | None = None,
) -> DataFrame:
    """New alert rows: trades flagged now and not recorded in `alerts` before.

    `known_since` limits the part of `alerts` that is read to rows detected that long before
    `as_of`. An alert is never detected before its trade, so ``params.lookback`` is enough for
    tables written by this job; leave it out for tables of other origin.
    """
    known = alerts if known_since is None else alerts_since(alerts, as_of - known_since)
    fresh = enriched_alerts(trades, markets_a, markets_b, series, as_of, params)
    return fresh.join(known.select("alert_id"), "alert_id", "left_anti")


def alerts_since(alerts: DataFrame, since: datetime) -> DataFrame:
    """Alerts detected after `since`; on a table with days, older days are not opened."""
    found = alerts.filter(F.col("detected_at") > instant(since))
    return found.filter(F.col("detected_date") >= F.to_date(instant(since))) if "detected_date" in alerts.columns else found
