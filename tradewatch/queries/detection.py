"""Registered queries on recent trades, baselines and alerts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions.coerce import local_time
from tradewatch.functions.text import alert_message
from tradewatch.operators.baseline import recent_trades, rolling_baseline
from tradewatch.plans.detect import DetectParams, detect_anomalies, enriched_alerts, unusual_trades
from tradewatch.queries import views
from tradewatch.queries.shape import fixed_sql, r6, r6_sql, wall

# Thresholds at which the test data shows unusual trades.
PARAMS = DetectParams(
    lookback=timedelta(days=7), baseline=timedelta(days=30), min_notional=20.0, z_limit=1.5, dedup="none"
)
WIDE = DetectParams(
    lookback=timedelta(days=365),
    baseline=timedelta(days=1500),
    min_notional=1000.0,
    price_cap=1e9,
    z_limit=1.2,
    combine="or",
)


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    found = recent_trades(trades, views.latest(trades, "ts"), timedelta(days=1))
    return found.select(
        "source", "market_id", "trade_id", wall("ts"), "trade_ts", "price", "size", "side", r6("notional")
    )


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    found = rolling_baseline(
        trades, views.latest(trades, "ts"), timedelta(days=7), recent=timedelta(days=1)
    )
    return _shown_baseline(found)


def _baseline_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades_wide(spark, sf_dir)
    return _shown_baseline(
        rolling_baseline(
            trades,
            views.latest(trades, "ts"),
            timedelta(days=1500),
            keys=("source", "market_id"),
            recent=timedelta(days=365),
        ),
        2,
    )


def _shown_baseline(found: DataFrame, decimals: int = 6) -> DataFrame:
    return found.select(
        "market_id",
        "n_trades",
        "n_recent",
        *[r6(c, decimals=decimals) for c in ("average_size", "stddev_size", "average_notional", "stddev_notional")],
    )


def _unusual(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    found = unusual_trades(trades, views.latest(trades, "ts"), PARAMS)
    return found.select(
        "alert_id",
        "source",
        "market_id",
        "trade_id",
        wall("ts"),
        "side",
        "price",
        "size",
        r6("notional"),
        r6("size_zscore"),
        r6("notional_zscore"),
    )


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return views.markets_a(spark, sf_dir), views.markets_b(spark, sf_dir), views.series(spark, sf_dir)


def _shown_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id",
        "series_ticker",
        "series_title",
        "source",
        "title",
        "market_id",
        "trade_id",
        "trade_ts",
        "side",
        "price",
        "size",
        *[r6(c) for c in ("notional", "size_zscore", "notional_zscore", "volume", "volume_24h")],
        wall("detected_at"),
    )


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    return _shown_alerts(
        enriched_alerts(trades, *_dimensions(spark, sf_dir), views.latest(trades, "ts"), PARAMS)
    )


def _new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    as_of = views.latest(trades, "ts")
    prior = trades.filter(F.col("trade_id").cast("bigint") % 2 == 0).select(
        F.sha2(F.concat("source", F.lit("|"), "trade_id"), 256).alias("alert_id"), F.col("ts").alias("detected_at")
    )
    found = detect_anomalies(
        trades, *_dimensions(spark, sf_dir), prior, as_of, PARAMS, known_since=PARAMS.lookback
    )
    return _shown_alerts(found)


def _repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades_wide(spark, sf_dir)
    found = enriched_alerts(trades, *_dimensions(spark, sf_dir), views.latest(trades, "ts"), WIDE)
    return found.select("alert_id", "market_id", "trade_id", "size", r6("notional"), r6("size_zscore"))


def _reason_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    found = enriched_alerts(trades, *_dimensions(spark, sf_dir), views.latest(trades, "ts"), PARAMS)
    names = ("market_id", "source", "title", "side", "size", "price", "notional", "reason", "trade_ts")
    return found.select("alert_id", "reason", alert_message(*[F.col(c) for c in names]).alias("message"))


def _local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = local_time(F.col("ts"), "America/Denver")
    return views.trades(spark, sf_dir).select(
        "trade_id", local.alias("trade_ts"), F.to_date(local).alias("local_date"), F.to_date("ts").alias("utc_date")
    )


QUERIES = {
    "unusual_trades": _unusual,
    "recent_trades": _recent,
    "rolling_baseline": _baseline,
    "rolling_baseline_by_source": _baseline_wide,
    "alerts_enriched": _enriched,
    "alerts_new_only": _new_only,
    "alerts_repeated_ids": _repeated_ids,
    "alert_reason_text": _reason_text,
    "local_trade_time": _local_time,
}


def _baseline_sql(lookback: str, recent: str) -> str:
    return f"""
baseline AS (
  SELECT market_id, count(*) AS n_trades, count(*) FILTER (ts > as_of - INTERVAL {recent}) AS n_recent,
         avg(size) AS average_size, stddev_samp(size) AS stddev_size,
         avg(price * size) AS average_notional, stddev_samp(price * size) AS stddev_notional
  FROM trades, clock
  WHERE ts > as_of - INTERVAL {lookback} AND ts <= as_of AND size IS NOT NULL AND price IS NOT NULL
  GROUP BY market_id HAVING count(*) >= 10
)"""


def _baseline_columns(decimals: int = 6) -> str:
    names = ("average_size", "stddev_size", "average_notional", "stddev_notional")
    return f"""
SELECT market_id, n_trades, n_recent, {", ".join(r6_sql(n, n, decimals) for n in names)}
FROM baseline"""


def scored_sql(recent: str, lookback: str, where: str) -> str:
    return f"""{_baseline_sql(lookback, recent)}, scored AS (
  SELECT t.*, price * size AS notional, as_of, average_size, average_notional,
         (size - average_size) / nullif(stddev_size, 0) AS size_zscore,
         (price * size - average_notional) / nullif(stddev_notional, 0) AS notional_zscore,
         sha256(source || '|' || trade_id) AS alert_id
  FROM trades t JOIN baseline b USING (market_id), clock
  WHERE ts > as_of - INTERVAL {recent} AND ts <= as_of
), flagged AS (
  SELECT * FROM scored WHERE {where}
)"""


_USUAL = "notional > 20 AND price < 0.90 AND abs(size_zscore) > 1.5 AND abs(notional_zscore) > 1.5"
FLAGGED_SQL = f"WITH {views.TRADES_SQL}, {scored_sql('7 DAY', '30 DAY', _USUAL)}"

_ALERTS_SQL = f"""{FLAGGED_SQL}, {views.DIMENSIONS_SQL}
SELECT alert_id, coalesce(a.series_ticker, b.event_ticker) AS series_ticker,
       coalesce(s.title, b.event_title) AS series_title, f.source, coalesce(a.title, b.slug_title) AS title,
       market_id, trade_id, timezone('America/Denver', timezone('UTC', ts)) AS trade_ts, side, price, size,
       {r6_sql("notional", "notional")}, {r6_sql("size_zscore", "size_zscore")},
       {r6_sql("notional_zscore", "notional_zscore")},
       {r6_sql("coalesce(a.volume_fp * 100, b.volume)", "volume")},
       {r6_sql("coalesce(a.volume_24h_fp * 100, b.volume_24h)", "volume_24h")}, as_of AS detected_at
FROM flagged f LEFT JOIN markets_a a ON market_id = a.ticker LEFT JOIN markets_b b ON market_id = b.id
LEFT JOIN series s ON a.series_ticker = s.ticker"""

def volume_sql(v: str) -> str:
    scaled = " ".join(
        f"WHEN abs({v}) >= {unit} THEN '$' || {fixed_sql(f'{v} / {unit}', 1)} || '{letter}'"
        for unit, letter in (("1e9::DOUBLE", "B"), ("1e6::DOUBLE", "M"), ("1e3::DOUBLE", "K"))
    )
    return f"CASE WHEN {v} IS NULL THEN '$0' {scaled} ELSE '$' || {fixed_sql(v, 0)} END"


def message_sql(title: str, side: str, reason: str) -> str:
    return f"""'Unusual trade on ' || market_id || ' (' || source || ')' || chr(10)
  || '**' || CASE WHEN coalesce({title}, '') <> '' THEN '_' || {title} || '_' || chr(10) ELSE '' END || '**'
  || 'Side: ' || coalesce(nullif({side}, ''), '?') || '  Size: ' || CAST(size AS VARCHAR)
  || '  Price: $' || {fixed_sql("price", 3)} || '  Notional: $' || {fixed_sql("notional", 2)} || chr(10)
  || 'Trigger: ' || {reason} || chr(10)
  || 'Trade time: ' || regexp_replace(strftime(trade_ts, '%Y-%m-%dT%H:%M:%S.%f'), '[.]000000$', '')"""


_REASON_SQL = f"""'size=' || {fixed_sql("size", 2)} || ' (z=' || {fixed_sql("round(size_zscore, 9)", 2)} || ' vs avg '
  || {fixed_sql("round(average_size, 9)", 1)} || '), notional=$' || {fixed_sql("notional", 2)} || ' (z='
  || {fixed_sql("round(notional_zscore, 9)", 2)} || ' vs avg $' || {fixed_sql("round(average_notional, 9)", 2)}
  || '), market vol=' || {volume_sql("volume")} || ' (24h ' || {volume_sql("volume_24h")} || ')'"""

_TEXT_SQL = f"""{FLAGGED_SQL}, {views.DIMENSIONS_SQL}, described AS (
  SELECT f.*, coalesce(a.title, b.slug_title) AS title, coalesce(a.volume_fp * 100, b.volume) AS volume,
         coalesce(a.volume_24h_fp * 100, b.volume_24h) AS volume_24h,
         timezone('America/Denver', timezone('UTC', ts)) AS trade_ts
  FROM flagged f LEFT JOIN markets_a a ON market_id = a.ticker LEFT JOIN markets_b b ON market_id = b.id
), reasoned AS (SELECT *, {_REASON_SQL} AS reason FROM described)
SELECT alert_id, reason, {message_sql("title", "side", "reason")} AS message FROM reasoned"""

UNUSUAL_COLUMNS = f"""
SELECT alert_id, source, market_id, trade_id, ts, side, price, size, {r6_sql("notional", "notional")},
       {r6_sql("size_zscore", "size_zscore")}, {r6_sql("notional_zscore", "notional_zscore")}
FROM flagged"""

ORACLES = {
    "unusual_trades": FLAGGED_SQL + UNUSUAL_COLUMNS,
    "recent_trades": f"""WITH {views.TRADES_SQL}
SELECT source, market_id, trade_id, ts, timezone('America/Denver', timezone('UTC', ts)) AS trade_ts, price, size, side,
       {r6_sql("price * size", "notional")}
FROM trades, clock
WHERE ts > as_of - INTERVAL 1 DAY AND ts <= as_of AND size IS NOT NULL AND price IS NOT NULL""",
    "rolling_baseline": f"WITH {views.TRADES_SQL}, {_baseline_sql('7 DAY', '1 DAY')} {_baseline_columns()}",
    "rolling_baseline_by_source": (
        f"WITH {views.TRADES_WIDE_SQL}, {_baseline_sql('1500 DAY', '365 DAY')} {_baseline_columns(2)}"
    ),
    "alerts_enriched": _ALERTS_SQL,
    "alerts_new_only": _ALERTS_SQL
    + """
WHERE NOT EXISTS (
  SELECT 1 FROM trades p WHERE p.event_id % 2 = 0 AND sha256(p.source || '|' || p.event_id) = f.alert_id)""",
    "alerts_repeated_ids": f"""WITH {views.TRADES_WIDE_SQL}, {scored_sql(
        '365 DAY', '1500 DAY',
        'notional > 1000 AND price < 1e9 AND (abs(size_zscore) > 1.2 OR abs(notional_zscore) > 1.2)')},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ts, size DESC, market_id) AS rn FROM flagged
)
SELECT alert_id, market_id, trade_id, size, {r6_sql("notional", "notional")}, {r6_sql("size_zscore", "size_zscore")}
FROM ranked WHERE rn = 1""",
    "alert_reason_text": _TEXT_SQL,
    "local_trade_time": """
SELECT CAST(event_id AS VARCHAR) AS trade_id, timezone('America/Denver', timezone('UTC', ts)) AS trade_ts,
       CAST(timezone('America/Denver', timezone('UTC', ts)) AS DATE) AS local_date, CAST(ts AS DATE) AS utc_date
FROM events""",
}
