"""Registered queries on operations: volumes, freshness, logs, windows, table layout."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators import reports
from tradewatch.queries import views
from tradewatch.queries.shape import r6, r6_sql, wall
from tradewatch.session import shared_folder
from tradewatch.sources.config import read_intent, valid_subscriptions
from tradewatch.sources.tables import (
    append_alerts,
    append_debates,
    read_subscriptions,
    read_table,
    refresh_series,
    replace_subscriptions,
    write_table,
    write_transcripts,
)

_RUN = datetime(2024, 2, 1)


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = views.trades(spark, sf_dir)
    found = reports.source_summary(trades, views.latest(trades, "ts"))
    return found.select("source", "trades", wall("first", "first_ts"), wall("latest", "latest_ts"))


def _latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_alerts(views.alerts(spark, sf_dir)).withColumn("detected_at", wall("detected_at"))


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.ingest_freshness(views.trades(spark, sf_dir), "venue_a")
    return found.select("trades", wall("latest_ingest"))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines of 32 connections."""
    name = (
        F.when(F.col("event_type") == "view", "subscribed")
        .when(F.col("event_type") == "error", "connection_dropped")
        .when(F.col("event_type") == "signup", "connection_reconnect")
        .otherwise("heartbeat")
    )
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    connection = F.col("user_id") % 32
    line = F.to_json(
        F.struct(name.alias("event"), connection.alias("idx"), iso.alias("timestamp"), F.lit("info").alias("level"))
    )
    return views.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 103 == 0, "plain text").otherwise(line).alias("value")
    )


def _connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = views.latest(views.table(spark, sf_dir, "events"), "ts")
    return reports.subscribed_connections(
        reports.parsed_logs(_logs(spark, sf_dir)), "subscribed", as_of, timedelta(hours=6)
    )


def _flapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.flapping(
        reports.parsed_logs(_logs(spark, sf_dir)), ["connection_dropped", "connection_reconnect"]
    )


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.overlap_windows(views.trades(spark, sf_dir))
    return found.select(wall("window_start"), wall("window_end"), "source", "n", r6("notional"))


def _late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.late_arrivals(views.trades(spark, sf_dir))


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts, debates and subscriptions written, replaced per source and read back, as counts."""
    root = shared_folder(spark, "layout")
    alerts = views.alerts(spark, sf_dir)
    append_alerts(alerts, f"{root}/alerts")
    append_debates(views.debates(spark, sf_dir), f"{root}/debates")
    followed = views.tokens(spark, sf_dir).select(
        F.lit("venue_b").alias("source"), "market_id", "yes_token_id", "no_token_id", F.lit(0).cast("bigint").alias("position")
    )
    both = followed.unionByName(followed.withColumn("source", F.lit("venue_a")))
    gone = both.withColumn("source", F.lit("venue_c"))
    for source in ("venue_a", "venue_b", "venue_c"):
        replace_subscriptions(both.unionByName(gone), f"{root}/subs", source, _RUN)
    replace_subscriptions(followed.filter(F.col("no_token_id").isNotNull()), f"{root}/subs", "venue_b", _RUN + timedelta(hours=1))
    replace_subscriptions(gone.limit(0), f"{root}/subs", "venue_c", _RUN + timedelta(hours=1))
    # a run that broke off before its end does not count
    write_table(followed.limit(1).drop("source"), f"{root}/subs/source=venue_a/version=9999999999999999")
    evolved = read_table(spark, f"{root}/alerts", schemas.ALERTS, "reviewed_by string, detected_date date")
    stored = [
        ("alerts", evolved.filter(F.col("reviewed_by").isNull()), "alert_id", ["title", "side", "reason", "discord_thread_id"]),
        ("debates", read_table(spark, f"{root}/debates", schemas.DEBATES), "debate_id", ["series_ticker", "market_id", "title", "outcome"]),
        ("subscriptions", read_subscriptions(spark, f"{root}/subs", ("venue_a", "venue_b", "venue_c")), "market_id", ["yes_token_id", "no_token_id"]),
    ]
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            "source",
            F.col(key).alias("key"),
            F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in texts]).alias("payload"),
        )
        for name, df, key, texts in stored
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _transcript_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts as JSON lines, a folder per hundred debates, read back per debate."""
    root = shared_folder(spark, "transcripts")
    entries = views.transcripts(spark, sf_dir)
    write_transcripts(entries, root, folder=F.floor(F.col("debate_id").cast("bigint") / 100))
    back = spark.read.schema(schemas.TRANSCRIPTS).json(root)
    return back.select(
        "debate_id", "seq", "turn", "moderator", "provider", "text", r6("cost_usd"), "input_tokens", "error", "decision"
    )


def _column_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts stored before and after the table got a column; older files lack it and read as NULL."""
    path = f"{shared_folder(spark, 'evolved')}/alerts"
    alerts = views.alerts(spark, sf_dir)
    old = F.col("trade_id").cast("bigint") % 2 == 0
    append_alerts(alerts.filter(old), path, "before")
    append_alerts(alerts.filter(~old).withColumn("reviewed_by", F.concat(F.lit("r"), F.col("trade_id"))), path, "after")
    stored = read_table(spark, path, schemas.ALERTS, "reviewed_by string, batch_id string, detected_date date")
    return stored.select("alert_id", "batch_id", "reviewed_by", "detected_date")


def _series_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series table after two refreshes: only the second run's rows, under one timestamp."""
    path = f"{shared_folder(spark, 'series')}/series"
    series = schemas.conform(views.series(spark, sf_dir), schemas.SERIES)
    refresh_series(series, path, datetime(2024, 1, 1, tzinfo=timezone.utc))
    refresh_series(series.filter(F.col("title").isNotNull()), path, datetime(2024, 2, 1, tzinfo=timezone.utc))
    return read_table(spark, path, schemas.SERIES).select("ticker", "title", wall("resolved_at"))


def _intent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An intent file of the nations' names, written as text and read back."""
    path = f"{shared_folder(spark, 'intent')}/intent.json"
    names = F.array_sort(F.collect_list("n_name"))
    body = F.struct(
        F.struct(names.alias("categories"), F.array(F.lit("T1"), F.lit("T2")).alias("tickers")).alias("venue_a"),
        F.struct(F.transform(names, lambda x: F.lower(x)).alias("tag_slug")).alias("venue_b"),
        F.struct(F.lit(True).alias("enabled")).alias("debater"),
    )
    views.table(spark, sf_dir, "nation").agg(F.to_json(body).alias("value")).coalesce(1).write.text(path)
    found = read_intent(spark, path)
    rows = [("category", x) for x in found.categories] + [("ticker", x) for x in found.tickers]
    rows += [("tag", x) for x in found.tag_slugs] + [("debates", str(found.debates_enabled)), ("publish", str(found.debates_auto_publish))]
    return spark.createDataFrame(rows, "kind string, value string")


def _valid_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as token subscriptions; some lack an id, some are no object."""
    key = F.col("c_custkey")
    fields = F.struct(
        F.concat(F.lit("m"), key).alias("market_id"),
        F.when(key % 5 != 0, F.concat(F.lit("y"), key)).alias("yes_token_id"),
        F.when(key % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("n"), key)).alias("no_token_id"),
    )
    payload = F.when(key % 11 == 0, F.lit("[1]")).when(key % 13 == 0, F.lit("{broken")).otherwise(F.to_json(fields))
    items = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("position"), payload.alias("payload"))
    return valid_subscriptions(items)


QUERIES = {
    "column_added": _column_added,
    "series_refreshed": _series_refreshed,
    "intent_file": _intent,
    "subscriptions_valid": _valid_subscriptions,
    "source_summary": _sources,
    "latest_alerts": _latest_alerts,
    "ingest_freshness": _freshness,
    "log_health": _connections,
    "log_flapping": _flapping,
    "overlap_windows": _windows,
    "late_arrivals": _late,
    "layout_roundtrip": _layout,
    "transcript_files": _transcript_files,
}

ORACLES = {
    "column_added": f"""WITH {views.ALERTS_SQL}
SELECT alert_id, CASE WHEN event_id % 2 = 0 THEN 'before' ELSE 'after' END AS batch_id,
       CASE WHEN event_id % 2 <> 0 THEN 'r' || event_id END AS reviewed_by, CAST(detected_at AS DATE) AS detected_date
FROM alerts""",
    "series_refreshed": f"""WITH {views.DIMENSIONS_SQL}
SELECT ticker, title, TIMESTAMP '2024-02-01' AS resolved_at FROM series WHERE title IS NOT NULL""",
    "intent_file": """
SELECT 'category' AS kind, n_name AS value FROM nation UNION ALL SELECT 'tag', lower(n_name) FROM nation
UNION ALL SELECT * FROM (VALUES ('ticker', 'T1'), ('ticker', 'T2'), ('debates', 'True'), ('publish', 'True'))""",
    "subscriptions_valid": """
SELECT c_custkey AS position, 'm' || c_custkey AS market_id, 'y' || c_custkey AS yes_token_id, 'n' || c_custkey AS no_token_id
FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0""",
    "source_summary": f"""WITH {views.TRADES_SQL}
SELECT source, count(*) AS trades, min(ts) AS first_ts, max(ts) AS latest_ts
FROM trades, clock WHERE CAST(ts AS DATE) = CAST(as_of AS DATE) GROUP BY source""",
    "latest_alerts": f"""WITH {views.ALERTS_SQL}
SELECT detected_at, alert_id, source, market_id, title, side, size, price, reason
FROM alerts ORDER BY detected_at DESC, alert_id LIMIT 20""",
    "ingest_freshness": f"""WITH {views.TRADES_SQL}
SELECT count(*) AS trades, max(ingested_at) AS latest_ingest FROM trades WHERE source = 'venue_a'""",
    "log_health": """
SELECT count(DISTINCT user_id % 32) AS connections FROM events
WHERE event_type = 'view' AND event_id % 103 <> 0 AND ts > (SELECT max(ts) FROM events) - INTERVAL 6 HOUR""",
    "log_flapping": """
SELECT user_id % 32 AS idx,
       CASE event_type WHEN 'error' THEN 'connection_dropped' ELSE 'connection_reconnect' END AS event, count(*) AS n
FROM events WHERE event_type IN ('error', 'signup') AND event_id % 103 <> 0 GROUP BY 1, 2""",
    "overlap_windows": f"""WITH {views.TRADES_SQL}, placed AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * o AS window_start, source, price * size AS notional
  FROM trades, (VALUES (0), (1)) v(o)
)
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, source, count(*) AS n,
       {r6_sql("sum(notional)", "notional")}
FROM placed GROUP BY window_start, source""",
    "late_arrivals": f"""WITH {views.TRADES_SQL}
SELECT source, CAST(ts AS DATE) AS day, count(*) AS trades,
       count(*) FILTER (ingested_at - ts > INTERVAL 30 MINUTE) AS late,
       CAST(max(epoch_us(ingested_at) - epoch_us(ts)) AS DOUBLE) / 1e6 AS max_delay_s
FROM trades GROUP BY 1, 2""",
    "layout_roundtrip": f"""WITH {views.ALERTS_SQL}, {views.DEBATES_SQL}, {views.TOKENS_SQL}
SELECT 'alerts' AS table_name, source, alert_id AS key,
       concat_ws('|', coalesce(title, '-'), coalesce(side, '-'), coalesce(reason, '-'), coalesce(discord_thread_id, '-')) AS payload
FROM alerts
UNION ALL
SELECT 'debates', source, debate_id,
       concat_ws('|', coalesce(series_ticker, '-'), coalesce(market_id, '-'), coalesce(title, '-'), coalesce(outcome, '-'))
FROM debates
UNION ALL
SELECT 'subscriptions', s, market_id, coalesce(yes_token_id, '-') || '|' || coalesce(no_token_id, '-')
FROM tokens, (VALUES ('venue_a'), ('venue_b')) v(s) WHERE s = 'venue_a' OR no_token_id IS NOT NULL""",
    "transcript_files": f"""WITH {views.TRANSCRIPTS_SQL}
SELECT debate_id, seq, turn, moderator, provider, text, {r6_sql("cost_usd", "cost_usd")}, input_tokens, error, decision
FROM transcripts""",
}
