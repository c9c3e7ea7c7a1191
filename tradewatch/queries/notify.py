"""Registered queries on the notification cycle."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.plans.notify import (
    alert_groups,
    debate_requests,
    mark_notified,
    notifications,
    pending_queue,
    recent_threads,
    settle_deliveries,
    thread_buckets,
)
from tradewatch.plans.pending import admitted, handed_out, settled as settle_reports, still_open, told_threads, waiting
from tradewatch.plans.requests import thread_latest_alert
from tradewatch.queries import views
from tradewatch.queries.detection import message_sql
from tradewatch.queries.shape import wall
from tradewatch import schemas
from tradewatch.session import stored
from tradewatch.sources.tables import STATE, outbox

_WITHIN = timedelta(days=1)


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_queue(views.alerts(spark, sf_dir)).select(
        *[F.col(c).cast("bigint") for c in ("queue_pos", "page", "group_pos", "rank_in_group")],
        "is_starter",
        "alert_id",
        "source",
        "thread_key",
    )


def _as_of(spark: SparkSession, sf_dir: str):
    return views.latest(views.table(spark, sf_dir, "events"), "ts")


def _threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_threads(views.alerts(spark, sf_dir), _as_of(spark, sf_dir), _WITHIN)


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = notifications(views.alerts(spark, sf_dir), _as_of(spark, sf_dir), within=_WITHIN)
    return settle_deliveries(queue, views.deliveries(queue))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_notified(views.alerts(spark, sf_dir), settled(spark, sf_dir), _as_of(spark, sf_dir))
    return marked.select("alert_id", wall("notified_at"), "discord_thread_id")


def _buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thread_buckets(settled(spark, sf_dir)).select(
        "thread_id", "n", F.array_join("alert_ids", ",").alias("alert_ids")
    )


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_groups(pending_queue(views.alerts(spark, sf_dir))).select(
        "source", "thread_key", "group_pos", "n", F.array_join("alert_ids", ",").alias("alert_ids")
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debate_requests(settled(spark, sf_dir))


def _outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox(_requests(spark, sf_dir), "alert_id")


def _late_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One handing out of all waiting alerts and two rounds of reports. Reports of one alert in four come in the second
    round only and of one in nine never; in each round reports repeat and contradict those of successes."""
    at, alerts = _as_of(spark, sf_dir), views.alerts(spark, sf_dir)
    none = spark.createDataFrame([], schemas.PENDING)
    pending = stored(admitted(none, alerts, spark.createDataFrame([], STATE)), "open")
    queue = stored(notifications(waiting(pending), at, within=_WITHIN, told=alerts), "queue")
    number = F.col("trade_id").cast("bigint")
    reports = views.deliveries(queue).join(alerts.select("alert_id", (number % 4 == 1).alias("late"), (number % 9 == 2).alias("never")), "alert_id")
    reports = reports.filter(~F.col("never"))
    early, late = reports.filter(~F.col("late")), reports.filter("late")
    denied = early.withColumn("ok", F.lit(False))
    first = stored(settle_reports(handed_out(pending, queue, "r1", at), early.unionByName(early).unionByName(denied)), "first")
    second = stored(settle_reports(still_open(first), late.unionByName(denied)), "second")
    rounds = [(1, first), (2, second)]
    told = [told_threads(x, at + timedelta(minutes=5 * k)).select("alert_id", F.col("discord_thread_id").alias("thread_id")) for k, x in rounds]
    marks = [
        x.select("alert_id", F.when(F.col("sent"), k).alias("told_in"), F.when(F.col("started_now"), k).alias("asked_in"), F.lit(None).cast("boolean").alias("waits"))
        for k, x in rounds
    ]
    last = still_open(second).select(
        "alert_id", F.lit(None).cast("int").alias("told_in"), F.lit(None).cast("int").alias("asked_in"), F.col("handed_batch").isNull().alias("waits")
    )
    whole = marks[0].unionByName(marks[1]).unionByName(last).groupBy("alert_id")
    found = whole.agg(*[F.min(c).alias(c) for c in ("told_in", "asked_in")], F.bool_or("waits").alias("waits"))
    return found.join(told[0].unionByName(told[1]), "alert_id", "left")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = notifications(views.alerts(spark, sf_dir), _as_of(spark, sf_dir), within=_WITHIN)
    return queue.select("alert_id", "thread_id", "thread_title", "message")


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thread_latest_alert(views.alerts(spark, sf_dir)).select(
        "discord_thread_id", "alert_id", "source", "series_ticker", "market_id", "title"
    )


QUERIES = {
    "notify_queue": _queue,
    "recent_threads": _threads,
    "mark_notified": _marked,
    "thread_buckets": _buckets,
    "alert_groups": _groups,
    "debate_requests": _requests,
    "request_outbox": _outbox,
    "notification_texts": _texts,
    "thread_latest_alert": _latest,
    "late_deliveries": _late_deliveries,
}

_QUEUE_SQL = f"""WITH {views.ALERTS_SQL}, top AS (
  SELECT *, row_number() OVER (ORDER BY coalesce(series_title, title) NULLS FIRST, detected_at, alert_id) AS queue_pos
  FROM alerts WHERE notified_at IS NULL
), queue AS (
  SELECT *, min(queue_pos) OVER (PARTITION BY source, thread_key) AS group_pos,
         row_number() OVER (PARTITION BY source, thread_key ORDER BY queue_pos) AS rank_in_group
  FROM top
)"""

_THREADS_SQL = """threads AS (
  SELECT source, series_ticker, arg_max(discord_thread_id, {'a': notified_at, 'b': discord_thread_id}) AS thread_id
  FROM alerts, clock
  WHERE notified_at > as_of - INTERVAL 1 DAY AND notified_at <= as_of AND discord_thread_id IS NOT NULL
    AND series_ticker IS NOT NULL
  GROUP BY ALL
)"""

_SETTLED_SQL = f"""{_QUEUE_SQL}, {_THREADS_SQL}, delivered AS (
  SELECT q.*, t.thread_id AS reused,
         coalesce(t.thread_id, CASE WHEN rank_in_group = 1 AND group_pos % 5 <> 0 THEN 'new-' || group_pos END) AS opened,
         group_pos % 4 <> 0 AND rank_in_group % 7 <> 0 AS ok
  FROM queue q LEFT JOIN threads t ON t.source = q.source AND t.series_ticker = q.thread_key
), settled AS (
  SELECT *, ok AND group_pos % 4 <> 0 AS sent,
         CASE WHEN group_pos % 4 <> 0 THEN
           coalesce(reused, max(opened) FILTER (rank_in_group = 1) OVER (PARTITION BY source, thread_key)) END
           AS group_thread
  FROM delivered
)"""

REQUESTS_SQL = f"""{_SETTLED_SQL}, chosen AS (
  SELECT *, row_number() OVER (PARTITION BY source, market_id ORDER BY group_pos, rank_in_group) AS rn
  FROM settled WHERE group_thread IS NOT NULL
)"""

ORACLES = {
    "notify_queue": f"""{_QUEUE_SQL}
SELECT queue_pos, CAST(ceil(queue_pos / 50) AS BIGINT) AS page, group_pos, rank_in_group, rank_in_group = 1 AS is_starter, alert_id, source, thread_key FROM queue""",
    "recent_threads": f"WITH {views.ALERTS_SQL}, {_THREADS_SQL} SELECT * FROM threads",
    "mark_notified": f"""{_SETTLED_SQL}
SELECT a.alert_id, CASE WHEN s.sent THEN as_of ELSE a.notified_at END AS notified_at,
       CASE WHEN s.sent THEN coalesce(s.group_thread, a.discord_thread_id) ELSE a.discord_thread_id END
         AS discord_thread_id
FROM alerts a LEFT JOIN settled s ON s.alert_id = a.alert_id, clock""",
    "thread_buckets": f"""{_SETTLED_SQL}
SELECT group_thread AS thread_id, count(*) AS n, string_agg(alert_id, ',' ORDER BY alert_id) AS alert_ids
FROM settled WHERE sent GROUP BY 1""",
    "alert_groups": f"""{_QUEUE_SQL}
SELECT source, thread_key, min(queue_pos) AS group_pos, count(*) AS n,
       string_agg(alert_id, ',' ORDER BY queue_pos) AS alert_ids
FROM queue GROUP BY 1, 2""",
    "debate_requests": f"""{REQUESTS_SQL}
SELECT alert_id, source, series_ticker, market_id, title, group_thread AS thread_id FROM chosen WHERE rn = 1""",
    "request_outbox": f"""{REQUESTS_SQL}
SELECT alert_id AS key, CAST(json_object('alert_id', alert_id, 'source', source, 'series_ticker', series_ticker,
       'market_id', market_id, 'title', title, 'thread_id', group_thread) AS VARCHAR) AS value
FROM chosen WHERE rn = 1""",
    "notification_texts": f"""{_SETTLED_SQL}
SELECT alert_id, reused AS thread_id,
       CASE WHEN rank_in_group = 1 AND reused IS NULL
            THEN coalesce(series_title, title, source || ': ' || market_id) END AS thread_title,
       {message_sql("title", "side", "reason")} AS message
FROM settled""",
    "late_deliveries": f"""{_SETTLED_SQL}, reported AS (
  SELECT *, event_id % 4 = 1 AS late, event_id % 9 = 2 AS never FROM settled
), grouped AS (
  SELECT *, bool_or(ok) FILTER (rank_in_group = 1) OVER g AS start_ok, bool_or(late) FILTER (rank_in_group = 1) OVER g AS start_late,
         bool_or(never) FILTER (rank_in_group = 1) OVER g AS start_never
  FROM reported WINDOW g AS (PARTITION BY source, thread_key)
), judged AS (
  SELECT *, start_ok AND NOT start_never AS started, start_ok AND NOT start_never AND ok AND NOT never AS told FROM grouped
)
SELECT alert_id, CAST(CASE WHEN told THEN CASE WHEN start_late OR late THEN 2 ELSE 1 END END AS INTEGER) AS told_in,
       CAST(CASE WHEN started THEN CASE WHEN start_late THEN 2 ELSE 1 END END AS INTEGER) AS asked_in,
       CASE WHEN NOT told THEN NOT (start_never OR (started AND never)) END AS waits,
       CASE WHEN told THEN group_thread END AS thread_id
FROM judged""",
    "thread_latest_alert": f"""WITH {views.ALERTS_SQL}
SELECT discord_thread_id, alert_id, source, series_ticker, market_id, title FROM alerts
WHERE discord_thread_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY discord_thread_id ORDER BY detected_at DESC, alert_id DESC) = 1""",
}
