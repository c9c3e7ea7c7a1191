"""Notification cycle: pending alerts to an ordered queue, deliveries back to the alerts table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.functions.coerce import blank_to_null, instant
from tradewatch.functions.text import alert_message, thread_key, thread_title
from tradewatch.operators.numbering import numbered
from tradewatch.operators.skew import first_per_key


def pending_queue(alerts: DataFrame, page: int = 50) -> DataFrame:
    """All alerts that wait to be sent, numbered, dealt into pages of `page` and grouped by thread.

    A sender takes page after page until none is left, so no alert waits behind newer ones. Groups are ordered by their
    first alert, which starts the group's thread. Alerts are numbered by ranges of title and moment, and a group's alerts by
    counts per range, so neither all alerts nor those of one title or thread meet in one task.
    """
    label = F.coalesce("series_title", "title")
    waiting = alerts.filter(F.col("notified_at").isNull()).withColumn(
        "thread_key", thread_key(F.col("series_ticker"), F.col("market_id"))
    )
    rows = numbered(waiting, [label, "detected_at", "alert_id"], name="__number", ranks={"__rank": ["source", "thread_key"]})
    return (
        rows.withColumn("queue_pos", F.col("__number") + 1)
        .withColumn("page", F.ceil(F.col("queue_pos") / F.lit(page)).cast("bigint"))
        .withColumn("group_pos", F.col("__rank_first") + 1)
        .withColumn("rank_in_group", F.col("__rank") + 1)
        .withColumn("is_starter", F.col("__rank") == 0)
        .drop("__number", "__rank", "__rank_first")
    )


def recent_threads(alerts: DataFrame, as_of: datetime, within: timedelta = timedelta(hours=1)) -> DataFrame:
    """The latest thread of every (source, series) notified within the lookback."""
    return (
        alerts.filter(
            (F.col("notified_at") > instant(as_of - within))
            & (F.col("notified_at") <= instant(as_of))
            & F.col("discord_thread_id").isNotNull()
            & F.col("series_ticker").isNotNull()
        )
        .groupBy("source", "series_ticker")
        .agg(F.max_by("discord_thread_id", F.struct("notified_at", "discord_thread_id")).alias("thread_id"))
    )


def notifications(
    alerts: DataFrame, as_of: datetime, page: int = 50, within: timedelta = timedelta(hours=1), told: DataFrame | None = None
) -> DataFrame:
    """The queue with message texts; `thread_id` is the thread to reuse or NULL for a new one.

    Threads to reuse are those of `told` (alerts or threads with the time of their notification), or of `alerts` themselves.
    """
    queue = pending_queue(alerts, page)
    threads = recent_threads(alerts if told is None else told, as_of, within).select(
        "source", F.col("series_ticker").alias("thread_key"), blank_to_null(F.col("thread_id")).alias("thread_id")
    )
    message = alert_message(
        *[F.col(c) for c in ("market_id", "source", "title", "side", "size", "price", "notional", "reason", "trade_ts")]
    )
    new_title = thread_title(F.col("series_title"), F.col("title"), F.col("source"), F.col("market_id"))
    return (
        queue.join(threads, ["source", "thread_key"], "left")
        .withColumn("message", message)
        .withColumn("thread_title", F.when(F.col("is_starter") & F.col("thread_id").isNull(), new_title))
        .select(
            "queue_pos",
            "page",
            "group_pos",
            "rank_in_group",
            "is_starter",
            "alert_id",
            "detected_at",
            "source",
            "series_ticker",
            "market_id",
            "title",
            "thread_key",
            "thread_id",
            "thread_title",
            "message",
        )
    )


def settle_deliveries(queue: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The queue with `sent` and the thread each group ended up in.

    `deliveries` holds alert_id, thread_id and ok; of several reports for one alert a success counts. A group's thread is the reused one or the one its
    starter opened; when the starter failed, nothing of the group counts as sent.
    """
    group = W.partitionBy(*[c for c in ("batch_id",) if c in queue.columns], "source", "thread_key")
    ok = F.coalesce("ok", F.lit(False))
    back = deliveries.groupBy("alert_id").agg(F.max(F.when(ok, F.col("thread_id"))).alias("opened"), F.bool_or(ok).alias("ok"))
    started = F.bool_or(F.col("is_starter") & F.coalesce("ok", F.lit(False))).over(group)
    opened = F.max(F.when(F.col("is_starter") & F.col("ok"), blank_to_null(F.col("opened")))).over(group)
    return (
        queue.join(back, "alert_id", "left")
        .withColumn("group_started", started)
        .withColumn("group_thread", F.when(F.col("group_started"), F.coalesce("thread_id", opened)))
        .withColumn("sent", F.col("group_started") & F.coalesce("ok", F.lit(False)))
        .drop("opened", "ok")
    )


def sent_state(settled: DataFrame, as_of: datetime) -> DataFrame:
    """What a cycle adds to the table of notification state: one row per alert that was sent."""
    return settled.filter("sent").groupBy("alert_id").agg(
        F.max("group_thread").alias("discord_thread_id"), F.lit(instant(as_of)).alias("notified_at")
    )


def with_state(alerts: DataFrame, state: DataFrame) -> DataFrame:
    """Alerts with the time and thread of their latest notification, where the state table has one.

    The alerts table itself is only ever appended to. Of several states of an alert the latest counts.
    """
    latest = state.groupBy("alert_id").agg(
        F.max("notified_at").alias("__at"),
        F.max_by("discord_thread_id", F.when(F.col("discord_thread_id").isNotNull(), F.struct("notified_at", "discord_thread_id"))).alias("__thread"),
    )
    return (
        alerts.join(latest, "alert_id", "left")
        .withColumn("notified_at", F.coalesce("__at", "notified_at"))
        .withColumn("discord_thread_id", F.coalesce("__thread", "discord_thread_id"))
        .select(*alerts.columns)
    )


def mark_notified(alerts: DataFrame, settled: DataFrame, as_of: datetime) -> DataFrame:
    """The alerts after the cycle: sent alerts have a time and, if there is one, a thread."""
    return with_state(alerts, sent_state(settled, as_of))


def thread_buckets(settled: DataFrame) -> DataFrame:
    """The cycle's sent alerts by thread, NULL for none; no larger than the queue."""
    return (
        settled.filter("sent")
        .groupBy(F.col("group_thread").alias("thread_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("alert_id")).alias("alert_ids"))
    )


def alert_groups(queue: DataFrame) -> DataFrame:
    """The cycle's alerts by thread key, in queue order; no larger than the queue."""
    ordered = F.array_sort(F.collect_list(F.struct("queue_pos", "alert_id")))
    return queue.groupBy("source", "thread_key").agg(
        F.min("queue_pos").cast("bigint").alias("group_pos"),
        F.count(F.lit(1)).alias("n"),
        F.transform(ordered, lambda a: a["alert_id"]).alias("alert_ids"),
    )


def debate_requests(settled: DataFrame, enabled: bool = True, auto_publish: bool = True) -> DataFrame:
    """One request per (source, market) of the groups that have a thread, first in queue order."""
    if not (enabled and auto_publish):
        settled = settled.limit(0)
    chosen = first_per_key(
        settled.filter(F.col("group_thread").isNotNull()),
        ["source", "market_id"],
        [F.col("group_pos"), F.col("rank_in_group")],
    )
    return chosen.select(
        "alert_id", "source", "series_ticker", "market_id", "title", F.col("group_thread").alias("thread_id")
    )
