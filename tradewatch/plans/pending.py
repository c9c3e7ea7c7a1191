"""The open set of alerts: what waits to be told and what has been handed to the sender without an answer yet.

An alert enters when detection has written it and leaves when a report says it was sent, however long that takes. The set is
carried from cycle to cycle, so neither the history of alerts nor that of the notification state is read.

A handed-out alert belongs to its cycle's group (source and thread). A group counts as started once its starter is reported as
sent. Reports may come late, one by one, repeated or contradicting: of all reports of an alert a success counts, also after a failure
has put the alert back into the queue. An alert without a report stays handed out and is not handed out again, unless the
caller names a time after which it is.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.coerce import blank_to_null, instant
from tradewatch.functions.text import thread_key
from tradewatch.operators.skew import first_per_key, salted_join

_GROUP = ["handed_batch", "source", "thread_key"]


def admitted(pending: DataFrame, fresh: DataFrame, state: DataFrame) -> DataFrame:
    """The open set with the alerts of new batches. Ids that are open already, or that were told before (`state`), stay out."""
    one = first_per_key(fresh, ["alert_id"], [F.col("detected_at"), F.col("market_id")]).filter("notified_at IS NULL")
    known = pending.select("alert_id").unionByName(state.select("alert_id"))
    return pending.unionByName(schemas.conform(one.join(known, "alert_id", "left_anti"), schemas.PENDING))


def waiting(pending: DataFrame, as_of: datetime | None = None, retry_after: timedelta | None = None) -> DataFrame:
    """The alerts that are not handed out, or with `retry_after` not since so long."""
    free = F.col("handed_batch").isNull()
    if as_of is not None and retry_after is not None:
        free = free | (F.col("handed_at") <= instant(as_of - retry_after))
    return pending.filter(free).select(*schemas.ALERTS.names)


def handed_out(pending: DataFrame, queue: DataFrame, batch: str, as_of: datetime) -> DataFrame:
    """The open set after a cycle handed `queue` to the sender."""
    given = queue.select(
        "alert_id",
        F.struct(
            F.lit(batch).alias("handed_batch"), F.lit(instant(as_of)).alias("handed_at"), F.col("group_pos").cast("bigint").alias("group_pos"),
            F.col("rank_in_group").cast("bigint").alias("rank_in_group"), "is_starter", F.col("thread_id").alias("reused_thread"),
            *[F.lit(None).cast(schemas.HANDED[c].dataType).alias(c) for c in schemas.HANDED.names[6:]],
        ).alias("__given"),
    )
    new = [F.when(F.col("__given").isNotNull(), F.col(f"__given.{c}")).otherwise(F.col(c)).alias(c) for c in schemas.HANDED.names]
    return pending.join(given, "alert_id", "left").select(*schemas.ALERTS.names, *new)


def settled(pending: DataFrame, reports: DataFrame) -> DataFrame:
    """The open set with what `reports` (alert_id, thread_id, ok) say: `sent`, and `started_now` where the group started by them.

    The columns of the latest handing out are those that the alert goes on with if it was not sent.
    """
    ok = F.coalesce("ok", F.lit(False))
    said = reports.groupBy("alert_id").agg(F.max(F.when(ok, blank_to_null(F.col("thread_id")))).alias("__thread"), F.bool_or(ok).alias("__ok"))
    rows = (
        pending.join(said, "alert_id", "left")
        .withColumn("thread_key", thread_key(F.col("series_ticker"), F.col("market_id")))
        .withColumn("answered_ok", F.when(F.col("answered_ok") | F.col("__ok"), True).otherwise(F.coalesce("__ok", "answered_ok")))
        .withColumn("answered_thread", F.coalesce("answered_thread", "__thread"))
    )
    starters = rows.filter(F.col("is_starter") & F.col("handed_batch").isNotNull()).select(
        *_GROUP, F.col("answered_ok").alias("__start"), F.col("answered_thread").alias("__opened")
    )
    joined = salted_join(rows, starters, _GROUP, "left")
    started = F.when(F.col("is_starter"), F.col("answered_ok")).otherwise(F.coalesce("group_started", "__start"))
    own = F.when(F.col("is_starter"), F.col("answered_thread")).otherwise(F.col("__opened"))
    before = F.coalesce("group_started", F.lit(False))
    failed = F.col("handed_batch").isNotNull() & (~F.col("__started") | (F.col("__started") & ~F.col("answered_ok")))
    judged = (
        joined.withColumn("__started", started)
        .withColumn("sent", F.coalesce(F.col("__started") & F.col("answered_ok"), F.lit(False)))
        .withColumn("started_now", F.coalesce(F.col("__started") & ~before, F.lit(False)))
        .withColumn("group_thread", F.when(F.col("__started"), F.coalesce("group_thread", "reused_thread", own)))
        .withColumn("group_started", F.col("__started"))
        .withColumn("__failed", F.coalesce(failed, F.lit(False)))
    )
    for name in ("handed_batch", "handed_at", "answered_ok", "answered_thread"):
        judged = judged.withColumn(name, F.when(~F.col("__failed") | F.col("sent"), F.col(name)))
    return judged.select(*schemas.PENDING.names, "thread_key", "sent", "started_now")


def still_open(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("sent")).select(*schemas.PENDING.names)


def told_threads(rows: DataFrame, as_of: datetime) -> DataFrame:
    """The threads that the sent alerts are in, with what a later command or cycle wants to know of them."""
    return rows.filter(F.col("sent") & F.col("group_thread").isNotNull()).select(
        F.col("group_thread").alias("discord_thread_id"), "alert_id", "source", "series_ticker", "market_id", "title", "detected_at",
        F.lit(instant(as_of)).alias("notified_at"),
    )


def recent_after(recent: DataFrame, told: DataFrame, as_of: datetime, kept: timedelta = timedelta(days=1)) -> DataFrame:
    """The threads of the last `kept`, in which a cycle may go on; older ones are of no use to it."""
    both = recent.unionByName(told.select(*schemas.RECENT_THREADS.names))
    return both.filter(F.col("notified_at") > instant(as_of - kept)).groupBy("source", "series_ticker", "discord_thread_id").agg(
        F.max("notified_at").alias("notified_at")
    )
