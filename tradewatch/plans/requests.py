"""Debate requests: validity, reuse of recent results, thread defaults and manual questions."""

from __future__ import annotations

from datetime import timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.coerce import blank_to_null, instant
from tradewatch.functions.text import cached_from_label
from tradewatch.operators.asof import newest_before
from tradewatch.operators.skew import last_per_key, salted_join


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests with all required fields non-empty."""
    kept = F.lit(True)
    for name in ("alert_id", "source", "market_id", "title"):
        kept = kept & blank_to_null(F.col(name)).isNotNull()
    return requests.filter(kept)


def reuse_lookup(
    requests: DataFrame, debates: DataFrame, within: timedelta = timedelta(hours=3), at: str = "requested_at"
) -> DataFrame:
    """Requests with `found`, the newest reusable debate of their series, or NULL.

    Reusable is a consensus on the same source and series (or market, where there is no series)
    that finished less than `within` before the request.
    """
    key = F.coalesce(blank_to_null(F.col("series_ticker")), F.col("market_id"))
    results = debates.filter(F.col("outcome") == "consensus").select(
        "source",
        key.alias("cache_key"),
        "debate_id",
        "verdict",
        "transcript_gcs_uri",
        "finished_at",
        F.col("title").alias("source_title"),
        F.col("market_id").alias("source_market_id"),
    )
    return newest_before(
        requests.withColumn("cache_key", key),
        results,
        ["source", "cache_key"],
        at,
        "finished_at",
        within,
        tie="debate_id",
    ).drop("cache_key")


def recent_debates(debates: DataFrame, requests: DataFrame, within: timedelta = timedelta(hours=3), at: str = "requested_at") -> DataFrame:
    """The debates that could answer one of the requests: finished later than `within` before the earliest one.

    A debate runs for less than a day, so on a table with days only those are opened. The bound is the small answer of
    one aggregate over the requests.
    """
    first = requests.agg(F.min(at).alias("at")).first()["at"]
    if first is None:
        return debates.limit(0)
    low = first.astimezone(timezone.utc) - within
    found = debates.filter(F.col("finished_at") > instant(low))
    if "started_date" in debates.columns:
        found = found.filter(F.col("started_date") >= F.to_date(instant(low - timedelta(days=1))))
    return found


def cached_rows(looked_up: DataFrame, at: str = "requested_at") -> DataFrame:
    """Debate rows for answered requests: outcome `cached`, no cost, pointing to the reused debate."""
    hits = looked_up.filter(F.col("found").isNotNull())
    rows = hits.select(
        surrogate_id(F.lit("cached"), F.col("alert_id"), F.col("market_id"), F.col(at)).alias("debate_id"),
        "alert_id",
        "source",
        "series_ticker",
        "market_id",
        "title",
        F.col(at).alias("started_at"),
        F.col(at).alias("finished_at"),
        F.lit("cached").alias("outcome"),
        F.col("found.verdict").alias("verdict"),
        F.lit(0).alias("turn_count"),
        F.lit(0.0).alias("total_cost_usd"),
        F.lit("{}").alias("cost_by_provider"),
        F.col("found.transcript_gcs_uri").alias("transcript_gcs_uri"),
        F.col("thread_id").alias("discord_thread_id"),
        F.col("found.debate_id").alias("source_debate_id"),
    )
    return schemas.conform(rows, schemas.DEBATES)


def cached_label(looked_up: DataFrame) -> Column:
    found = F.col("found")
    return cached_from_label(
        found["finished_at"], found["source_market_id"], found["source_title"], F.col("market_id")
    )


def fresh_runs(looked_up: DataFrame) -> DataFrame:
    """Requests nothing could be reused for."""
    return looked_up.filter(F.col("found").isNull()).drop("found")


def thread_latest_alert(alerts: DataFrame) -> DataFrame:
    """The latest alert of every thread."""
    columns = ["discord_thread_id", "alert_id", "source", "series_ticker", "market_id", "title", "detected_at"]
    return last_per_key(
        alerts.filter(F.col("discord_thread_id").isNotNull()).select(*columns),
        ["discord_thread_id"],
        [F.col("detected_at"), F.col("alert_id")],
    )


def command_requests(commands: DataFrame, alerts: DataFrame) -> DataFrame:
    """Requests from commands (command_id, thread_id, question).

    A question becomes a manual request under an id of its own, so that nothing is reused for it;
    a command without one asks about its thread's latest alert, and drops out if there is none.
    """
    question = blank_to_null(F.trim("question"))
    own_id = F.concat(F.lit("manual-"), surrogate_id(F.lit("manual"), F.col("command_id")))
    manual = commands.filter(question.isNotNull()).select(
        own_id.alias("alert_id"),
        F.lit("manual").alias("source"),
        F.lit(None).cast("string").alias("series_ticker"),
        own_id.alias("market_id"),
        question.alias("title"),
        "thread_id",
    )
    latest = thread_latest_alert(alerts).withColumnRenamed("discord_thread_id", "thread_id").drop("detected_at")
    defaults = salted_join(
        commands.filter(question.isNull() & blank_to_null(F.col("thread_id")).isNotNull()).select("thread_id"),
        latest,
        ["thread_id"],
    )
    return manual.unionByName(defaults.select(*manual.columns))


def surrogate_id(*parts: Column) -> Column:
    """A stable id: running a job again gives the same rows the same ids."""
    return F.left(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), F.lit(32))
