"""Newest earlier event per key: an as-of join without pairing requests and events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewatch.operators.skew import last_per_key, salted_join


def newest_before(
    requests: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    at: str,
    event_at: str,
    within: timedelta,
    tie: str,
    bucket_seconds: int = 60,
) -> DataFrame:
    """For each request the newest event of its key with ``at - within < event_at <= at``.

    Adds `found`, a struct of the event's columns, NULL where there is none. Requests and events
    are first reduced to distinct moments per key, so copies cost nothing. Only moments go through windows;
    the event of the moment that was found is joined afterwards. Time is cut into buckets and those into spans: inside a
    bucket the newest earlier moment comes from a window over that bucket, from before it out of a window over
    the buckets of its span, from before that out of a window over spans. A busy key is thus spread over its buckets, no
    task holds more than the moments of one bucket or `within` divided by a bucket, and no pairs are formed.
    """
    keys = list(on)
    width = bucket_seconds * 1_000_000
    reach = within // timedelta(microseconds=1)
    per_span = max(2, int((reach / width) ** 0.5))

    moments = requests.select(*keys, F.unix_micros(at).alias("__at")).distinct()
    newest = last_per_key(
        events.withColumn("__at", F.unix_micros(event_at)).filter(F.col("__at").isNotNull()), [*keys, "__at"], [F.col(tie)]
    )
    line = (
        newest.select(*keys, "__at", F.lit(False).alias("__asks"))
        .unionByName(moments.withColumn("__asks", F.lit(True)))
        .withColumn("__bucket", F.floor(F.col("__at") / F.lit(width)).cast("bigint"))
        .withColumn("__span", F.floor(F.col("__bucket") / F.lit(per_span)).cast("bigint"))
    )
    event_at_moment = F.when(~F.col("__asks"), F.col("__at"))

    def before(rows: DataFrame, level: list[str], order: str, name: str) -> DataFrame:
        """The newest moment of the cells that come earlier in the same cell of the level above."""
        earlier = W.partitionBy(*keys, *level).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return rows.select(*keys, *level, order, F.max("__newest").over(earlier).alias(name))

    buckets = line.groupBy(*keys, "__span", "__bucket").agg(F.max(event_at_moment).alias("__newest"))
    spans = buckets.groupBy(*keys, "__span").agg(F.max("__newest").alias("__newest"))
    # At one moment events sort before requests: an event at the very time of the request counts.
    inside = W.partitionBy(*keys, "__span", "__bucket").orderBy("__at", "__asks").rowsBetween(W.unboundedPreceding, 0)
    asked = (
        line.withColumn("__inside", F.max(event_at_moment).over(inside))
        .filter(F.col("__asks"))
        .join(before(buckets, ["__span"], "__bucket", "__in_span"), [*keys, "__span", "__bucket"], "left")
        .join(before(spans, [], "__span", "__in_past"), [*keys, "__span"], "left")
        .select(*keys, F.col("__at").alias("__asked"), F.coalesce("__inside", "__in_span", "__in_past").alias("__at"))
        .filter(F.col("__at") > F.col("__asked") - F.lit(reach))
    )
    found = newest.select(*keys, "__at", F.struct(*events.columns).alias("found"))
    answers = asked.join(found, [*keys, "__at"]).select(*keys, F.col("__asked").alias("__at"), "found")
    return salted_join(requests.withColumn("__at", F.unix_micros(at)), answers, [*keys, "__at"], "left").drop("__at")
