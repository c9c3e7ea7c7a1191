"""Raw venue frames to trades. The same functions serve batch frames and streams.

A frame table has one text column, `value`, as ``spark.read.text`` and ``spark.readStream.text`` give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch import fixed
from tradewatch.functions.coerce import blank_to_null, epoch_ms, json_items, json_object, to_double, to_long
from tradewatch.operators.once import computed_once
from tradewatch.operators.skew import last_per_key, salted_join
from tradewatch.schemas import TRADES

_FRAME_A = "type string, msg string"
_TRADE_A = (
    "ts_ms double, market_ticker string, trade_id string, yes_price_dollars string, count_fp string, taker_side string"
)
_EVENT_B = (
    "event_type string, asset_id string, `timestamp` variant, price string, size string, transaction_hash string"
)


def _complete(trades: DataFrame) -> DataFrame:
    needed = F.lit(True)
    for name in ("market_id", "trade_id", "ts", "price", "size"):
        needed = needed & F.col(name).isNotNull()
    return trades.filter(needed).select(*TRADES.fieldNames())


def messages_a(frames: DataFrame) -> DataFrame:
    """The `type` and `msg` of frames; both NULL for text that is no JSON object."""
    return computed_once(frames, frame=json_object(F.col("value"), _FRAME_A)).select(
        "value", F.col("frame").isNotNull().alias("is_object"), "frame.type", "frame.msg"
    )


def _fields_a(messages: DataFrame, source: str, ingested_at: Column) -> DataFrame:
    parsed = computed_once(messages, m=F.from_json("msg", _TRADE_A))
    fields = computed_once(
        parsed,
        ts=F.expr(epoch_ms("m.ts_ms")),
        price=F.expr(to_double("m.yes_price_dollars")),
        size=F.expr(f"CAST(try_cast({to_double('m.count_fp')} AS BIGINT) AS DOUBLE)"),
    )
    return fields.select(
        "value",
        "is_object",
        "type",
        F.lit(source).alias("source"),
        F.col("m.market_ticker").alias("market_id"),
        F.col("m.trade_id").alias("trade_id"),
        "ts",
        "price",
        "size",
        F.col("m.taker_side").alias("side"),
        F.col("msg").alias("raw"),
        ingested_at.cast("timestamp").alias("ingested_at"),
    )


def parse_frames_a(frames: DataFrame, ingested_at: Column, source: str = "venue_a") -> DataFrame:
    """Venue-A trades: YES price, size cut to whole contracts, side of the taker.

    Frames of another type, unparseable frames and trades lacking a required value drop out.
    """
    return _complete(
        _fields_a(messages_a(frames).filter(F.col("type") == fixed.TRADE_TYPE_A), source, ingested_at)
    )


def events_b(frames: DataFrame) -> DataFrame:
    """One row per event of a frame, which holds one event or an array of them: text and fields."""
    events = frames.filter(F.trim("value") != fixed.KEEPALIVE_B).select(
        "value", F.explode_outer(json_items(F.col("value"))).alias("event")
    )
    return computed_once(events, e=F.when(F.col("event").startswith("{"), F.from_json("event", _EVENT_B)))


def routing(tokens: DataFrame, order: str = "position") -> DataFrame:
    """asset_id → (market_id, side). Of several entries for one token the last one counts."""
    pairs = tokens.select(
        "market_id",
        F.col(order).alias("__order"),
        F.explode(
            F.array(
                F.struct(F.lit("yes").alias("side"), F.col("yes_token_id").alias("asset_id")),
                F.struct(F.lit("no").alias("side"), F.col("no_token_id").alias("asset_id")),
            )
        ).alias("t"),
    ).select("market_id", "t.side", "t.asset_id", "__order")
    return last_per_key(
        pairs.filter(blank_to_null(F.col("asset_id")).isNotNull()),
        ["asset_id"],
        [F.col("__order"), F.col("side") == "no"],
    ).select("asset_id", "market_id", "side")


def _fields_b(events: DataFrame, routes: DataFrame, source: str, ingested_at: Column, how: str) -> DataFrame:
    fields = computed_once(
        events,
        ts=F.expr(epoch_ms(to_long("e.timestamp"))),
        price=F.expr(to_double("e.price")),
        size=F.expr(to_double("e.size")),
    )
    parsed = fields.select(
        "value",
        "event",
        F.col("e.event_type").alias("event_type"),
        F.col("e.asset_id").alias("asset_id"),
        F.lit(source).alias("source"),
        F.col("e.transaction_hash").alias("trade_id"),
        "ts",
        "price",
        "size",
        F.col("event").alias("raw"),
        ingested_at.cast("timestamp").alias("ingested_at"),
    )
    return salted_join(parsed, routes, ["asset_id"], how)


def parse_frames_b(
    frames: DataFrame, tokens: DataFrame, ingested_at: Column, source: str = "venue_b"
) -> DataFrame:
    """Venue-B trades: market and side come from the traded token, sizes may be fractional.

    Events on tokens outside `tokens` drop out, as do other event types and incomplete trades.
    """
    trades = events_b(frames).filter(F.col("e.event_type") == fixed.TRADE_TYPE_B)
    return _complete(_fields_b(trades, routing(tokens), source, ingested_at, "inner"))


def judged_a(frames: DataFrame, ingested_at: Column, source: str = "venue_a") -> DataFrame:
    """What became of each venue-A frame, in one parse: the columns of a trade, `outcome` and the text of the `frame`."""
    fields = _fields_a(messages_a(frames), source, ingested_at)
    complete = F.lit(True)
    for name in ("market_id", "trade_id", "ts", "price", "size"):
        complete = complete & F.col(name).isNotNull()
    outcome = (
        F.when(~F.col("is_object"), "bad_json")
        .when(F.col("type") == fixed.ERROR_TYPE_A, "error")
        .when(F.coalesce(F.col("type") != fixed.TRADE_TYPE_A, F.lit(True)), "other_type")
        .when(complete, "trade")
        .otherwise("bad_trade")
    )
    return fields.select(*TRADES.fieldNames(), outcome.alias("outcome"), F.col("value").alias("frame"))


def judged_b(frames: DataFrame, tokens: DataFrame, ingested_at: Column, source: str = "venue_b") -> DataFrame:
    """What became of each venue-B event, in one parse: as `judged_a`; `frame` is the event's text, or that of the whole frame
    if it holds none. Keep-alive lines are left out."""
    events = events_b(frames).withColumn("event", F.coalesce("event", F.lit("")))
    fields = _fields_b(events, routing(tokens), source, ingested_at, "left")
    complete = F.lit(True)
    for name in ("trade_id", "ts", "price", "size"):
        complete = complete & F.col(name).isNotNull()
    kind = F.col("event_type")
    outcome = (
        F.when(F.col("event") == "", "bad_json")
        .when(~F.col("event").startswith("{"), "not_an_object")
        .when(kind.isNull() | kind.isin(*fixed.IGNORED_TYPES_B), "ignored_type")
        .when(kind != fixed.TRADE_TYPE_B, "unknown_type")
        .when(F.col("market_id").isNull(), "unknown_token")
        .when(complete, "trade")
        .otherwise("bad_trade")
    )
    text = F.when(F.col("event") == "", F.col("value")).otherwise(F.col("event"))
    return fields.select(*TRADES.fieldNames(), outcome.alias("outcome"), text.alias("frame"))


def trades_of(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("outcome") == "trade").select(*TRADES.fieldNames())


def rejects_of(judged: DataFrame) -> DataFrame:
    """The frames that are no trades, with the reason."""
    return judged.filter(F.col("outcome") != "trade").select("source", "outcome", "frame", "ingested_at")


def _outcomes(judged: DataFrame) -> DataFrame:
    return judged.groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n"))


def rejects_a(frames: DataFrame, source: str = "venue_a") -> DataFrame:
    """What became of venue-A frames: counts per outcome."""
    return _outcomes(judged_a(frames, F.lit(None), source))


def rejects_b(frames: DataFrame, tokens: DataFrame, source: str = "venue_b") -> DataFrame:
    """What became of venue-B events: counts per outcome; keep-alive lines are not counted."""
    return _outcomes(judged_b(frames, tokens, F.lit(None), source))
