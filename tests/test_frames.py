import json
from datetime import datetime

from pyspark.sql import functions as F

from tradewatch.sources.frames import parse_frames_a, parse_frames_b, rejects_a, rejects_b, routing

def stamp():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")



def frames(spark, lines):
    return spark.createDataFrame([(line if isinstance(line, str) else json.dumps(line),) for line in lines], "value string")


def message(**changes):
    msg = {
        "ts_ms": 1704067200123,
        "market_ticker": "M1",
        "trade_id": "t1",
        "yes_price_dollars": "0.42",
        "count_fp": "7.9",
        "taker_side": "no",
    }
    msg.update(changes)
    return {"type": "trade", "msg": {k: v for k, v in msg.items() if v is not ...}}


def test_venue_a_edges(spark):
    lines = [
        message(),
        message(trade_id="t2", yes_price_dollars=0.5, count_fp=3, taker_side=...),
        message(trade_id="t3", count_fp="-2.5", yes_price_dollars="1_0.5"),
        message(trade_id=...),
        message(trade_id="bad1", yes_price_dollars="abc"),
        message(trade_id="bad2", yes_price_dollars="1.5d"),
        message(trade_id="bad3", count_fp="nan"),
        message(trade_id="bad4", ts_ms="1704067200123"),
        {"type": "trade"},
        {"type": "error", "msg": {}},
        {"type": "subscribed"},
        [message()],
        "PONG",
        '{"type": "trade", ',
        json.dumps(message(trade_id="bad5")) + " junk",
    ]
    rows = {r["trade_id"]: r for r in parse_frames_a(frames(spark, lines), stamp(), "a").collect()}
    assert sorted(rows) == ["t1", "t2", "t3"]
    assert rows["t1"]["ts"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (rows["t1"]["price"], rows["t1"]["size"], rows["t1"]["side"]) == (0.42, 7.0, "no")
    assert (rows["t2"]["price"], rows["t2"]["size"], rows["t2"]["side"]) == (0.5, 3.0, None)
    assert (rows["t3"]["price"], rows["t3"]["size"]) == (10.5, -2.0)
    assert json.loads(rows["t1"]["raw"]) == message()["msg"]
    counts = {r["outcome"]: r["n"] for r in rejects_a(frames(spark, lines)).collect()}
    assert counts == {"trade": 3, "bad_trade": 6, "error": 1, "other_type": 1, "bad_json": 4}


def event(**changes):
    out = {
        "event_type": "last_trade_price",
        "asset_id": "y1",
        "timestamp": "1704067200123",
        "price": "0.42",
        "size": "7.25",
        "transaction_hash": "h1",
    }
    out.update(changes)
    return {k: v for k, v in out.items() if v is not ...}


def tokens(spark):
    return spark.createDataFrame(
        [("m1", "y1", "n1", 0), ("m2", "y2", "n1", 1), ("m3", "", None, 2)],
        "market_id string, yes_token_id string, no_token_id string, position int",
    )


def test_routing_last_entry_wins(spark):
    got = {r["asset_id"]: (r["market_id"], r["side"]) for r in routing(tokens(spark)).collect()}
    assert got == {"y1": ("m1", "yes"), "n1": ("m2", "no"), "y2": ("m2", "yes")}


def test_venue_b_edges(spark):
    lines = [
        event(),
        [event(asset_id="n1", timestamp=1704067200456), 5, "text", event(asset_id="y2")],
        event(asset_id="unknown"),
        event(event_type="book"),
        event(event_type=...),
        event(event_type="market_resolved"),
        event(transaction_hash=...),
        event(timestamp="soon"),
        event(timestamp="12.5"),
        event(price="inf"),
        "PONG",
        "nonsense",
        '{"event_type": "last_trade_price"}, {"event_type": "book"}',
    ]
    found = parse_frames_b(frames(spark, lines), tokens(spark), stamp(), "b").collect()
    got = sorted((r["market_id"], r["side"], r["size"]) for r in found)
    assert got == [("m1", "yes", 7.25), ("m2", "no", 7.25), ("m2", "yes", 7.25)]
    counts = {r["outcome"]: r["n"] for r in rejects_b(frames(spark, lines), tokens(spark)).collect()}
    assert counts == {
        "trade": 3,
        "unknown_token": 1,
        "ignored_type": 2,
        "unknown_type": 1,
        "bad_trade": 4,
        "not_an_object": 2,
        "bad_json": 2,
    }
