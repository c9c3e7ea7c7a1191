import random
from datetime import datetime, timedelta

import pytest

from tradewatch import schemas
from tradewatch.operators.asof import newest_before
from tradewatch.plans.requests import (
    cached_label,
    cached_rows,
    command_requests,
    fresh_runs,
    reuse_lookup,
    thread_latest_alert,
    valid_requests,
)

NOW = datetime(2024, 6, 1, 12)


def debates(spark, rows):
    data = [(i, "src", s, m, t, o, NOW - timedelta(minutes=ago), '{"probability":0.4}') for i, s, m, t, o, ago in rows]
    plain = spark.createDataFrame(
        data,
        "debate_id string, source string, series_ticker string, market_id string, title string, outcome string,"
        " finished_at timestamp, verdict string",
    )
    return schemas.conform(plain, schemas.DEBATES)


def requests(spark, rows):
    data = [(f"a{n}", "src", s, m, "T", "th", NOW) for n, (s, m) in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "alert_id string, source string, series_ticker string, market_id string, title string, thread_id string,"
        " requested_at timestamp",
    )


def test_reuse_edges(spark):
    done = debates(
        spark,
        [
            ("d1", "S", "m1", "One", "consensus", 179),
            ("d2", "S", "m2", "Two", "consensus", 100),
            ("d3", "S", "m1", "One", "deadlock", 1),
            ("d4", "S", "m1", "One", "cached", 1),
            ("d5", None, "m5", "Five", "consensus", 180),
            ("d6", None, "m6", "Six", "consensus", 179.9),
            ("d7", "S", "m1", "One", "consensus", -5),
            ("d8", None, "m8", "Eight", "consensus", 0),
        ],
    )
    asked = requests(spark, [("S", "m1"), (None, "m5"), ("", "m6"), (None, "m1"), (None, "m8")])
    looked = reuse_lookup(asked, done)
    assert {r["market_id"] + str(r["series_ticker"]): r["found"] and r["found"]["debate_id"] for r in looked.collect()} == {
        "m1S": "d2", "m5None": None, "m6": "d6", "m1None": None, "m8None": "d8"}
    labels = {r[0]: r[1] for r in looked.filter("found is not null").select("market_id", cached_label(looked)).collect()}
    assert labels == {"m1": "10:20 UTC; originally debated for: _Two_", "m6": "09:00 UTC", "m8": "12:00 UTC"}
    rows = {r["market_id"]: r for r in cached_rows(looked).collect()}
    assert rows["m1"]["source_debate_id"] == "d2" and rows["m1"]["outcome"] == "cached" and rows["m1"]["turn_count"] == 0
    assert rows["m1"]["started_at"] == rows["m1"]["finished_at"] == NOW
    assert sorted(r["alert_id"] for r in fresh_runs(looked).collect()) == ["a1", "a3"]


@pytest.mark.parametrize("bucket", [1, 7, 60, 100000])
def test_newest_before_equals_brute_force(spark, bucket):
    rng = random.Random(bucket)
    start = datetime(2024, 1, 1)

    def stamp():
        return start + timedelta(seconds=rng.randrange(400))

    events = [(rng.choice("xxy"), stamp(), f"e{n:03d}") for n in range(150)]
    asks = [(rng.choice("xxyz"), stamp(), n) for n in range(150)]
    within = timedelta(seconds=40)
    expected = {}
    for key, at, n in asks:
        near = [(t, e) for k, t, e in events if k == key and at - within < t <= at]
        expected[n] = max(near)[1] if near else None
    found = newest_before(
        spark.createDataFrame(asks, "k string, at timestamp, n long"),
        spark.createDataFrame(events, "k string, t timestamp, e string"),
        ["k"], "at", "t", within, tie="e", bucket_seconds=bucket,
    )
    assert {r["n"]: r["found"] and r["found"]["e"] for r in found.collect()} == expected


def test_commands_and_validity(spark):
    alerts = schemas.conform(
        spark.createDataFrame(
            [("a1", "src", "m1", "T1", NOW, "t1"), ("a2", "src", "m2", "T2", NOW + timedelta(minutes=1), "t1"),
             ("a3", "src", "m3", "T3", NOW, None), ("a4", "src", "m4", None, NOW, "t4")],
            "alert_id string, source string, market_id string, title string, detected_at timestamp, discord_thread_id string",
        ),
        schemas.ALERTS,
    )
    assert {r["discord_thread_id"]: r["alert_id"] for r in thread_latest_alert(alerts).collect()} == {"t1": "a2", "t4": "a4"}
    commands = spark.createDataFrame(
        [(1, "t1", None), (2, "t1", "  "), (3, "t9", None), (4, None, " Why? "), (5, "t4", None), (6, "t1", "Why?")],
        "command_id long, thread_id string, question string",
    )
    made = command_requests(commands, alerts)
    rows = made.collect()
    manual = [r for r in rows if r["source"] == "manual"]
    assert sorted(r["title"] for r in manual) == ["Why?", "Why?"]
    assert len({r["market_id"] for r in manual}) == 2 and all(r["alert_id"] == r["market_id"] for r in manual)
    assert sorted(r["alert_id"] for r in rows if r["source"] != "manual") == ["a2", "a2", "a4"]
    assert sorted(r["alert_id"] for r in valid_requests(made).collect() if r["source"] != "manual") == ["a2", "a2"]
