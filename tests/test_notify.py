from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.plans.notify import (
    debate_requests,
    mark_notified,
    notifications,
    pending_queue,
    recent_threads,
    sent_state,
    settle_deliveries,
    thread_buckets,
    with_state,
)
from tradewatch.sources.tables import STATE, append_alerts, append_state, outbox, read_table

NOW = datetime(2024, 6, 1, 12)


def alerts(spark, rows):
    """(id, series, series_title, title, market, minutes ago, notified minutes ago, thread)"""
    data = [
        (i, s, st, "src", t, m, i, NOW, 0.5, 10.0, 5.0, "why", NOW - timedelta(minutes=ago),
         None if told is None else NOW - timedelta(minutes=told), th)
        for i, s, st, t, m, ago, told, th in rows
    ]
    plain = spark.createDataFrame(
        data,
        "alert_id string, series_ticker string, series_title string, source string, title string, market_id string,"
        " trade_id string, trade_ts timestamp_ntz, price double, size double, notional double, reason string,"
        " detected_at timestamp, notified_at timestamp, discord_thread_id string",
    )
    return schemas.conform(plain, schemas.ALERTS)


ROWS = [
    ("a1", "S1", "Beta", "x", "m1", 5, None, None),
    ("a2", "S1", "Beta", "y", "m2", 9, None, None),
    ("a3", "", None, None, "m3", 1, None, None),
    ("a4", None, None, "Alpha", "m4", 3, None, None),
    ("a5", None, None, "Alpha", "m4", 3, None, None),
    ("a6", "S6", "Gamma", "z", "m6", 2, None, None),
    ("a7", "S6", "Gamma", "z", "m6", 90, 30, "t-new"),
    ("a8", "S6", "Gamma", "z", "m6", 90, 50, "t-old"),
    ("a9", "S1", "Beta", "z", "m1", 90, 61, "t-expired"),
    ("b1", "S7", "Eta", "z", "m7", 90, 10, None),
]


def test_queue_order_and_groups(spark):
    rows = pending_queue(alerts(spark, ROWS)).orderBy("queue_pos").collect()
    assert [(r["alert_id"], r["group_pos"], r["is_starter"]) for r in rows] == [
        ("a3", 1, True), ("a4", 2, True), ("a5", 2, False), ("a2", 4, True), ("a1", 4, False), ("a6", 6, True)]
    assert rows[0]["thread_key"] == "m3"
    assert [r["page"] for r in pending_queue(alerts(spark, ROWS), 2).orderBy("queue_pos").collect()] == [1, 1, 2, 2, 3, 3]


def test_recent_thread_is_latest_within_hour(spark):
    found = recent_threads(alerts(spark, ROWS), NOW).collect()
    assert [(r["series_ticker"], r["thread_id"]) for r in found] == [("S6", "t-new")]


@pytest.fixture
def settled(spark):
    queue = notifications(alerts(spark, ROWS), NOW)
    reports = spark.createDataFrame(
        [("a3", None, True), ("a4", "t4", False), ("a5", "t4", True), ("a2", "t2", True), ("a6", "t-new", True)],
        "alert_id string, thread_id string, ok boolean",
    )
    return settle_deliveries(queue, reports)


def test_messages_and_titles(spark):
    rows = {r["alert_id"]: r for r in notifications(alerts(spark, ROWS), NOW).collect()}
    assert rows["a6"]["thread_id"] == "t-new" and rows["a6"]["thread_title"] is None
    assert (rows["a2"]["thread_title"], rows["a1"]["thread_title"]) == ("Beta", None)
    assert rows["a3"]["thread_title"] == "src: m3" and rows["a4"]["thread_title"] == "Alpha"
    assert rows["a4"]["message"] == (
        "Unusual trade on m4 (src)\n**_Alpha_\n**Side: ?  Size: 10.0  Price: $0.500  Notional: $5.00\n"
        "Trigger: why\nTrade time: 2024-06-01T12:00:00"
    )


def test_deliveries(spark, settled):
    got = {r["alert_id"]: (r["sent"], r["group_thread"]) for r in settled.collect()}
    # a4's failed start takes a5 with it; a1 was never delivered; a3 opened no thread.
    assert got == {
        "a3": (True, None), "a4": (False, None), "a5": (False, None), "a2": (True, "t2"), "a1": (False, "t2"), "a6": (True, "t-new")}
    marked = {r["alert_id"]: r for r in mark_notified(alerts(spark, ROWS), settled, NOW).collect()}
    assert {k for k, r in marked.items() if r["notified_at"] == NOW} == {"a3", "a2", "a6"}
    assert marked["a2"]["discord_thread_id"] == "t2" and marked["a7"]["discord_thread_id"] == "t-new"
    assert marked["a9"]["notified_at"] == NOW - timedelta(minutes=61)
    assert {r["thread_id"]: r["alert_ids"] for r in thread_buckets(settled).collect()} == {
        None: ["a3"], "t2": ["a2"], "t-new": ["a6"]}


def test_requests_once_per_market(spark, settled):
    found = debate_requests(settled)
    assert sorted((r["alert_id"], r["market_id"], r["thread_id"]) for r in found.collect()) == [
        ("a1", "m1", "t2"), ("a2", "m2", "t2"), ("a6", "m6", "t-new")]
    assert debate_requests(settled, enabled=False).count() == 0
    assert debate_requests(settled, auto_publish=False).count() == 0
    sent = {r["key"]: r["value"] for r in outbox(found, "alert_id").collect()}
    assert sent["a6"] == '{"alert_id":"a6","source":"src","series_ticker":"S6","market_id":"m6","title":"z","thread_id":"t-new"}'


def test_state_is_kept_apart_from_alerts(spark, tmp_path):
    path, state = str(tmp_path / "alerts"), str(tmp_path / "state")
    append_alerts(alerts(spark, ROWS), path)
    stored = read_table(spark, path, schemas.ALERTS)
    queue = notifications(stored, NOW)
    reports = [(r["alert_id"], "t", True) for r in queue.collect()]
    # repeated, contradictory and unknown reports
    reports += [(reports[0][0], "t", True), (reports[0][0], None, False), ("nobody", "t", True)]
    settled = settle_deliveries(queue, spark.createDataFrame(reports, "alert_id string, thread_id string, ok boolean"))
    # detection adds an alert between reading and writing
    append_alerts(alerts(spark, [("late", None, None, "w", "m", 1, None, None)]), path)
    for _attempt in range(2):
        append_state(sent_state(settled, NOW), state, "c1")
    later = sent_state(settled.limit(1), NOW + timedelta(hours=1))
    append_state(later, state, "c2")
    after = with_state(read_table(spark, path, schemas.ALERTS), read_table(spark, state, STATE)).collect()
    assert len(after) == len(ROWS) + 1
    assert [r["alert_id"] for r in after if r["notified_at"] is None] == ["late"]
    assert sum(r["notified_at"] == NOW + timedelta(hours=1) for r in after) == 1


def test_more_alerts_than_a_page_all_wait_their_turn(spark):
    many = [(f"x{k:03}", None, None, "src", f"title {k % 7}", f"m{k}", k, None, None) for k in range(130)]
    many = [(i, s, st, t, m, ago, told, th) for i, s, st, _, t, m, ago, told, th in many]
    rows = pending_queue(alerts(spark, many), 50).collect()
    assert sorted(r["queue_pos"] for r in rows) == list(range(1, 131))
    assert {p: sum(r["page"] == p for r in rows) for p in (1, 2, 3)} == {1: 50, 2: 50, 3: 30}
