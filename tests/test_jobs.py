"""All jobs in turn on one small warehouse."""

import json
from datetime import datetime, timedelta, timezone

from tradewatch import jobs, schemas
from tradewatch.plans.cells import cells_between
from tradewatch.sources.tables import append_debates

NOW = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


def land(root, path, body, at=None):
    name, _, rest = path.partition("/")
    run = f"{name}/run={int((at or NOW - timedelta(days=1)).timestamp() * 1_000_000)}/{rest}" if rest else path
    file = root / "landed" / run
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(body if isinstance(body, str) else json.dumps(body))


def ms(minutes_ago):
    return int((NOW - timedelta(minutes=minutes_ago)).timestamp() * 1000)


def trade_a(market, number, minutes_ago, size):
    msg = {"ts_ms": ms(minutes_ago), "market_ticker": market, "trade_id": f"{market}-{number}", "yes_price_dollars": "0.50",
           "count_fp": str(size), "taker_side": "yes"}
    return json.dumps({"type": "trade", "msg": msg})


def trade_b(token, number, minutes_ago, size):
    return json.dumps({"event_type": "last_trade_price", "asset_id": token, "timestamp": str(ms(minutes_ago)), "price": "0.4",
                       "size": str(size), "transaction_hash": f"{token}-{number}"})


def test_one_day(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    land(tmp_path, "intent.json", {
        "venue_a": {"categories": ["Politics"], "tickers": ["MANUAL"]}, "venue_b": {"tag_slug": ["politics", "world"]},
        "debater": {"enabled": True}})
    land(tmp_path, "series/category=Politics/page=1/p.json", {"series": [
        {"ticker": "S1", "title": "Series one", "volume_fp": "5"}, {"ticker": "S2", "title": "Unused", "volume_fp": "0"}]})
    land(tmp_path, "series/category=Sports/page=1/p.json", {"series": [{"ticker": "S3", "volume_fp": "5"}]})
    for s in ("S1", "S2", "S3"):
        land(tmp_path, f"markets/series_ticker={s}/page=1/p.json", {"markets": [
            {"ticker": f"{s}-M1", "title": f"{s} first", "status": "active", "volume_fp": 20},
            {"ticker": f"{s}-M2", "title": f"{s} second", "status": "settled", "settlement_ts": "2024-05-01T00:00:00Z"}]})
    market = {"id": "77", "slug": "will-it-rain", "clobTokenIds": '["y77","n77"]', "closed": False, "acceptingOrders": True}
    land(tmp_path, "events/tag=politics/page=1/p.json", {"events": [{"id": 1, "ticker": "E1", "title": "Rain", "markets": [market]}]})
    land(tmp_path, "events/tag=world/page=1/p.json", {"events": [{"id": 2, "ticker": "E2", "title": "Other", "markets": [market]}]})

    jobs.refresh_a(w, NOW - timedelta(hours=11))
    jobs.refresh_b(w, NOW - timedelta(hours=9))
    assert sorted(r["ticker"] for r in w.markets_a().collect()) == ["S1-M1", "S1-M2"]
    assert sorted(r["ticker"] for r in w.series().collect()) == ["S1", "S2"]
    assert sorted((r["source"], r["market_id"]) for r in w.subscriptions().collect()) == [
        ("venue_a", "MANUAL"), ("venue_a", "S1-M1"), ("venue_b", "77")]

    second = NOW - timedelta(hours=2)
    land(tmp_path, "series/category=Politics/page=1/p.json", {"series": [{"ticker": "S1", "title": "Series one", "volume_fp": "5"}]}, second)
    land(tmp_path, "markets/series_ticker=S1/page=1/p.json", {"markets": [
        {"ticker": "S1-M1", "title": "renamed", "status": "active", "volume_fp": 30},
        {"ticker": "S1-M2", "title": "too late", "status": "settled"}]}, second)
    for _attempt in range(2):
        jobs.refresh_a(w, NOW - timedelta(hours=1))
    assert {r["ticker"]: r["title"] for r in w.markets_a().collect()} == {"S1-M1": "renamed", "S1-M2": "S1 second"}

    past = [trade_a("S1-M1", i, 60 + i, 100 + i % 3) for i in range(40)]
    land(tmp_path, "frames_a/1.txt", "\n".join([*past, trade_a("S1-M1", "big", 5, 9000), "garbage"]))
    past = [trade_b("y77", i, 60 + i, 100 + i % 3) for i in range(40)]
    land(tmp_path, "frames_b/1.txt", "\n".join([*past, trade_b("n77", "big", 4, 9000.5), "PONG"]))
    for _attempt in range(2):
        jobs.ingest(w, NOW)
    assert w.trades().count() == 82
    jobs.ingest(w, NOW + timedelta(minutes=1))
    assert w.trades().count() == 82

    # the cells beside the trades tell the same baseline, before and after they are merged
    counts = [sum(r["n"] for r in cells_between(spark, w.path("trades"), NOW - timedelta(days=7), NOW).collect())]
    for k in range(2):
        jobs.compact(w, NOW + timedelta(minutes=2 + k))
        counts.append(sum(r["n"] for r in cells_between(spark, w.path("trades"), NOW - timedelta(days=7), NOW).collect()))
    assert counts == [82, 82, 82]

    for _attempt in range(2):
        jobs.pack_batches(w, NOW + timedelta(minutes=5))
    assert w.trades().count() == 82

    for _attempt in range(2):
        jobs.detect(w, NOW)
    jobs.detect(w, NOW + timedelta(minutes=15))
    alerts = {r["market_id"]: r for r in w.alerts().collect()}
    jobs.pack_batches(w, NOW + timedelta(minutes=16))
    assert w.alerts().count() == 2
    assert (alerts["S1-M1"]["title"], alerts["S1-M1"]["series_title"], alerts["S1-M1"]["volume"]) == ("renamed", "Series one", 3000.0)
    assert (alerts["77"]["title"], alerts["77"]["series_title"], alerts["77"]["side"]) == ("Will It Rain?", "Rain", "no")

    for _attempt in range(2):
        jobs.notify(w, NOW + timedelta(minutes=20))
    queue = spark.read.parquet(w.path("outgoing")).collect()
    land(tmp_path, "deliveries/1.json", "\n".join(
        json.dumps({"alert_id": r["alert_id"], "thread_id": f"t-{r['market_id']}", "ok": True}) for r in queue), NOW + timedelta(minutes=21))
    assert len(queue) == 2
    for _attempt in range(2):
        jobs.deliver(w, NOW + timedelta(minutes=22))
    jobs.deliver(w, NOW + timedelta(minutes=27))
    assert spark.read.parquet(w.path("requests")).count() == 2
    assert {r["discord_thread_id"] for r in w.alerts().collect()} == {"t-77", "t-S1-M1"}
    assert w.alerts().filter("notified_at IS NULL").count() == 0

    done = schemas.conform(spark.createDataFrame(
        [("d1", "a0", "venue_a", "S1", "S1-M2", "Earlier", NOW - timedelta(hours=2), NOW - timedelta(hours=2), "consensus", "{}")],
        "debate_id string, alert_id string, source string, series_ticker string, market_id string, title string,"
        " started_at timestamp, finished_at timestamp, outcome string, verdict string"), schemas.DEBATES)
    append_debates(done, w.path("debates"))
    for _attempt in range(2):
        jobs.resolve(w, NOW + timedelta(minutes=30))
    jobs.resolve(w, NOW + timedelta(minutes=40))
    cached = w.debates().filter("outcome = 'cached'").collect()
    assert [(r["market_id"], r["source_debate_id"]) for r in cached] == [("S1-M1", "d1")]
    assert [r["market_id"] for r in spark.read.parquet(w.path("fresh_requests")).collect()] == ["77"]

    # a command asks again, and a finished debate is booked
    asked = {"command_id": "c1", "thread_id": "t-77", "question": "Will it snow?"}
    land(tmp_path, "commands/1.json", json.dumps(asked), NOW + timedelta(minutes=41))
    for _attempt in range(2):
        jobs.command(w, NOW + timedelta(minutes=42))
    jobs.resolve(w, NOW + timedelta(minutes=43))
    fresh = [r["title"] for r in spark.read.parquet(w.path("fresh_requests")).collect()]
    assert sorted(fresh) == ["Will It Rain?", "Will it snow?"]
    line = {"debate_id": "d9", "seq": 1, "turn": 1, "provider": "grok", "moderator": False, "text": "yes", "cost_usd": 0.25}
    land(tmp_path, "transcripts/1.json", json.dumps(line), NOW + timedelta(minutes=44))
    run = {"debate_id": "d9", "alert_id": "a9", "source": "venue_b", "market_id": "77", "title": "Will It Rain?",
           "started_at": "2024-06-01T12:40:00Z", "finished_at": "2024-06-01T12:50:00Z"}
    land(tmp_path, "debate_runs/1.json", json.dumps(run), NOW + timedelta(minutes=44))
    for _attempt in range(2):
        jobs.account(w, NOW + timedelta(minutes=45))
    booked = w.debates().filter("debate_id = 'd9'").collect()
    assert [(r["outcome"], r["total_cost_usd"]) for r in booked] == [("open", 0.25)]
