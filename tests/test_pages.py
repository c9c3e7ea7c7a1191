import json

from pyspark.sql import functions as F

from tradewatch.plans.catalog import discover_markets, traded_series
from tradewatch.sources.config import read_intent, valid_subscriptions
from tradewatch.sources.pages import normalise_markets_a, normalise_markets_b, normalise_series, read_pages
from tradewatch.operators.subscribe import tradable_markets


def items(spark, payloads, **columns):
    rows = spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")
    for name, value in columns.items():
        rows = rows.withColumn(name, F.lit(value))
    return rows


def test_market_a_coercions(spark):
    payloads = [
        {"ticker": "A", "title": 5, "created_time": "2024-01-01T10:00:00Z", "fee_waiver_expiration_time": "",
         "settlement_timer_seconds": 3.7, "is_provisional": True, "volume_fp": "12.5", "tick_size": 1,
         "price_ranges": [{"a": 1}], "custom_strike": "text", "status": "active"},
        {"ticker": "B", "created_time": "2024-13-01T10:00:00Z", "settlement_timer_seconds": "12",
         "is_provisional": "true", "volume_fp": "abc", "price_ranges": None},
        {"ticker": "C", "created_time": 17, "settlement_timer_seconds": "3.0", "is_provisional": 1, "volume_fp": "1e999"},
        {"ticker": "D", "created_time": "2024-01-01T10:00:00+02:00", "volume_fp": " 7. ", "tick_size": "nan"},
    ]
    rows = {r["ticker"]: r for r in normalise_markets_a(items(spark, payloads, series_ticker="S", category="C")).collect()}
    assert rows["A"]["title"] == "5" and rows["A"]["created_time"].hour == 10
    assert rows["A"]["fee_waiver_expiration_time"] is None
    assert [rows[k]["settlement_timer_seconds"] for k in "ABCD"] == [3, 12, None, None]
    assert [rows[k]["is_provisional"] for k in "ABC"] == [True, None, None]
    assert [rows[k]["volume_fp"] for k in "ABCD"] == [12.5, None, None, 7.0]
    assert (rows["A"]["tick_size"], rows["D"]["tick_size"]) == (1.0, None)
    assert json.loads(rows["A"]["price_ranges"]) == [{"a": 1}] and rows["A"]["custom_strike"] == "text"
    assert rows["B"]["created_time"] is None and rows["C"]["created_time"] is None
    assert rows["D"]["created_time"].hour == 8
    assert len(rows["A"]) == 58


def test_series_category_falls_back(spark):
    payloads = [
        {"ticker": "A", "category": "own", "volume_fp": "12.5", "tags": ["x"]},
        {"ticker": "B", "category": "", "volume_fp": "0"},
        {"ticker": "C", "volume_fp": ""},
        {"ticker": "D", "volume_fp": "abc"},
        {"ticker": "E"},
        {"ticker": "F", "volume_fp": 3},
    ]
    source = items(spark, payloads, category="asked")
    rows = {r["ticker"]: r for r in normalise_series(source).collect()}
    assert (rows["A"]["category"], rows["B"]["category"], rows["C"]["category"]) == ("own", "asked", "asked")
    assert rows["A"]["tags"] == '["x"]'
    assert sorted(r["series_ticker"] for r in traded_series(source).collect()) == ["A", "F"]


def test_market_b_outcomes(spark):
    payloads = [
        {"id": 1, "outcomes": '["Yes","No"]', "outcomePrices": '["0.4","x"]', "clobTokenIds": '["11","12"]',
         "closed": False, "acceptingOrders": True, "orderMinSize": 5},
        {"id": "2", "outcomePrices": "[]", "clobTokenIds": '["21"]', "acceptingOrders": True},
        {"id": "3", "outcomePrices": ["0.4"], "clobTokenIds": "broken", "acceptingOrders": None, "closed": True},
        {"id": "4", "clobTokenIds": f"[{10**40}, null]", "acceptingOrders": True},
    ]
    event = {"id": 9, "tags": [{"slug": "a"}, {"slug": ""}, {}, 7, "x", {"slug": "b"}], "title": "E"}
    staged = normalise_markets_b(items(spark, payloads, event=json.dumps(event)))
    rows = {r["id"]: r for r in staged.collect()}
    assert (rows["1"]["yes_token_id"], rows["1"]["no_token_id"]) == ("11", "12")
    assert (rows["1"]["yes_price"], rows["1"]["no_price"], rows["1"]["order_min_size"]) == (0.4, None, 5)
    assert (rows["2"]["yes_token_id"], rows["2"]["no_token_id"], rows["2"]["yes_price"]) == ("21", None, None)
    assert (rows["3"]["outcome_prices_raw"], rows["3"]["clob_token_ids_raw"]) == (None, "broken")
    assert (rows["4"]["yes_token_id"], rows["4"]["no_token_id"]) == (str(10**40), None)
    assert json.loads(rows["1"]["event_tag_slugs"]) == ["a", "b"] and rows["1"]["event_id"] == "9"
    assert [r["market_id"] for r in tradable_markets(staged).collect()] == ["1"]
    assert len(rows["1"]) == 70


def test_first_discovery_wins(spark):
    pages = [
        (1, 0, 0, {"markets": [{"id": "x", "n": 1}, {"id": ""}, {"n": 2}]}),
        (0, 1, 0, {"markets": [{"id": "y", "n": 3}]}),
        (0, 0, 5, {"markets": [{"id": "z", "n": 4}, {"id": "x", "n": 5}]}),
        (0, 0, 6, {"markets": None}),
        (0, 0, 7, {}),
    ]
    source = spark.createDataFrame(
        [(a, b, c, json.dumps(p)) for a, b, c, p in pages], "tag_position int, page int, position int, payload string"
    )
    order = ["tag_position", "page", "position"]
    found = discover_markets(source, order)
    assert {r["id"]: json.loads(r["payload"])["n"] for r in found.collect()} == {"x": 5, "y": 3, "z": 4}



def test_pages_and_intent(spark, tmp_path):
    for category, page, body in [("a", 1, {"series": [{"ticker": "t1"}, {"ticker": "t2"}]}), ("b", 1, {"series": None}), ("b", 2, {})]:
        folder = tmp_path / "pages" / f"category={category}" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "p.json").write_text(json.dumps(body, indent=1))
    found = read_pages(spark, str(tmp_path / "pages"), "series", "category string, page int")
    assert sorted((r["category"], r["page"], r["position"], json.loads(r["payload"])["ticker"]) for r in found.collect()) == [
        ("a", 1, 0, "t1"), ("a", 1, 1, "t2")]
    (tmp_path / "intent.json").write_text(json.dumps({"venue_a": {"categories": ["Politics"]}, "debater": {"enabled": True}}))
    intent = read_intent(spark, str(tmp_path / "intent.json"))
    assert intent.categories == ("Politics",) and intent.debates_enabled and intent.debates_auto_publish


def test_valid_subscriptions(spark):
    payloads = [
        {"market_id": 1, "yes_token_id": "y", "no_token_id": "n"},
        {"market_id": "2", "yes_token_id": "", "no_token_id": "n"},
        {"market_id": "3", "yes_token_id": "y"},
        ["x"],
        7,
    ]
    assert [r["market_id"] for r in valid_subscriptions(items(spark, payloads)).collect()] == ["1"]
