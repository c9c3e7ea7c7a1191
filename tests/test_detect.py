import math
import random
import statistics
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators.baseline import recent_trades, rolling_baseline
from tradewatch.plans.detect import DetectParams, detect_anomalies, enriched_alerts, unusual_trades

AS_OF = datetime(2024, 6, 1, 12, 0, 0)


def trades(spark, rows):
    """Rows of (market, id, minutes before AS_OF, price, size)."""
    data = [("s", m, i, AS_OF - timedelta(minutes=ago), p, z, "yes") for m, i, ago, p, z in rows]
    plain = spark.createDataFrame(
        data, "source string, market_id string, trade_id string, ts timestamp, price double, size double, side string"
    )
    return schemas.conform(plain, schemas.TRADES)


def history(market, n, size=100.0):
    return [(market, f"{market}-{i}", 60 + i, 0.5, size + (i % 5)) for i in range(n)]


def dims(spark):
    a = schemas.conform(
        spark.createDataFrame([("s", "m1", "S1", "Title", 10.0)], "source string, ticker string, series_ticker string, title string, volume_fp double"),
        schemas.MARKETS_A,
    )
    b = schemas.conform(
        spark.createDataFrame([("s", "m2", "E2", "Event", "will-it-rain", 5.0), ("s", "m1", "E1", "Other", "x", 1.0)],
                              "source string, id string, event_ticker string, event_title string, slug string, volume double"),
        schemas.MARKETS_B,
    )
    series = schemas.conform(
        spark.createDataFrame([("s", "S1", "Series one")], "source string, ticker string, title string"), schemas.SERIES
    )
    return a, b, series


def test_window_bounds_and_nulls(spark):
    rows = [("m", "edge", 30, 0.5, 1.0), ("m", "in", 29.99, 0.5, 1.0), ("m", "now", 0, 0.5, 1.0), ("m", "future", -1, 0.5, 1.0),
            ("m", "no price", 5, None, 1.0), ("m", "no size", 5, 0.5, None)]
    assert sorted(r["trade_id"] for r in recent_trades(trades(spark, rows), AS_OF).collect()) == ["in", "now"]


def test_baseline_minimum(spark):
    rows = history("nine", 9) + history("ten", 10) + [("ten", "old", 60 * 24 * 8, 0.5, 1e6)]
    found = {r["market_id"]: r for r in rolling_baseline(trades(spark, rows), AS_OF).collect()}
    assert list(found) == ["ten"]
    sizes = [100.0 + i % 5 for i in range(10)]
    assert math.isclose(found["ten"]["average_size"], statistics.mean(sizes))
    assert math.isclose(found["ten"]["stddev_size"], statistics.stdev(sizes))


def test_thresholds(spark):
    def flagged(*recent, n=40):
        return sorted(r["trade_id"] for r in unusual_trades(trades(spark, history("m1", n) + list(recent)), AS_OF).collect())

    assert flagged(("m1", "big", 5, 0.5, 9000.0)) == ["big"]
    assert flagged(("m1", "price at cap", 5, 0.90, 9000.0)) == []
    assert flagged(("m1", "below cap", 5, 0.8999, 9000.0)) == ["below cap"]
    assert flagged(("m1", "notional at floor", 5, 0.5, 2000.0)) == []
    assert flagged(("m1", "too old", 31, 0.5, 9000.0)) == []
    # The trade counts in its own baseline: of 10 trades none can lie 3 deviations away.
    assert flagged(("m1", "tenth", 5, 0.5, 9000.0), n=9) == []
    assert flagged(("m1", "eleventh", 5, 0.5, 9000.0), n=10) == ["eleventh"]


def test_flat_market_never_alerts(spark):
    rows = [("m1", str(i), i, 0.5, 5000.0) for i in range(30)]
    assert unusual_trades(trades(spark, rows), AS_OF).count() == 0


def test_small_trades_can_stand_out_downwards(spark):
    rows = history("m1", 60, size=50000.0) + [("m1", "tiny", 1, 0.5, 2100.0)]
    found = unusual_trades(trades(spark, rows), AS_OF).collect()
    assert [r["trade_id"] for r in found] == ["tiny"] and found[0]["size_zscore"] < -3


def test_enrichment_prefers_venue_a(spark):
    big = [("m1", "b1", 5, 0.5, 9000.0), ("m2", "b2", 5, 0.5, 9000.0), ("m3", "b3", 5, 0.5, 9000.0)]
    rows = history("m1", 40) + history("m2", 40) + history("m3", 40) + big
    found = {r["market_id"]: r for r in enriched_alerts(trades(spark, rows), *dims(spark), AS_OF).collect()}
    assert (found["m1"]["title"], found["m1"]["series_title"], found["m1"]["volume"]) == ("Title", "Series one", 1000.0)
    assert (found["m2"]["title"], found["m2"]["series_ticker"], found["m2"]["volume"]) == ("Will It Rain?", "E2", 5.0)
    assert found["m3"]["title"] is None and "market vol=$0 (24h $0)" in found["m3"]["reason"]
    assert found["m1"].asDict().keys() == set(schemas.ALERTS.fieldNames())
    assert found["m1"]["trade_ts"] == datetime(2024, 6, 1, 5, 55)


def test_second_run_adds_nothing_and_ids_repeat_once(spark):
    rows = history("m1", 40) + [("m1", "dup", 5, 0.5, 9000.0), ("m1", "dup", 4, 0.5, 9500.0)]
    source, tables = trades(spark, rows), dims(spark)
    none = spark.createDataFrame([], schemas.ALERTS)
    first = detect_anomalies(source, *tables, none, AS_OF)
    assert [(r["trade_id"], r["size"]) for r in first.collect()] == [("dup", 9000.0)]
    faithful = detect_anomalies(source, *tables, none, AS_OF, DetectParams(dedup="none"))
    assert faithful.count() == 2
    later = AS_OF + timedelta(minutes=15)
    assert detect_anomalies(source, *tables, first, later, known_since=timedelta(minutes=46)).count() == 0
    assert detect_anomalies(source, *tables, first, later).count() == 0


def test_hot_market_matches_plain_join(spark):
    """A market with most of the rows, with broadcasting off: same alerts as computed by hand."""
    rng = random.Random(5)
    rows = [("hot", f"h{i}", rng.uniform(0, 29), 0.5, rng.choice([10.0, 11.0, 12.0])) for i in range(2000)]
    rows += [(f"c{i % 30}", f"c{i}", rng.uniform(0, 29), 0.5, rng.choice([10.0, 11.0, 12.0])) for i in range(900)]
    rows += [(m, f"big-{m}", 1, 0.5, 9000.0) for m in ("hot", "c1", "c2")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = unusual_trades(trades(spark, rows), AS_OF)
        assert sorted(r["trade_id"] for r in found.collect()) == ["big-c1", "big-c2", "big-hot"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_table_prunes_days(spark, tmp_path):
    from tradewatch.sources.tables import append_trades

    append_trades(trades(spark, history("m1", 40) + [("m1", "old", 60 * 24 * 30, 0.5, 1.0)]), str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = recent_trades(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan
    assert "GreaterThan(ts" in plan
    assert unusual_trades(stored, AS_OF).count() == 0
