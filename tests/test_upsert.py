from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewatch.operators.subscribe import delta_counts, open_tickers, subscription_delta
from tradewatch.operators.upsert import CLOSED, SETTLED, upsert
from tradewatch.sources.buckets import read_buckets, upsert_buckets

AS_OF = datetime(2024, 6, 1)
OLD = datetime(2024, 1, 1)


def markets(spark, rows):
    """(ticker, title, settled, closed) with the old stamp."""
    data = [("s", k, t, OLD if settled else None, closed, OLD) for k, t, settled, closed in rows]
    return spark.createDataFrame(
        data, "source string, ticker string, title string, settlement_ts timestamp, closed boolean, resolved_at timestamp"
    )


def run(target, staged, freeze, **more):
    out = upsert(target, staged.drop("resolved_at"), ["source", "ticker"], AS_OF, freeze, **more)
    return {r["ticker"]: (r["title"], r["resolved_at"]) for r in out.collect()}


def test_frozen_updated_inserted_kept(spark):
    target = markets(spark, [("frozen", "old", True, None), ("live", "old", False, None), ("gone", "old", False, None)])
    staged = markets(spark, [("frozen", "new", False, None), ("live", "new", True, None), ("added", "new", True, None)])
    assert run(target, staged, SETTLED) == {
        "frozen": ("old", OLD),
        "live": ("new", AS_OF),
        "gone": ("old", OLD),
        "added": ("new", AS_OF),
    }


def test_only_true_freezes(spark):
    target = markets(spark, [("t", "old", False, True), ("f", "old", False, False), ("n", "old", False, None)])
    staged = markets(spark, [(k, "new", False, True) for k in "tfn"])
    assert run(target, staged, CLOSED) == {"t": ("old", OLD), "f": ("new", AS_OF), "n": ("new", AS_OF)}


def test_repeating_changes_nothing(spark):
    target = markets(spark, [("a", "old", True, None), ("b", "old", False, None)])
    staged = markets(spark, [("b", "new", True, None), ("c", "new", False, None)])
    once = upsert(target, staged.drop("resolved_at"), ["source", "ticker"], AS_OF, SETTLED)
    twice = upsert(once, staged.drop("resolved_at"), ["source", "ticker"], AS_OF, SETTLED)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_clashing_staged_rows(spark):
    target = markets(spark, [("a", "old", False, None)])
    staged = markets(spark, [("a", "one", False, None), ("a", "two", False, None)])
    with pytest.raises(Exception, match="more than one staged row"):
        run(target, staged, SETTLED)
    assert run(target, staged, SETTLED, dedup_order=[F.col("title")])["a"][0] == "one"


def test_open_tickers_and_delta(spark):
    found = spark.createDataFrame([("b", "active"), ("a", "active"), ("a", "active"), ("c", "settled")], "ticker string, status string")
    manual = spark.createDataFrame([("z",), ("a",)], "ticker string")
    assert [r["ticker"] for r in open_tickers(found, manual).collect()] == ["a", "b", "z"]
    now = spark.createDataFrame([("a",), ("b",), ("b",)], "market_id string")
    desired = spark.createDataFrame([("b",), ("c",)], "market_id string")
    delta = subscription_delta(now, desired)
    assert {r["market_id"]: r["change"] for r in delta.collect()} == {"a": "removed", "c": "added"}
    assert tuple(delta_counts(delta).first()) == (1, 1, True)
    assert tuple(delta_counts(subscription_delta(now, now)).first()) == (0, 0, False)
    kept = now.join(delta.filter("change = 'removed'"), "market_id", "left_anti").union(delta.filter("change = 'added'").select("market_id"))
    assert {r[0] for r in kept.collect()} == {r[0] for r in desired.collect()}


def test_subscriptions_of_other_sources_stay(spark, tmp_path):
    from tradewatch import schemas
    from tradewatch.sources.tables import read_subscriptions, replace_subscriptions, write_table

    path, now = str(tmp_path / "subs"), datetime(2024, 6, 1)

    def stored():
        return sorted((r["source"], r["market_id"]) for r in read_subscriptions(spark, path, "ab").collect())

    assert stored() == []
    first = spark.createDataFrame([("a", "m1", "y", "n", 0), ("b", "m2", "y", "n", 1)], schemas.SUBSCRIPTIONS)
    for source in "ab":
        replace_subscriptions(first, path, source, now)
    before = read_subscriptions(spark, path, "ab")
    new = spark.createDataFrame([("a", "m9", "y", "n", 0)], schemas.SUBSCRIPTIONS)
    write_table(new.drop("source"), f"{path}/source=a/version=9999999999999999")  # a writer that broke off
    assert stored() == [("a", "m1"), ("b", "m2")]
    replace_subscriptions(new, path, "a", now + timedelta(hours=1))
    assert stored() == [("a", "m9"), ("b", "m2")]
    assert sorted(r["market_id"] for r in before.collect()) == ["m1", "m2"]  # a reader that had begun
    replace_subscriptions(first.limit(0), path, "a", now + timedelta(hours=2))
    assert stored() == [("b", "m2")]


KEYS = ["source", "ticker"]


def test_only_changed_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "markets")
    first = markets(spark, [(f"m{k}", "old", k % 2 == 0, None) for k in range(200)]).drop("resolved_at")
    schema = markets(spark, []).schema

    def stage(rows, days):
        return upsert_buckets(rows, path, schema, KEYS, OLD + timedelta(days=days), SETTLED, buckets=16)

    def stored(**more):
        return {r["ticker"]: (r["title"], r["resolved_at"]) for r in read_buckets(spark, path, schema, **more).collect()}

    assert stored() == {} and stage(first.limit(0), 0) == [] and stored() == {}
    assert stage(first, 1) == list(range(16)) and len(stored()) == 200
    changed = markets(spark, [("m7", "new", False, None), *[(f"m{k}", "new", False, None) for k in range(0, 200, 2)]])
    for _attempt in range(2):
        assert len(stage(changed.drop("resolved_at"), 2)) == 1
        assert len(list((tmp_path / "markets").glob("version=*/__bucket=*"))) == 17
    after = stored()
    assert after.pop("m7") == ("new", OLD + timedelta(days=2)) and set(after.values()) == {("old", OLD + timedelta(days=1))}
    assert len(after) == 199 and stored(before=OLD + timedelta(days=2))["m7"][0] == "old"
    assert stage(markets(spark, [("m8", "new", False, None)]).drop("resolved_at"), 3) == []
    # the number of buckets is the table's own
    added = markets(spark, [("m200", "new", False, None)]).drop("resolved_at")
    assert len(upsert_buckets(added, path, schema, KEYS, OLD + timedelta(days=4), SETTLED, buckets=5)) == 1
    assert len(stored()) == 201


def test_two_staged_rows_of_a_frozen_key_fail(spark, tmp_path):
    path, schema = str(tmp_path / "markets"), markets(spark, []).schema
    rows = markets(spark, [("m", "old", True, None)]).drop("resolved_at")
    upsert_buckets(rows, path, schema, KEYS, OLD, SETTLED)
    with pytest.raises(Exception, match="more than one staged row"):
        upsert_buckets(rows.union(rows), path, schema, KEYS, AS_OF, SETTLED)
