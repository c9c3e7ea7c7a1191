from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.sources import packed, register
from tradewatch.sources.packed import pack, packed_before, read_packed
from tradewatch.sources.register import note_batch
from tradewatch.sources.tables import append_trades

NOW = datetime(2024, 5, 3, tzinfo=timezone.utc)
DAYS = ("2024-05-01", "2024-05-02", None)


def land(spark, path, name, first, n=30, noted=True):
    day = F.when(F.col("id") % 3 == 0, DAYS[0]).when(F.col("id") % 3 == 1, DAYS[1])
    rows = spark.range(first, first + n, 1, 4).select(F.col("id").cast("string").alias("trade_id"), day.cast("timestamp").alias("ts"))
    append_trades(schemas.conform(rows, schemas.TRADES), path, name)
    if noted:
        note_batch(spark, path, name)


def do_pack(spark, path, as_of):
    return pack(spark, path, schemas.TRADES, "trade_date", ["market_id"], as_of)


def held(spark, path):
    rows = read_packed(spark, path, schemas.TRADES, "trade_date").collect()
    return sorted((int(r["trade_id"]), r["batch_id"], str(r["trade_date"])) for r in rows)


def test_packs_hold_the_same_rows_in_few_files(spark, tmp_path):
    path = str(tmp_path / "trades")
    assert held(spark, path) == [] and do_pack(spark, path, NOW) == 0
    for k in range(5):
        land(spark, path, f"a{k}", 30 * k)
    want = held(spark, path)
    assert [x[0] for x in want] == list(range(150))
    assert do_pack(spark, path, NOW) == 5 and held(spark, path) == want
    assert do_pack(spark, path, NOW) == 5 and held(spark, path) == want  # the same run again
    assert do_pack(spark, path, NOW + timedelta(hours=1)) == 0
    files = list((tmp_path / "trades_packed").glob("pack=*/*/*.parquet"))
    assert len(files) == 3 and len(list((tmp_path / "trades").glob("*/*/*.parquet"))) > 10
    land(spark, path, "a5", 150)
    assert do_pack(spark, path, NOW + timedelta(days=1)) == 1
    land(spark, path, "a6", 180)
    assert [x[0] for x in held(spark, path)] == list(range(210))
    # a day is found by its folders
    one = read_packed(spark, path, schemas.TRADES, "trade_date").filter(F.col("trade_date") == DAYS[0])
    assert one.count() == 70 and "PartitionFilters: [isnotnull(trade_date" in one._jdf.queryExecution().toString()


def test_readers_and_broken_runs(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "trades")
    for k in range(3):
        land(spark, path, f"a{k}", 30 * k)
    land(spark, path, "unfinished", 900, noted=False)
    want = held(spark, path)
    assert len(want) == 90
    begun = read_packed(spark, path, schemas.TRADES, "trade_date")

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(packed, "write_parts", broken)
        with pytest.raises(RuntimeError, match="lost"):
            do_pack(spark, path, NOW)
    assert held(spark, path) == want  # what was written does not count
    assert packed_before(spark, path, NOW + timedelta(hours=9)) == []
    assert do_pack(spark, path, NOW + timedelta(hours=1)) == 3
    assert begun.count() == 90 and held(spark, path) == want
    assert packed_before(spark, path, NOW + timedelta(hours=1)) == []
    assert packed_before(spark, path, NOW + timedelta(hours=2)) == [f"{path}/batch_id=a{k}" for k in range(3)]
    note_batch(spark, path, "unfinished")
    assert len(held(spark, path)) == 120


def test_a_batch_noted_again_on_a_later_day_is_not_there_twice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "trades")
    for k, day in enumerate((date(2024, 5, 1), date(2024, 5, 9))):
        monkeypatch.setattr(register, "today", lambda day=day: day)
        land(spark, path, f"a{k}", 30 * k)
        do_pack(spark, path, NOW + timedelta(days=k))
    monkeypatch.setattr(register, "today", lambda: date(2024, 5, 9))
    land(spark, path, "a0", 0)
    assert [x[0] for x in held(spark, path)] == list(range(60))
    assert do_pack(spark, path, NOW + timedelta(days=3)) == 0
    assert [x[0] for x in held(spark, path)] == list(range(60))


def test_packed_folders_may_go(spark, tmp_path):
    path = str(tmp_path / "trades")
    land(spark, path, "a0", 0)
    do_pack(spark, path, NOW)
    want = held(spark, path)
    for folder in packed_before(spark, path, NOW + timedelta(days=1)):
        for file in tmp_path.joinpath("trades", folder.rsplit("/", 1)[1]).rglob("*.parquet"):
            file.unlink()
    assert held(spark, path) == want
