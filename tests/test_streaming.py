import json

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.queries import views
from tradewatch.queries.ingest import STREAM_PARAMS, odd_clock_trades, stream_detect
from tradewatch.sources.frames import parse_frames_a, parse_frames_b, rejects_a
from tradewatch.sources.tables import append_trades
from tradewatch.streaming import jobs

SF = "/root/testdata/sf0.001"
DRAIN = {"availableNow": True}


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def keys(df):
    return sorted((r["source"], r["trade_id"], r["market_id"], r["side"]) for r in df.collect())


def test_venue_a_stream_equals_batch_and_resumes(spark, tmp_path):
    lines = views.frames_a(spark, SF)
    first, second = lines.filter(F.pmod(F.hash("value"), F.lit(2)) == 0), lines.filter(F.pmod(F.hash("value"), F.lit(2)) == 1)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def drain():
        jobs.ingest_a(jobs.frame_stream(spark, folder, 1), out, state, stamp(), trigger=DRAIN).awaitTermination()
        return spark.read.schema(schemas.TRADES).parquet(out)

    first.repartition(3).write.text(folder)
    assert keys(drain()) == keys(parse_frames_a(first, stamp()))
    assert keys(drain()) == keys(parse_frames_a(first, stamp()))
    second.repartition(2).write.mode("append").text(folder)
    assert keys(drain()) == keys(parse_frames_a(lines, stamp()))


def test_repeats_are_dropped(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    base = {"market_ticker": "m", "yes_price_dollars": "0.5", "count_fp": "1"}
    rows = [{"type": "trade", "msg": {**base, "ts_ms": 1704067200000 + i, "trade_id": f"t{i % 3}"}} for i in range(9)]
    frames = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    frames.repartition(2).write.text(folder)
    jobs.ingest_a(
        jobs.frame_stream(spark, folder), out, state, stamp(), dedup=True, trigger=DRAIN
    ).awaitTermination()
    assert sorted(r["trade_id"] for r in spark.read.schema(schemas.TRADES).parquet(out).collect()) == ["t0", "t1", "t2"]


def test_venue_b_reads_subscriptions_anew(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    frames, tokens = views.frames_b(spark, SF), views.tokens(spark, SF)
    known = {"now": tokens.limit(0)}

    def drain():
        jobs.ingest_b(
            jobs.frame_stream(spark, folder), lambda: known["now"], out, state, stamp(), trigger=DRAIN
        ).awaitTermination()

    frames.limit(50).write.text(folder)
    drain()
    known["now"] = tokens
    frames.write.mode("append").text(folder)
    drain()
    expected = keys(parse_frames_b(frames, tokens, stamp()))
    assert keys(spark.read.schema(schemas.TRADES).parquet(out)) == expected


def test_venue_b_batch_run_again_replaces_its_rows(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    frames, tokens = views.frames_b(spark, SF), views.tokens(spark, SF)
    frames.write.text(folder)
    for state in ("first", "checkpoint lost"):
        jobs.ingest_b(
            jobs.frame_stream(spark, folder), lambda: tokens, out, str(tmp_path / state), stamp(), trigger=DRAIN
        ).awaitTermination()
    assert keys(spark.read.schema(schemas.TRADES).parquet(out)) == keys(parse_frames_b(frames, tokens, stamp()))


def test_a_batch_that_failed_is_done_again(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    frames, tokens = views.frames_b(spark, SF), views.tokens(spark, SF)
    frames.repartition(4).write.text(folder)
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return tokens

    def drain():
        jobs.ingest_b(
            jobs.frame_stream(spark, folder, 1), flaky, out, state, stamp(), trigger=DRAIN
        ).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        drain()
    drain()
    assert len(calls) == 5
    assert keys(spark.read.schema(schemas.TRADES).parquet(out)) == keys(parse_frames_b(frames, tokens, stamp()))


def test_both_venues_share_one_table(spark, tmp_path):
    a, b, out = (str(tmp_path / n) for n in ("a", "b", "out"))
    frames_a, frames_b, tokens = views.frames_a(spark, SF), views.frames_b(spark, SF), views.tokens(spark, SF)
    frames_a.repartition(3).write.text(a)
    frames_b.repartition(2).write.text(b)
    for attempt in ("s", "again"):
        for name, frames in (("a", a), ("b", b)):
            stream, state = jobs.frame_stream(spark, frames, 1), str(tmp_path / f"{attempt}{name}")
            if name == "a":
                query = jobs.ingest_a(stream, out, state, stamp(), dedup=True, trigger=DRAIN)
            else:
                query = jobs.ingest_b(stream, lambda: tokens, out, state, stamp(), dedup=True, trigger=DRAIN)
            query.awaitTermination()
        want = keys(parse_frames_a(frames_a, stamp())) + keys(parse_frames_b(frames_b, tokens, stamp()))
        assert keys(jobs.trades_table(spark, out)) == sorted(want)


def test_detection_does_not_depend_on_batches_or_clocks(spark):
    def found(files):
        return sorted(tuple(r) for r in stream_detect(spark, SF, files).collect())

    whole = found(None)
    assert whole and found(1) == whole


def test_second_attempt_of_a_batch_adds_nothing(spark, tmp_path):
    path, alerts = str(tmp_path / "trades"), str(tmp_path / "alerts")
    append_trades(odd_clock_trades(spark, SF), path)

    def run(state):
        jobs.detect(
            jobs.trade_stream(spark, path),
            path,
            lambda: (views.markets_a(spark, SF), views.markets_b(spark, SF), views.series(spark, SF)),
            alerts,
            str(tmp_path / state),
            STREAM_PARAMS,
            trigger=DRAIN,
        ).awaitTermination()
        return sorted(r["trade_id"] for r in jobs.alerts_table(spark, alerts).collect())

    first = run("state")
    # A lost checkpoint makes batch 0 run again over the same trades.
    assert first and run("other") == first


def test_windows_in_a_stream_equal_batch(spark, tmp_path):
    from tradewatch.operators.reports import overlap_windows

    path = str(tmp_path / "trades")
    trades = views.trades(spark, SF)
    append_trades(trades, path)
    stream = overlap_windows(jobs.trade_stream(spark, path).withWatermark("ts", "30 minutes"))
    query = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(**DRAIN).start()
    query.awaitTermination()
    got = sorted((r["window_start"], r["source"], r["n"]) for r in spark.table("windows").collect())
    assert got == sorted((r["window_start"], r["source"], r["n"]) for r in overlap_windows(trades).collect())


def test_shared_folder_needs_a_setting_on_a_cluster():
    from tradewatch import session

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Fake:
        def __init__(self, **values):
            self.conf = Conf(**values)

    assert session.shared_folder(Fake(**{"spark.checkpoint.dir": "hdfs:///x/"}), "a").startswith("hdfs:///x/a-")
    with pytest.raises(RuntimeError):
        session.shared_folder(Fake(**{"spark.master": "yarn"}), "a")


def test_rejects_are_kept_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    lines = views.frames_a(spark, SF).limit(300).union(spark.createDataFrame([("garbage",), ("",)], "value string")).cache()
    lines.repartition(2).write.text(folder)

    def drain(checkpoint):
        jobs.ingest_a(jobs.frame_stream(spark, folder), out, checkpoint, stamp(), trigger=DRAIN).awaitTermination()
        kept = jobs.rejects_table(spark, out)
        return {r["outcome"]: r["count"] for r in kept.groupBy("outcome").count().collect()}, kept

    want = {r["outcome"]: r["n"] for r in rejects_a(lines).collect() if r["outcome"] != "trade"}
    # a checkpoint that was lost makes the same batch run again
    for checkpoint in (state, state + "-again"):
        counts, kept = drain(checkpoint)
        assert counts == want and counts["bad_json"] >= 2
    assert kept.filter("frame = 'garbage'").count() == 1
    lines.unpersist()
