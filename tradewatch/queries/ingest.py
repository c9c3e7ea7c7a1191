"""Registered queries on frame parsing, batch and streaming."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.coerce import instant
from tradewatch.operators.baseline import baseline_at, baseline_cells
from tradewatch.plans.cells import cells_between, merge_cells, store_cells
from tradewatch.plans.detect import DetectParams
from tradewatch.plans.ingest import ingest_trades
from tradewatch.queries import views
from tradewatch.queries.shape import r6, r6_sql, wall
from tradewatch.session import shared_folder
from tradewatch.sources.frames import parse_frames_a, parse_frames_b, rejects_a, rejects_b
from tradewatch.sources.packed import pack, read_packed
from tradewatch.sources.register import note_batch
from tradewatch.sources.tables import append_trades
from tradewatch.streaming import jobs

_DRAIN = {"availableNow": True}


def _stamp() -> F.Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def _shown(trades: DataFrame) -> DataFrame:
    return trades.select("source", "market_id", "trade_id", wall("ts"), "price", "size", "side")


def _parse_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(parse_frames_a(views.frames_a(spark, sf_dir), _stamp()))


def _parse_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(parse_frames_b(views.frames_b(spark, sf_dir), views.tokens(spark, sf_dir), _stamp()))


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        ingest_trades(
            views.frames_a(spark, sf_dir), views.frames_b(spark, sf_dir), views.tokens(spark, sf_dir), _stamp()
        )
    )


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = rejects_a(views.frames_a(spark, sf_dir))
    b = rejects_b(views.frames_b(spark, sf_dir), views.tokens(spark, sf_dir))
    return a.unionByName(b)


def _drained(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the trades table after both venues' frames went through the streams."""
    root = shared_folder(spark, "ingest")
    views.frames_a(spark, sf_dir).write.text(f"{root}/frames_a")
    views.frames_b(spark, sf_dir).write.text(f"{root}/frames_b")
    views.tokens(spark, sf_dir).write.parquet(f"{root}/tokens")
    schema = views.tokens(spark, sf_dir).schema
    running = [
        jobs.ingest_a(
            jobs.frame_stream(spark, f"{root}/frames_a"),
            f"{root}/trades",
            f"{root}/state_a",
            _stamp(),
            dedup=True,
            trigger=_DRAIN,
        ),
        jobs.ingest_b(
            jobs.frame_stream(spark, f"{root}/frames_b"),
            lambda: spark.read.schema(schema).parquet(f"{root}/tokens"),
            f"{root}/trades",
            f"{root}/state_b",
            _stamp(),
            dedup=True,
            trigger=_DRAIN,
        ),
    ]
    for query in running:
        query.awaitTermination()
    return f"{root}/trades"


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(jobs.trades_table(spark, _drained(spark, sf_dir)))


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = jobs.rejects_table(spark, _drained(spark, sf_dir))
    return kept.groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n"), F.count("frame").alias("n_frames"))


def odd_clock_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades that arrive up to an hour late; every 97th is stamped two days ahead."""
    ahead = F.col("ts") + F.expr("INTERVAL 2 DAYS")
    trades = views.trades(spark, sf_dir)
    return trades.withColumn("ts", F.when(F.col("trade_id").cast("bigint") % 97 == 5, ahead).otherwise(F.col("ts")))


STREAM_PARAMS = DetectParams(lookback=timedelta(minutes=45), baseline=timedelta(days=10), min_notional=20.0, z_limit=1.2)


def stream_detect(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    root = shared_folder(spark, "detect")
    append_trades(odd_clock_trades(spark, sf_dir), f"{root}/trades", "r0")
    store_cells(spark, f"{root}/trades", "r0")
    jobs.detect(
        jobs.trade_stream(spark, f"{root}/trades", files_per_batch),
        f"{root}/trades",
        lambda: (views.markets_a(spark, sf_dir), views.markets_b(spark, sf_dir), views.series(spark, sf_dir)),
        f"{root}/alerts",
        f"{root}/state",
        STREAM_PARAMS,
        trigger=_DRAIN,
    ).awaitTermination()
    return jobs.alerts_table(spark, f"{root}/alerts").select(
        "alert_id", "source", "market_id", "trade_id", "title", r6("notional"), r6("size_zscore"), wall("detected_at")
    )


_HOUR = timedelta(hours=1)


def _last_hour(trades: DataFrame):
    """The end of the hour in which the last trade arrived."""
    at = views.latest(trades, "ingested_at")
    return at + (-(at - datetime(1970, 1, 1, tzinfo=timezone.utc)) % _HOUR)


def _at_end(cells: DataFrame, trades: DataFrame, end) -> DataFrame:
    """The baseline of every market at that moment."""
    wanted = trades.select("market_id").distinct().select("market_id", F.lit(instant(end)).alias("__run"), F.lit(0).cast("bigint").alias("n_recent"))
    found = baseline_at(cells, wanted, ["market_id"], timedelta(days=10))
    return found.select(
        "market_id", "n_trades", r6("average_size"), r6("stddev_size"), r6("average_notional"), r6("stddev_notional")
    )


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline of every market at the end of the last hour, from hourly cells."""
    trades = views.trades(spark, sf_dir)
    cells = baseline_cells(trades.filter("size IS NOT NULL AND price IS NOT NULL"), ["market_id"], _HOUR)
    return _at_end(cells, trades, _last_hour(trades))


def _merged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored cells of four batches, two of them merged, then a third; the last one's are still to be written."""
    path, trades = f"{shared_folder(spark, 'cells')}/trades", views.trades(spark, sf_dir)
    end = _last_hour(trades)
    for k in range(4):
        append_trades(trades.filter(F.col("trade_id").cast("bigint") % 4 == k), path, f"r{k}")
        if k < 3:
            store_cells(spark, path, f"r{k}")
        if k in (1, 2):
            merge_cells(spark, path, end + timedelta(seconds=k), timedelta(days=11))
    return _at_end(cells_between(spark, path, end - timedelta(days=10), end, ["r0", "r3"]), trades, end)


def _packed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trades from six batches: three in one pack, one in the next, one of them written again, two not packed yet."""
    path, trades = f"{shared_folder(spark, 'packed')}/trades", views.trades(spark, sf_dir)

    def land(k: int) -> None:
        append_trades(trades.filter(F.col("trade_id").cast("bigint") % 6 == k), path, f"r{k}")
        note_batch(spark, path, f"r{k}")

    packed_at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for batches in ((0, 1, 2), (3,), (4, 5, 1)):
        for k in batches:
            land(k)
        if 4 not in batches:
            pack(spark, path, schemas.TRADES, "trade_date", ["source", "market_id", "ts"], packed_at + timedelta(days=batches[0]))
    return read_packed(spark, path, schemas.TRADES, "trade_date").select(
        *["source", "market_id", "trade_id", wall("ts"), "price", "size", "side", "raw", wall("ingested_at"), "batch_id", "trade_date"]
    )


QUERIES = {
    "parse_frames_a": _parse_a,
    "parse_frames_b": _parse_b,
    "ingest_trades": _ingest,
    "frame_rejects": _rejects,
    "stream_ingest": _stream_ingest,
    "stream_rejects": _stream_rejects,
    "stream_detect": stream_detect,
    "baseline_from_cells": _cells,
    "baseline_from_stored_cells": _merged_cells,
    "packed_trades": _packed_trades,
}

_COLUMNS = "source, market_id, trade_id, ts, price, size, side"
_BOTH = f"""WITH {views.FRAMES_A_SQL}, {views.FRAMES_B_SQL}
SELECT {_COLUMNS} FROM frames_a WHERE outcome = 'trade'
UNION ALL
SELECT {_COLUMNS} FROM frames_b WHERE outcome = 'trade'"""

_CELLS_SQL = f"""WITH {views.TRADES_SQL}, ending AS (
  SELECT time_bucket(INTERVAL 1 HOUR, max(ingested_at) - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS run FROM trades
)
SELECT market_id, count(*) AS n_trades, {r6_sql("avg(size)", "average_size")}, {r6_sql("stddev_samp(size)", "stddev_size")},
       {r6_sql("avg(price * size)", "average_notional")}, {r6_sql("stddev_samp(price * size)", "stddev_notional")}
FROM trades, ending
WHERE ts <= run AND ts > run - INTERVAL 10 DAY AND size IS NOT NULL AND price IS NOT NULL
GROUP BY market_id HAVING count(*) >= 10"""

_REJECTS_SQL = f"""WITH {views.FRAMES_A_SQL}, {views.FRAMES_B_SQL}
SELECT source, outcome, count(*) AS n
FROM (SELECT source, outcome FROM frames_a UNION ALL SELECT source, outcome FROM frames_b
      -- the number beside the event of an array frame
      UNION ALL SELECT source, 'not_an_object' FROM frames_b
      WHERE event_id % 3 = 0 AND event_id % 97 <> 0 AND event_id % 101 <> 0)
WHERE outcome <> 'keep_alive' GROUP BY ALL"""

ORACLES = {
    "parse_frames_a": f"WITH {views.FRAMES_A_SQL} SELECT {_COLUMNS} FROM frames_a WHERE outcome = 'trade'",
    "parse_frames_b": f"WITH {views.FRAMES_B_SQL} SELECT {_COLUMNS} FROM frames_b WHERE outcome = 'trade'",
    "ingest_trades": _BOTH,
    "stream_ingest": _BOTH,
    "frame_rejects": _REJECTS_SQL,
    "stream_rejects": f"""SELECT *, n AS n_frames FROM ({_REJECTS_SQL}) WHERE outcome <> 'trade'""",
    "stream_detect": f"""WITH {views.TRADES_SQL}, odd AS (
  SELECT * REPLACE (CASE WHEN event_id % 97 = 5 THEN ts + INTERVAL 2 DAY ELSE ts END AS ts),
         time_bucket(INTERVAL 15 MINUTE, ingested_at - INTERVAL 1 MICROSECOND) + INTERVAL 15 MINUTE AS run
  FROM trades
), judged AS (
  SELECT *, price * size AS notional, sha256(source || '|' || trade_id) AS alert_id FROM odd
  WHERE ts > run - INTERVAL 45 MINUTE AND ts <= run AND price * size > 20 AND price < 0.90
), baseline AS (
  SELECT j.alert_id, avg(h.size) AS average_size, stddev_samp(h.size) AS stddev_size,
         avg(h.price * h.size) AS average_notional, stddev_samp(h.price * h.size) AS stddev_notional
  FROM judged j JOIN odd h ON h.market_id = j.market_id AND h.ingested_at <= j.run
       -- cells end at whole quarters of an hour, as runs do
       AND h.ts <= j.run AND h.ts > j.run - INTERVAL 10 DAY
  WHERE h.size IS NOT NULL AND h.price IS NOT NULL
  GROUP BY j.alert_id HAVING count(*) >= 10
), scored AS (
  SELECT j.*, (size - average_size) / nullif(stddev_size, 0) AS size_zscore,
         (notional - average_notional) / nullif(stddev_notional, 0) AS notional_zscore
  FROM judged j JOIN baseline USING (alert_id)
), {views.DIMENSIONS_SQL}
SELECT alert_id, f.source, market_id, trade_id, coalesce(a.title, b.slug_title) AS title,
       {r6_sql("notional", "notional")}, {r6_sql("size_zscore", "size_zscore")}, run AS detected_at
FROM scored f LEFT JOIN markets_a a ON market_id = a.ticker LEFT JOIN markets_b b ON market_id = b.id
WHERE abs(size_zscore) > 1.2 AND abs(notional_zscore) > 1.2""",
    "baseline_from_cells": _CELLS_SQL,
    "baseline_from_stored_cells": _CELLS_SQL,
    "packed_trades": f"""WITH {views.TRADES_SQL}
SELECT source, market_id, trade_id, ts, price, size, side, raw, ingested_at,
       'r' || event_id % 6 AS batch_id, CAST(ts AS DATE) AS trade_date
FROM trades""",
}
