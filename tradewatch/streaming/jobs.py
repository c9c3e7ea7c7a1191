"""Streaming jobs: ingest of landed frames and detection on the trades table.

Every batch writes to folders that carry its own id and replaces them when it runs again, so a batch
repeated after a failure leaves the same rows as one that ran once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradewatch import schemas
from tradewatch.operators.skew import first_per_key
from tradewatch.plans.cells import CELL, cells_between, store_cells
from tradewatch.plans.detect import DetectParams, alerts_since, judge_runs
from tradewatch.sources.frames import judged_a, judged_b, rejects_of, trades_of
from tradewatch.sources.tables import BATCH, append_alerts, append_rejects, read_if_there, with_day, write_batch

# One run per five minutes; a drain of what is there uses {"availableNow": True}.
FLUSH = {"processingTime": "300 seconds"}

def frame_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def _ingest(
    frames: DataFrame,
    judge: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    prefix: str,
    dedup_on: Sequence[str],
    trigger: dict,
) -> StreamingQuery:
    """Parsed frames into the trades table; all venues write the same layout, a folder per batch.

    Frames are parsed once per batch, into a folder beside the checkpoint that the next batch overwrites. What is no trade goes
    with its reason to the table of rejects beside the trades, also in a folder per batch.

    With `dedup_on`, one trade of each key stays: of a batch the earliest, and none that another batch has stored for
    the same day. Only those days are read. No trade is dropped for being late.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        mine, spark = f"{prefix}{batch_id}", batch.sparkSession
        parsed = judge(batch)
        parsed.write.mode("overwrite").parquet(f"{checkpoint}_parsed")
        parsed = spark.read.schema(parsed.schema).parquet(f"{checkpoint}_parsed")
        append_rejects(rejects_of(parsed), f"{out}_rejects", mine)
        trades = with_day(trades_of(parsed), "ts", "trade_date")
        if dedup_on:
            trades = first_per_key(trades, dedup_on, [F.col("ts"), F.col("raw")])
            days = [r["trade_date"] for r in trades.select("trade_date").distinct().collect() if r["trade_date"]]
            known = trades_table(spark, out).filter((F.col(BATCH) != mine) & F.col("trade_date").isin(days))
            trades = trades.join(known.select(*dedup_on), list(dedup_on), "left_anti").select(*trades.columns)
        write_batch(trades, out, mine, "trade_date", ["source", "market_id", "ts"])
        store_cells(spark, out, mine)

    return frames.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def ingest_a(
    frames: DataFrame,
    out: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    dedup: bool = False,
    trigger: dict = FLUSH,
) -> StreamingQuery:
    """Venue-A frames into the trades table; `dedup` leaves out repeats of a trade id."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    on = ["source", "trade_id"] if dedup else []
    return _ingest(frames, lambda batch: judged_a(batch, stamp), out, checkpoint, "a", on, trigger)


def ingest_b(
    frames: DataFrame,
    tokens: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    dedup: bool = False,
    trigger: dict = FLUSH,
) -> StreamingQuery:
    """Venue-B frames into the trades table. `tokens` is read again for every batch, so a changed
    subscription counts from the next batch on. One transaction can hold several trades, so `dedup` leaves out
    only repeats that agree in all they say."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    on = ["source", "trade_id", "market_id", "ts", "price", "size", "side"] if dedup else []
    return _ingest(frames, lambda batch: judged_b(batch, tokens(), stamp), out, checkpoint, "b", on, trigger)


def trades_table(spark: SparkSession, path: str) -> DataFrame:
    """The trades of all venues; empty before the first batch."""
    return read_if_there(spark, path, schemas.TRADES, f"{BATCH} string, trade_date date")


def rejects_table(spark: SparkSession, trades_path: str) -> DataFrame:
    """The frames that became no trades, of all venues."""
    return read_if_there(spark, f"{trades_path}_rejects", schemas.REJECTS, f"{BATCH} string, rejected_date date")


def trade_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    extra = T.StructType.fromDDL(f"{BATCH} string, trade_date date").fields
    reader = spark.readStream.schema(T.StructType([*schemas.TRADES.fields, *extra]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def alerts_table(spark: SparkSession, path: str) -> DataFrame:
    """The alerts written by `detect`; empty before its first batch."""
    return read_if_there(spark, path, schemas.ALERTS, f"{BATCH} string, detected_date date")


def detect(
    new_trades: DataFrame,
    trades_path: str,
    dimensions: Callable[[], tuple[DataFrame, DataFrame, DataFrame]],
    alerts_path: str,
    checkpoint: str,
    params: DetectParams = DetectParams(),
    trigger: dict | None = None,
    every: timedelta = timedelta(minutes=15),
) -> StreamingQuery:
    """Flag unusual trades as they land in the trades table, against the baseline cells stored beside it.

    Every trade is judged once, as of the run of `every` that its arrival belongs to; how trades are dealt into batches
    and what clocks they carry makes no difference (see `judge_runs`). Alerts that other batches have stored are
    not repeated; those of the same batch are replaced, which makes a second attempt harmless.
    """

    if every % CELL:
        raise ValueError("runs end where stored cells end")

    def run(batch: DataFrame, batch_id: int) -> None:
        mine, spark = f"d{batch_id}", batch.sparkSession
        names = [r[BATCH] for r in batch.select(BATCH).distinct().collect()]
        found = judge_runs(
            batch, lambda low, high: cells_between(spark, trades_path, low, high, names), *dimensions(), params, every
        )
        first = batch.agg(F.min("ingested_at").alias("at")).first()["at"]
        known = alerts_table(batch.sparkSession, alerts_path).filter(F.col(BATCH) != mine)
        if first is not None:
            known = alerts_since(known, first.astimezone(timezone.utc) - params.lookback)
        append_alerts(found.join(known.select("alert_id"), "alert_id", "left_anti").select(*found.columns), alerts_path, mine)

    return (
        new_trades.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "15 minutes"}))
        .start()
    )
