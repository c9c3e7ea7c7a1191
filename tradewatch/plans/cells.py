"""Stored baseline cells: what a rolling baseline needs of each batch of trades, kept beside the trades table.

A batch's cells are written once its trades are, in a folder of the same name, and noted in the cells' register. `merge_cells` adds
them up: one row per market, time cell and cell of arrival, without those behind the horizon. A reader takes the latest merged version and
the batches noted since, so a baseline over a week opens no trade and lists no folder that has been merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.functions.coerce import instant
from tradewatch.operators.baseline import baseline_cells, merged_cells
from tradewatch.sources.register import NOTES, Note, kept_notes, note_batch, notes_table, read_batches, unseen
from tradewatch.sources.tables import BATCH, read_parts, read_table, with_day, write_batch, write_parts

#: Width of a stored cell; runs end at multiples of it.
CELL = timedelta(minutes=15)
KEYS = ("source", "market_id")
_DAY = T.StructType().add("cell_date", T.DateType())


def cells_path(trades_path: str) -> str:
    """Where the cells of a trades table lie; its batches are noted under the same path."""
    return f"{trades_path.rstrip('/')}_cells"


def store_cells(spark: SparkSession, trades_path: str, batch: str) -> None:
    """Cells of a batch that has been written to the trades table. Done again, it replaces them by the same."""
    folder = f"{trades_path}/{BATCH}={batch}"
    trades = read_table(spark, folder, schemas.TRADES).filter("size IS NOT NULL AND price IS NOT NULL")
    cells = baseline_cells(trades, KEYS, CELL)
    write_batch(with_day(cells, "cell", "cell_date"), cells_path(trades_path), batch, "cell_date", list(KEYS))
    note_batch(spark, cells_path(trades_path), batch)


def _stored(spark: SparkSession, trades_path: str) -> tuple[DataFrame, DataFrame, set[Note]]:
    """(merged cells, cells of the batches since, notes of all of them)."""
    merged = read_parts(spark, f"{cells_path(trades_path)}_merged", {"cells": schemas.CELLS, "seen": NOTES})
    seen = {tuple(r) for r in merged["seen"].collect()}
    new = unseen(spark, cells_path(trades_path), seen, again=False)
    since = read_batches(spark, cells_path(trades_path), {name for name, _ in new}, T.StructType([*schemas.CELLS.fields, *_DAY.fields]))
    return merged["cells"], since, seen | new


def cells_between(
    spark: SparkSession, trades_path: str, low: datetime, high: datetime, needed: Sequence[str] = ()
) -> DataFrame:
    """The stored cells that end behind `low` and not after `high`. Of batches in `needed` (named by trades that are being judged)
    whose cells have not been written yet, they are computed from the trades."""
    merged, since, notes = _stored(spark, trades_path)
    bounds = (F.col("cell") > instant(low)) & (F.col("cell") <= instant(high))
    days = F.col("cell_date").between(F.to_date(instant(low)), F.to_date(instant(high)))
    found = merged.filter(bounds).unionByName(since.filter(bounds & days).select(*schemas.CELLS.names))
    late = set(needed) - {name for name, _ in notes}
    if late:
        extra = T.StructType().add(BATCH, T.StringType())
        raw = read_batches(spark, trades_path, late, T.StructType([*schemas.TRADES.fields, *extra.fields]))
        raw = baseline_cells(raw.filter("size IS NOT NULL AND price IS NOT NULL"), KEYS, CELL)
        found = found.unionByName(raw.filter(bounds).select(*schemas.CELLS.names))
    return found


def merge_cells(spark: SparkSession, trades_path: str, as_of: datetime, kept: timedelta = timedelta(days=8)) -> None:
    """Add up the merged cells and those of the batches since; cells behind `kept` go. Readers keep the version they have begun
    with. A batch must not be written again once it has been merged for two days."""
    merged, since, notes = _stored(spark, trades_path)
    both = merged.unionByName(since.select(*schemas.CELLS.names)).filter(F.col("cell") > instant(as_of - kept))
    write_parts({"cells": merged_cells(both, KEYS), "seen": notes_table(spark, kept_notes(notes))}, f"{cells_path(trades_path)}_merged", as_of)
