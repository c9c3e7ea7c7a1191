"""Compaction of tables that are appended in batches.

A flush of five minutes leaves hundreds of small batch folders a day. `pack` copies the rows of the batches noted since the last
time into one pack: folders by day, in sorted files of even size. Packs lie beside the batches and count together with the list of
what they have taken in, which is finished last; so a reader sees a batch in its own folder or in a pack, never in both and
never in neither, and a reader that has begun is not disturbed. A pack that is made again for the same moment replaces itself.

The folders of packed batches are left alone, as streams follow them. `packed_before` names those that no reader needs any more, for
the storage's own clean-up.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions.coerce import micros_of
from tradewatch.sources.register import NOTES, Note, kept_notes, notes_table, read_batches, unseen
from tradewatch.sources.tables import BATCH, read_if_there, read_parts, read_table, write_parts, write_table

_PACKS = T.StructType().add("pack", T.LongType())
_TAKEN = T.StructType().add(BATCH, T.StringType()).add("pack", T.LongType())
_PARTS = {"packs": _PACKS, "seen": NOTES}


def _of(path: str) -> str:
    return f"{path.rstrip('/')}_packed"


def _state(spark: SparkSession, path: str, register: str, before: datetime | None = None) -> tuple[list[int], set[Note], set[str]]:
    """(packs that count, all notes of late, batches that are in no pack). A packed batch that is noted again stays in its pack."""
    parts = read_parts(spark, f"{_of(path)}_list", _PARTS, before)
    packs = sorted(r["pack"] for r in parts["packs"].collect())
    seen = {tuple(r) for r in parts["seen"].collect()}
    new = unseen(spark, register, seen, again=False)
    names = {name for name, _ in new}
    if packs and names:
        taken = read_table(spark, f"{_of(path)}_taken", _TAKEN).filter(F.col("pack").isin(packs))
        names -= {r[BATCH] for r in taken.filter(F.col(BATCH).isin(sorted(names))).select(BATCH).collect()}
    return packs, seen | new, names


def _full(schema: T.StructType, day: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.StringType()), T.StructField(day, T.DateType())])


def pack(
    spark: SparkSession, path: str, schema: T.StructType, day: str, cluster_by: Sequence[str], as_of: datetime, register: str | None = None
) -> int:
    """Take the batches noted since the last pack into a new one; returns how many. `register` is the path under which they are noted.

    A batch must not be written again with other rows once it has been packed.
    """
    packs, notes, names = _state(spark, path, register or path, as_of)
    if not names:
        return 0
    number = micros_of(as_of)
    rows = read_batches(spark, path, names, schema, f"{BATCH} string, {day} date")
    write_table(rows, f"{_of(path)}/pack={number}", "overwrite", [day], cluster_by)
    taken = spark.createDataFrame([(name,) for name in sorted(names)], f"{BATCH} string").coalesce(1)
    taken.write.mode("overwrite").parquet(f"{_of(path)}_taken/pack={number}")
    held = spark.createDataFrame([(x,) for x in [*packs, number]], _PACKS).coalesce(1)
    write_parts({"packs": held, "seen": notes_table(spark, kept_notes(notes))}, f"{_of(path)}_list", as_of)
    return len(names)


def read_packed(spark: SparkSession, path: str, schema: T.StructType, day: str, register: str | None = None) -> DataFrame:
    """The rows of all noted batches with their batch and day: packs, and the folders of the batches since. No other folder is listed."""
    packs, _, names = _state(spark, path, register or path)
    full = _full(schema, day)
    since = read_batches(spark, path, names, schema, f"{BATCH} string, {day} date").select(*full.names)
    if not packs:
        return since
    folders = [f"{_of(path)}/pack={x}" for x in packs]
    packed = spark.read.schema(full).option("basePath", _of(path)).parquet(*folders).select(*full.names)
    return packed.unionByName(since)


def packed_before(spark: SparkSession, path: str, before: datetime) -> list[str]:
    """The folders of batches that were packed before that moment. A reader that began later does not open them."""
    counted = read_parts(spark, f"{_of(path)}_list", _PARTS, before)["packs"]
    taken = read_if_there(spark, f"{_of(path)}_taken", _TAKEN).join(counted, "pack", "left_semi")
    return [f"{path.rstrip('/')}/{BATCH}={r[BATCH]}" for r in taken.select(BATCH).distinct().orderBy(BATCH).collect()]
