"""Which batches a table holds: noted by the writer once a batch is complete, read from the end.

A note is one small row in the folder of the day on which it was made (by the writer's clock, not the run's moment), so a
reader that knows when it last looked opens the folders from then on and no older one.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Note = tuple[str, date]
NOTES = T.StructType().add("batch_id", T.StringType()).add("noted_on", T.DateType())


def today() -> date:
    return datetime.now(timezone.utc).date()


def note_batch(spark: SparkSession, path: str, name: str) -> None:
    """Note that the batch `name` of the table at `path` is complete. Noting it again does no harm.

    Each note has a folder of its own, so that several streams can note batches of one table at the same time.
    """
    row = spark.createDataFrame([(name,)], "batch_id string").coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}_batches/noted_on={today()}/note={name}")


def notes_since(spark: SparkSession, path: str, since: date | None = None) -> set[Note]:
    """The (batch_id, noted_on) of batches noted on `since` or later; all where it is None. Names only, one per run."""
    folder = f"{path}_batches"
    if since is not None:
        days = [str(since + timedelta(days=k)) for k in range((today() - since).days + 2)]
        folder = f"{folder}/noted_on={{{','.join(days)}}}"
    try:
        found = spark.read.schema(NOTES).option("basePath", f"{path}_batches").parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {tuple(r) for r in found.select("batch_id", "noted_on").collect()}


def unseen(spark: SparkSession, path: str, seen: set[Note], again: bool = True) -> set[Note]:
    """The notes that are not in `seen` (a consumer's notes). Folders older than the day before its latest one are closed.

    A batch that is noted again on another day comes again, unless `again` is false.
    """
    last = max((day for _, day in seen), default=None)
    notes = notes_since(spark, path, last and last - timedelta(days=1))
    known = {name for name, _ in seen}
    return notes - seen if again else {x for x in notes if x[0] not in known}


def kept_notes(seen: set[Note]) -> set[Note]:
    """What a consumer has to remember of its notes: those of the latest two days."""
    last = max((day for _, day in seen), default=None)
    return {x for x in seen if x[1] >= last - timedelta(days=1)}


def notes_table(spark: SparkSession, notes: set[Note]) -> DataFrame:
    return spark.createDataFrame(sorted(notes), NOTES).coalesce(1)


def read_batches(spark: SparkSession, path: str, names: Collection[str], schema: T.StructType, extra: str = "") -> DataFrame:
    """The rows of the named batches; only their folders are listed."""
    full = T.StructType([*schema.fields, *T.StructType.fromDDL(extra).fields] if extra else schema.fields)
    if not names:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/batch_id={x}" for x in sorted(names)])
