"""Tables kept in buckets of their keys, of which an upsert rewrites only those that change.

A manifest says which version of the table wrote each bucket. It is a small versioned table of its own and is finished
last, so a reader sees all buckets of a run or none, and a run that is repeated starts from what came before it.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions.coerce import micros_of
from tradewatch.operators.upsert import one_per_key, upsert
from tradewatch.sources.tables import read_latest, write_table, write_version

BUCKET = "__bucket"
#: How many buckets a new table gets; a table that exists keeps its own number.
BUCKETS = 32
_MANIFEST = T.StructType().add("bucket", T.IntegerType()).add("buckets", T.IntegerType()).add("version", T.LongType())


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str, before: datetime | None = None) -> tuple[dict[int, int], int | None]:
    """The version that holds each bucket, and the number of buckets (None where there is no table yet)."""
    rows = read_latest(spark, f"{path}_manifest", _MANIFEST, before).collect()
    return {r["bucket"]: r["version"] for r in rows if r["version"] is not None}, next((r["buckets"] for r in rows), None)


def _read(spark: SparkSession, path: str, held: dict[int, int], schema: T.StructType) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/version={v}/{BUCKET}={b}" for b, v in sorted(held.items())]
    return spark.read.schema(schema).parquet(*folders)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, before: datetime | None = None) -> DataFrame:
    """The table as its latest finished run left it, or the latest older than `before`; only those folders are opened."""
    return _read(spark, path, manifest(spark, path, before)[0], schema)


def upsert_buckets(
    staged: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    as_of: datetime,
    freeze_when: str = "false",
    buckets: int = BUCKETS,
    cluster_by: Collection[str] = (),
) -> list[int]:
    """`upsert` of `staged` into the table at `path`; returns the buckets that were written.

    A bucket changes if one of its staged rows is new or meets a row that is not frozen. Only buckets with staged
    rows are read, the keys of their frozen rows first, and only those that change are written. `staged` is read three times, so it
    should be a stored table. Two staged rows for one key are an error, in whatever bucket.
    """
    spark = staged.sparkSession
    held, known = manifest(spark, path, as_of)
    buckets = known or buckets
    placed = staged.withColumn(BUCKET, bucket_of(keys, buckets))
    asked = {r[BUCKET] for r in placed.select(BUCKET).distinct().collect()}
    current = _read(spark, path, {b: v for b, v in held.items() if b in asked}, schema)
    # no bucket is known before the test for rows of one key
    single = one_per_key(placed, keys).filter(F.col("s").isNotNull())
    moving = single.join(current.filter(freeze_when).select(*keys), list(keys), "left_anti")
    changed = sorted(r["b"] for r in moving.select(F.col(f"s.{BUCKET}").alias("b")).distinct().collect())
    if changed:
        target = _read(spark, path, {b: held[b] for b in changed if b in held}, schema)
        after = upsert(target, placed.filter(F.col(BUCKET).isin(changed)).drop(BUCKET), keys, as_of, freeze_when)
        folder = f"{path}/version={micros_of(as_of)}"
        write_table(after.withColumn(BUCKET, bucket_of(keys, buckets)), folder, "overwrite", [BUCKET], list(cluster_by))
    held = held | dict.fromkeys(changed, micros_of(as_of))
    # a table without rows keeps its number of buckets in a row without a version
    rows = [(b, buckets, v) for b, v in sorted(held.items())] or [(None, buckets, None)]
    write_version(spark.createDataFrame(rows, _MANIFEST).coalesce(1), f"{path}_manifest", as_of)
    return changed
