"""Writers and readers of the tables: layout, appends, refreshes, per-source replacement, outbox."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.functions.coerce import instant, micros_of
from tradewatch.sources.register import note_batch


def laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Rows gathered by folder and sorted by the clustering columns, in files of even size.

    The rebalance hint lets Spark split a busy day over many tasks and merge quiet ones, in one pass
    over the input. Sorted files let readers skip row groups by market.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    order = [*partition_by, *cluster_by]
    return balanced.sortWithinPartitions(*order) if order else balanced


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    replace: str = "static",
) -> None:
    """Write parquet in the given layout.

    With mode ``overwrite``, `replace` says what goes: ``static`` the whole table, ``dynamic`` only the
    folders that occur in `df`.
    """
    writer = laid_out(df, partition_by, cluster_by).write.mode(mode).option("partitionOverwriteMode", replace)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def with_day(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.to_date(column))


BATCH = "batch_id"


def write_batch(df: DataFrame, path: str, batch: str | None, day: str, cluster_by: Sequence[str]) -> None:
    """The rows of one run in a folder of their own, by day. A run that is repeated replaces all it wrote before, also
    by nothing. Without a name the rows are added under a new one."""
    name = batch or f"r{uuid.uuid4().hex}"
    write_table(df, f"{path}/{BATCH}={name}", "overwrite", [day], cluster_by)


def append_trades(trades: DataFrame, path: str, batch: str | None = None) -> None:
    write_batch(with_day(trades, "ts", "trade_date"), path, batch, "trade_date", ["source", "market_id", "ts"])


def append_rejects(rejects: DataFrame, path: str, batch: str | None = None) -> None:
    write_batch(with_day(rejects, "ingested_at", "rejected_date"), path, batch, "rejected_date", ["source", "outcome"])


def append_alerts(alerts: DataFrame, path: str, batch: str | None = None) -> None:
    """Add a run's alerts; the batch is noted in the table's register, from which notification takes what is new."""
    name = batch or f"r{uuid.uuid4().hex}"
    write_batch(
        with_day(alerts, "detected_at", "detected_date"), path, name, "detected_date", ["source", "market_id", "alert_id"]
    )
    note_batch(alerts.sparkSession, path, name)


STATE = (
    T.StructType().add("alert_id", T.StringType()).add("notified_at", T.TimestampType()).add("discord_thread_id", T.StringType())
)


def append_state(state: DataFrame, path: str, batch: str | None = None) -> None:
    """Notification state of one cycle; who was told what is kept apart from the alerts."""
    write_batch(with_day(state, "notified_at", "notified_date"), path, batch, "notified_date", ["alert_id"])


def append_threads(threads: DataFrame, path: str, batch: str | None = None) -> None:
    """Add the threads of a cycle's sent alerts, in folders by a hash of the thread, which is how they are looked up."""
    rows = threads.withColumn("thread_bucket", thread_bucket(F.col("discord_thread_id")))
    write_batch(rows, path, batch, "thread_bucket", ["discord_thread_id"])


def thread_bucket(thread: Column, buckets: int = 64) -> Column:
    return F.pmod(F.xxhash64(thread), F.lit(buckets)).cast("int")


def append_debates(debates: DataFrame, path: str, batch: str | None = None) -> None:
    """Append debate rows; struct and map columns are stored as JSON text, text stays as it is."""
    nested = (T.StructType, T.MapType, T.ArrayType)
    flat = debates.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in debates.schema.fields
        ]
    )
    write_batch(
        with_day(flat, "started_at", "started_date"), path, batch, "started_date", ["source", "market_id", "finished_at"]
    )


def refresh_series(series: DataFrame, path: str, as_of: datetime) -> None:
    """Replace the series table; the whole run carries one timestamp."""
    write_table(
        series.withColumn("resolved_at", instant(as_of)), path, mode="overwrite", cluster_by=["category", "ticker"]
    )


def replace_subscriptions(subscriptions: DataFrame, path: str, source: str, as_of: datetime) -> None:
    """Replace the subscriptions of one source, also by none; other sources are left alone.

    The new set is written beside the old one and counts once it is finished, so a reader in between sees the old set.
    """
    own = subscriptions.filter(F.col("source") == source).drop("source")
    write_version(own, f"{path}/source={source}", as_of, ["market_id"])


def read_subscriptions(spark: SparkSession, path: str, sources: Sequence[str] = ("venue_a", "venue_b")) -> DataFrame:
    """The latest finished set of each source."""
    own = T.StructType([f for f in schemas.SUBSCRIPTIONS.fields if f.name != "source"])
    parts = [read_latest(spark, f"{path}/source={x}", own).withColumn("source", F.lit(x)) for x in sources]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(*schemas.SUBSCRIPTIONS.names)


def write_transcripts(entries: DataFrame, path: str, folder: Column | None = None) -> None:
    """JSON lines in entry order, by default one folder per debate; a long debate becomes several files.

    With very many debates give `folder`, a coarser grouping of them, to avoid a folder for each.
    """
    (
        laid_out(
            entries.withColumn("folder", F.col("debate_id") if folder is None else folder),
            ["folder"],
            ["debate_id", "seq"],
        )
        .write.mode("append")
        .partitionBy("folder")
        .json(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType, extra: str = "") -> DataFrame:
    """Read with the declared schema; columns the files lack come back as NULL."""
    full = T.StructType(schema.fields + (T.StructType.fromDDL(extra).fields if extra else []))
    return spark.read.schema(full).parquet(path)


def write_version(df: DataFrame, path: str, as_of: datetime, cluster_by: Sequence[str] = ()) -> None:
    """Write a table's next version beside the earlier ones, for tables computed from themselves.

    The version counts once its name stands in the small folder of finished versions, which is written last.
    """
    write_table(df, f"{path}/version={micros_of(as_of)}", "overwrite", cluster_by=cluster_by)
    finish_version(df.sparkSession, path, as_of)


def finish_version(spark: SparkSession, path: str, as_of: datetime) -> None:
    number = micros_of(as_of)
    done = spark.createDataFrame([(number,)], "number bigint")
    done.coalesce(1).write.mode("overwrite").parquet(f"{path}_versions/finished={number}")


def write_parts(parts: dict[str, DataFrame], path: str, as_of: datetime) -> None:
    """Write a version that consists of several tables; they count together once the version is finished."""
    for name, df in parts.items():
        write_table(df, f"{path}/version={micros_of(as_of)}/part={name}", "overwrite")
    finish_version(next(iter(parts.values())).sparkSession, path, as_of)


def latest_version(spark: SparkSession, path: str, before: datetime | None = None) -> int | None:
    """The latest finished version of a table, or the latest older than `before`."""
    finished = read_if_there(spark, f"{path}_versions", T.StructType([T.StructField("number", T.LongType())]))
    if before is not None:
        finished = finished.filter(F.col("number") < F.lit(micros_of(before)))
    return finished.agg(F.max("number").alias("v")).first()["v"]


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, before: datetime | None = None
) -> DataFrame:
    """The latest finished version of a table, or the latest older than `before`; empty where there is none.

    A job that writes the version of its own moment reads what came before it. Run again after a
    failure, it starts from the same rows and replaces what it had written. Only that version's files are opened.
    """
    newest = latest_version(spark, path, before)
    if newest is None:
        return spark.createDataFrame([], schema)
    return read_table(spark, f"{path}/version={newest}", schema)


def read_parts(spark: SparkSession, path: str, parts: dict[str, T.StructType], before: datetime | None = None) -> dict[str, DataFrame]:
    """The tables of the latest finished version that `write_parts` wrote; empty ones where there is none."""
    newest = latest_version(spark, path, before)
    if newest is None:
        return {name: spark.createDataFrame([], schema) for name, schema in parts.items()}
    return {name: read_table(spark, f"{path}/version={newest}/part={name}", schema) for name, schema in parts.items()}


def read_if_there(spark: SparkSession, path: str, schema: T.StructType, extra: str = "") -> DataFrame:
    """`read_table`, or no rows where nothing has been written yet."""
    try:
        return read_table(spark, path, schema, extra)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        more = T.StructType.fromDDL(extra).fields if extra else []
        return spark.createDataFrame([], T.StructType([*schema.fields, *more]))


def outbox(messages: DataFrame, key: str) -> DataFrame:
    """Messages as (key, value) with a JSON value, NULL fields kept, ready for a message topic."""
    body = F.to_json(F.struct(*messages.columns), {"ignoreNullFields": "false"})
    return messages.select(F.col(key).cast("string").alias("key"), body.alias("value"))
