"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on (UTC instants, adaptive plans)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Start-up settings for a cluster of that many executor cores.

    Three shuffle tasks per core to begin with; adaptive execution merges what turns out small and
    splits skewed join sides. Scans read 256 MB per task, so 100 TB make about 400,000 tasks.
    """
    return {
        **RUNTIME_CONF,
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }


def local_session(cores: int | str = 8, partitions: int | None = None, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tradewatch")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, below the one named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine: on a cluster the
    executors would each see their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tradewatch-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder: it is read by all that follows instead of computed again."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
