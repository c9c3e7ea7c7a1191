"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewatch.session import prepare, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is read instead of computed again, also after lost executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(name: str = "text"):
    """The UTF-8 bytes of a text, none for null."""
    return F.encode(F.coalesce(F.col(name), F.lit("")), "UTF-8")


def text_key(name: str = "text"):
    """128 bits that stand for a text (null: as empty) where the text itself is too long to be a key."""
    return F.unhex(F.md5(text_bytes(name)))


def ranges(starts, lengths):
    """All positions of the ranges, one range after the other, and the range each belongs to (numpy)."""
    import numpy as np

    owner = np.repeat(np.arange(len(starts)), lengths)
    before = np.cumsum(lengths) - lengths
    return np.arange(len(owner)) - before[owner] + np.asarray(starts)[owner], owner


#: Column in which whole rows go through an operator, safe from clashing names.
ROW = "_doc"


def carried(docs: DataFrame, names: list[str], carry: bool) -> DataFrame:
    """The named columns and, if asked for, each row as a struct beside them."""
    whole = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias(ROW)
    return docs.select(*names, *[whole] * carry)


def schema_of(ddl: str, docs: DataFrame, carry: bool) -> StructType:
    out = StructType.fromDDL(ddl)
    return out.add(ROW, docs.schema) if carry else out
