"""Shards of near-equal bytes by longest-processing-time scheduling; equal texts stay together.

Groups (rows with one text) are put in order of falling size, and each goes to the shard with the least load so far,
kept in a heap. A heap over every group of the corpus would be one long chain on one machine. So groups that are small
next to a shard are first gathered in bundles, by a hash of their text: the heap gets the large groups, of which there
can only be ``shards * per_shard``, and at most ``bundles`` bundles. Both bounds are parameters, not data.

The heaviest and the lightest shard differ by no more than the item that went last to the heaviest one. A group larger
than a shard's share fills its shard alone, as far as the others allow.

Null texts are one group of no bytes. Repeated rows keep a place each. Ids may be null or occur several times. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewatch.llm.common import stored, text_bytes, text_key

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: A group is large if it is at least this part of a shard's share.
PER_SHARD = 256
BUNDLES = 1 << 15
#: Windows into which a shard's rows are dealt to be numbered.
SLICES = 1024


def longest_first(sizes: dict, shards: int) -> dict:
    """The shard of each item: the largest first, always to the least loaded shard (ties: the lower number)."""
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for item in sorted(sizes, key=lambda x: (-sizes[x], str(x))):
        load, shard = heapq.heappop(heap)
        out[item] = shard
        heapq.heappush(heap, (load + sizes[item], shard))
    return out


def assign_shards(
    docs: DataFrame, shards: int = 40, per_shard: int = PER_SHARD, bundles: int = BUNDLES, slices: int = SLICES
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    spark = docs.sparkSession
    rows = stored(
        docs.select(
            "doc_id",
            (F.octet_length(F.coalesce("text", F.lit(""))) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text_bytes()).alias("text_crc32"),
            F.when(F.col("text").isNotNull(), text_key()).otherwise(F.lit("").cast("binary")).alias("_text"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "lpt-rows",
    )
    groups = rows.groupBy("_text").agg(F.sum("size").alias("size"))
    least = (rows.agg(F.sum("size")).first()[0] or 0) / (shards * per_shard)
    large = F.col("size") >= least
    bundle = F.pmod(F.xxhash64("_text"), F.lit(bundles)).cast("int")
    items = (
        groups.groupBy(F.when(large, F.col("_text")).alias("_text"), F.when(~large, bundle).alias("_bundle"))
        .agg(F.sum("size").alias("size"))
        .collect()
    )
    placed = longest_first({(bytes(x["_text"] or b""), x["_text"] is None, x["_bundle"]): x["size"] for x in items}, shards)
    alone = [(bytearray(text), shard) for (text, none, _), shard in placed.items() if not none]
    together = [(number, shard) for (_, none, number), shard in placed.items() if none]
    # both tables are bounded by shards * per_shard and by bundles
    out = rows.withColumn("_bundle", bundle)
    out = out.join(F.broadcast(spark.createDataFrame(alone, "_text binary, _own int")), "_text", "left")
    out = out.join(F.broadcast(spark.createDataFrame(together, "_bundle int, _with int")), "_bundle", "left")
    out = out.select("doc_id", "size", "text_crc32", "_row", F.coalesce("_own", "_with").alias("shard"))
    return numbered(out, slices).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(rows: DataFrame, slices: int = SLICES) -> DataFrame:
    """``slot``: the place of a row in its shard, without gaps.

    A shard's rows are dealt into slices by their row number; each slice is numbered in its own window, behind the rows
    of the slices before it. Only the slices' counts (``slices`` per shard) meet in one task.
    """
    rows = stored(rows.withColumn("_slice", F.pmod(F.xxhash64("_row"), F.lit(slices)).cast("int")), "lpt-shards")
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        rows.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    )
    place = F.row_number().over(Window.partitionBy("shard", "_slice").orderBy(F.col("doc_id").asc_nulls_first(), "_row")) - 1
    return (
        rows.withColumn("_place", place)
        .join(F.broadcast(firsts), ["shard", "_slice"])
        .withColumn("slot", F.col("_first") + F.col("_place"))
        .drop("_slice", "_place", "_first", "_row")
    )
