"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a pigeonring filter.

A text's A-Z are lowered, words are runs without blank, tab and line ends, and each run of ``shingle`` words (a shorter
text: all its words) votes with the bits of its XXH64 (seed 42). A fingerprint bit is set if more than half of the votes
have it. Texts without words, null ones as well, have the fingerprint zero and are linked like any other.

Fingerprints within ``most`` differing bits are found by pigeonring: the 64 bits stand in a ring of ``parts`` segments. If
two fingerprints differ in ``most`` bits, some segment starts a chain in which the first k segments differ in no more
than k * most / parts bits, for every k. The first segments of a chain have a budget of no bit at all, so they are the
join key; the budgets of the longer chains are tested next, and what passes gets the full Hamming test. Only distinct
fingerprints are joined, so copies make no pairs. Buckets of more than ``bucket`` fingerprints take an exact way without pairs: a
fingerprint and each of its 64 one-bit neighbours are keys, two fingerprints within two bits share a key, and no key has
more than 65 fingerprints.

``component_id`` is the smallest doc_id that links reach. Null ids take part and are never the smallest, unless there is no
other. Repeated rows and empty tables need no care. Other columns are not read by ``fingerprints``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import ROW, carried, stored
from tradewatch.llm.components import components

SHINGLE, MOST, PARTS, BUCKET, SEED = 3, 2, 9, 64, 42
_ARROW = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("fp", pa.int64())])


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    n = max(1, len(words) - shingle + 1)
    begins = (ends - sizes + 1)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    votes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)], "<u8")
    bits = np.unpackbits(votes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ``row`` (where it is read) and ``fp``, the 64 bits as a signed long, of every row."""

    def run(batches):
        for batch in batches:
            found = np.array([simhash(x, shingle) for x in batch.column("text").to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("row"), pa.array(found)], schema=_ARROW)

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(run, "doc_id long, row long, fp long")


def ring_masks(start: int, parts: int, most: int) -> list[tuple[int, int]]:
    """(mask of the first k segments from ``start``, their budget) for k = 1 to ``parts``, as signed 64-bit masks."""
    cuts = [64 * k // parts for k in range(parts + 1)]
    out, mask = [], 0
    for k in range(parts):
        at = (start + k) % parts
        mask |= (1 << cuts[at + 1]) - (1 << cuts[at])
        out.append((mask - (1 << 64) if mask >> 63 else mask, (k + 1) * most // parts))
    return out


def near_pairs(fps: DataFrame, most: int = MOST, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a < b) of the distinct values of ``fp`` that differ in ``most`` bits or fewer.

    Out of large buckets come pairs that link the same values, each true, but not every pair of them.
    """
    if not 0 < most <= 2:
        raise ValueError("the way for large buckets needs a limit of one or two bits")
    fps = fps.select("fp").distinct()
    chains = [ring_masks(k, parts, most) for k in range(parts)]
    exact = [max((mask for mask, budget in x if budget == 0), key=lambda m: bin(m & (2**64 - 1)).count("1")) for x in chains]
    keys = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(k).alias("start"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(exact)])).alias("key")
    ).select("fp", "key.start", "key.bits")
    keys = stored(keys, "ring-keys")
    sizes = keys.groupBy("start", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = stored(keys.join(sizes, ["start", "bits"]), "ring-buckets")
    small = keyed.where(F.col("n") <= bucket)
    a = small.select("start", "bits", F.col("fp").alias("a"))
    b = small.select("start", "bits", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    passes = F.lit(False)
    for k, chain in enumerate(chains):
        longer = [F.bit_count(differ.bitwiseAND(F.lit(mask))) <= budget for mask, budget in chain if budget]
        own = F.col("start") == k
        for test in longer:
            own = own & test
        passes = passes | own
    pairs = a.join(b, ["start", "bits"]).where(F.col("a") < F.col("b")).where(passes & (F.bit_count(differ) <= most))
    large = keyed.where(F.col("n") > bucket).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(64)])
    variants = large.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    stars = variants.groupBy("variant").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select("a", F.explode("all").alias("b")).where("a <> b").where(F.bit_count(differ) <= most)
    return pairs.select("a", "b").unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hexadecimal digits), component_id, row, and first: whether it is the one row of its
    component that stays (the smallest id, of rows with one id the one that is read first)."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    nodes = rows.groupBy("fp").agg(F.min(place).alias("least"))
    roots = components(near_pairs(nodes, most))
    nodes = stored(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "fp-roots")
    least = nodes.groupBy("root").agg(F.min("least").alias("least"))
    known = nodes.drop("least").join(least, "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("_first"))
    return rows.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "row", (F.col("row") == F.col("_first")).alias("first")
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stay = near_duplicates(docs, shingle, most).where("first").select("row")
    rows = carried(docs, [], carry=True).select(F.monotonically_increasing_id().alias("row"), ROW)
    return rows.join(stay, "row").select(f"{ROW}.*")
