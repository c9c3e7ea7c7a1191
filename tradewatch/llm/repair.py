"""Token ids in files compressed by a Re-Pair grammar, readable at any position.

Documents are put in ascending order of their id and cut into shards (the partitions of that order). A shard is a
sequence of blocks of about ``block_ids`` ids, always whole documents. In each block frequent pairs of neighbouring
symbols are replaced by new symbols (rules), again and again. A block is one row of a Parquet file:

    shard, block, first_id (ids of the shard before the block), n_ids,
    doc_ids, doc_lengths   the documents in order, and the ids of each
    base                   smallest rule symbol; smaller symbols are token ids
    rules                  left and right symbol of each rule, little-endian unsigned 32-bit integers
    spans                  how many ids each rule stands for
    sequence               what is left of the block

The lengths in ``spans`` lead to any id without expanding what stands before it (``decode_range``).

Null texts have the end id only. Null document ids come first. Rows that are equal stay apart and keep their own
places. An empty table gives no files with rows. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm import tokens

BLOCK_IDS = 1 << 20
ROUNDS = 8
#: A round of replacements has to shorten the sequence by this share, else it is the last.
LEAST_GAIN = 0.02
_U4 = np.dtype("<u4")
_HASH_BITS = 18

FILE_SCHEMA = (
    "shard int, block int, first_id long, n_ids long, doc_ids array<long>, doc_lengths array<long>, base long,"
    " rules binary, spans binary, sequence binary"
)


def _frequent(left: np.ndarray, right: np.ndarray, least: int, turn: int):
    """Pairs that occur at least ``least`` times, as 64-bit keys by falling count, and the pair of each position.

    Pairs are counted in a table by their hash, one pair to a slot; a pair whose slot another one holds waits for a later
    turn, which hashes anew. Nothing is sorted but the frequent pairs.
    """
    key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
    slot = ((key * np.uint64(0x9E3779B97F4A7C15 + 2 * turn)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)
    holder = np.zeros(1 << _HASH_BITS, np.uint64)
    holder[slot] = key
    own = holder[slot] == key
    counts = np.bincount(slot[own], minlength=1 << _HASH_BITS)
    often = np.flatnonzero(counts >= least)
    # pairs of one count in mixed order: in rising order, a run of them would give way to its first
    often = often[np.lexsort((holder[often] * np.uint64(0xC2B2AE3D27D4EB4F), -counts[often]))]
    rank = np.full(1 << _HASH_BITS, len(often), np.int64)
    rank[often] = np.arange(len(often))
    return holder[often], np.where(own, rank[slot], len(often))


def compress(ids: np.ndarray, least: int | None = None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(base, rules, spans, sequence) of a block's ids.

    A round replaces all pairs that are frequent now, the more frequent first where two overlap. Pairs that in the
    end replace only one place give a rule all the same; ``least`` keeps such cases rare.
    """
    sequence = ids.astype(np.int64)
    base = int(sequence.max(initial=0)) + 1
    least = least or max(4, len(ids) // 20_000)
    rules, spans, size = [], [], base
    for turn in range(ROUNDS):
        if len(sequence) < 2:
            break
        pairs, rank = _frequent(sequence[:-1], sequence[1:], least, turn)
        if not len(pairs):
            break
        none = len(pairs)
        before = np.concatenate([[none], rank[:-1]])
        after = np.concatenate([rank[1:], [none]])
        chosen = np.flatnonzero((rank < none) & (rank < before) & (rank <= after))
        used, place = np.unique(rank[chosen], return_inverse=True)
        made = np.stack([pairs[used] >> np.uint64(32), pairs[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.int64)
        lengths = np.concatenate([np.ones(base, np.int64), *spans])
        rules.append(made)
        spans.append(lengths[made].sum(1))
        old = len(sequence)
        sequence[chosen] = size + place
        sequence = np.delete(sequence, chosen + 1)
        size += len(used)
        if old - len(sequence) < LEAST_GAIN * old:
            break
    return (
        base,
        np.concatenate(rules) if rules else np.zeros((0, 2), np.int64),
        np.concatenate(spans) if spans else np.zeros(0, np.int64),
        sequence,
    )


def expand(base: int, rules: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids that the symbols stand for. A rule only uses earlier symbols, so it takes one step per round."""
    while len(at := np.flatnonzero(symbols >= base)):
        copies = np.ones(len(symbols), np.int64)
        copies[at] = 2
        first = (np.cumsum(copies) - copies)[at]
        pair = rules[symbols[at] - base]
        symbols = np.repeat(symbols, copies)
        symbols[first], symbols[first + 1] = pair[:, 0], pair[:, 1]
    return symbols


def decode_range(base: int, rules: np.ndarray, spans: np.ndarray, sequence: np.ndarray, start: int, stop: int):
    """Ids ``start`` to ``stop`` of a block; only the symbols that overlap them are expanded."""
    lengths = np.ones(len(sequence), np.int64)
    longer = sequence >= base
    lengths[longer] = spans[sequence[longer] - base]
    ends = np.cumsum(lengths)
    stop = min(stop, int(ends[-1]) if len(ends) else 0)
    if start >= stop:
        return np.zeros(0, np.int64)
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
    skipped = start - (ends[first] - lengths[first])
    return expand(base, rules, sequence[first : last + 1])[skipped : skipped + stop - start]


def _encode(tokenizer: str, end_id: int, block_ids: int):
    def run(batches):
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, held = [], [], 0

        def row():
            ids = np.frombuffer(b"".join(parts), _U4)
            base, rules, spans, sequence = compress(ids)
            row = {
                "shard": [shard], "block": [block], "first_id": [first], "n_ids": [len(ids)], "doc_ids": [list(doc_ids)],
                "doc_lengths": [[len(x) // 4 for x in parts]], "base": [base], "rules": [rules.astype(_U4).tobytes()],
                "spans": [spans.astype(_U4).tobytes()], "sequence": [sequence.astype(_U4).tobytes()],
            }
            return pa.RecordBatch.from_pydict(row, ARROW_SCHEMA)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(names, tokens.encoded(batch.column("text").to_pylist(), tokenizer, end_id), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids) // 4
                if held >= block_ids:
                    yield row()
                    doc_ids, parts, block, first, held = [], [], block + 1, first + held, 0
        if parts:
            yield row()

    return run


ARROW_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64())]
    + [("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())), ("base", pa.int64())]
    + [("rules", pa.binary()), ("spans", pa.binary()), ("sequence", pa.binary())]
)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``text`` of all rows and write the files to ``path``, in ascending order of ``doc_id``.

    Rows with one id are ordered by text, then by where they are read, which also spreads an id that many rows share.
    """
    keys = ["doc_id", "_text_hash", "_row"]
    (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash"))
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(_encode(tokenizer, end_id, block_ids), FILE_SCHEMA)
        .write.parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit).

    Only the number of ids of each shard is gathered (one small row per partition that was written).
    """
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts, total = {}, 0
    for row in sizes:
        starts[row["shard"]], total = total, total + row["n"]
    return blocks.mapInArrow(_decode(starts), "doc_id long, start long, n_tokens long, ids binary")


def _decode(starts: dict[int, int]):
    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                lengths = np.array(block["doc_lengths"], np.int64)
                rules = np.frombuffer(block["rules"], _U4).astype(np.int64).reshape(-1, 2)
                sequence = np.frombuffer(block["sequence"], _U4).astype(np.int64)
                ids = expand(block["base"], rules, sequence).astype(_U4).tobytes()
                ends = np.cumsum(lengths)
                begins = ends - lengths
                texts = [ids[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                first = starts[block["shard"]] + block["first_id"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["doc_ids"], pa.int64()), pa.array(first + begins), pa.array(lengths), pa.array(texts, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
