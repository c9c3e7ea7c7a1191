"""Merkle manifest of a dataset: 8-ary hash trees per group, in blocks of van Emde Boas layout, and one tree over the groups.

A row is a leaf: H (sha256 in lowercase hexadecimal, inputs concatenated) of its fields, ``-`` for null, else the number of
UTF-8 bytes, a colon and the value. Per group leaves ascend by the order column (null first, equal ones by leaf); while
several nodes remain, each run of eight becomes their H. Roots of groups, ordered by group (null first), likewise give
the root.

A tree is cut into aligned blocks of four levels (4096 leaves). A block is one row of the manifest and holds all its nodes in
one array of van Emde Boas order: the tree is split at half of its height, the upper part is stored first and then the lower
ones one after the other, each laid out likewise. Places follow from arithmetic alone (``address``), for building as well as
for looking siblings up, so that any path touches few neighbouring parts of the array whatever the size of a cache line.
The roots of a level's blocks are the leaves of the next level, until one block is left.

Leaves of a group are numbered by ranges, never gathered: a task sees one block. Rows that are equal are leaves of their own.
Texts of any length are hashed whole. Of an empty table no rows come back. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import stored
from tradewatch.operators.numbering import numbered

ARITY, HEIGHT = 8, 4
BLOCK = ARITY**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<before: string, after: string>>"
_PROOF_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``fields`` replaces columns by other expressions."""
    parts = []
    for name in FIELDS:
        value = (fields or {}).get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return digest(*parts)


def tree_size(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0: root) in the layout of a tree of so many levels of nodes."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = ARITY ** (depth - top)
    return tree_size(top) + (index // below) * tree_size(levels - top) + address(levels - top, depth - top, index % below)


def height_of(n: int) -> int:
    """Levels above the leaves until one node is left."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def build_block(leaves: list[bytes], height: int) -> tuple[bytes, str]:
    """(layout, hexadecimal root) of the digests ``leaves``; places of nodes that do not exist hold zeros."""
    levels = height + 1
    layout = np.zeros((tree_size(levels), 32), np.uint8)
    count = len(leaves)
    layout[address(levels, height, np.arange(count))] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
    for depth in range(height - 1, -1, -1):
        nodes = layout[address(levels, depth + 1, np.arange(count))].tobytes().hex().encode()
        run = ARITY * 64
        count = -(-count // ARITY)
        made = b"".join([sha256(nodes[k * run : (k + 1) * run]).digest() for k in range(count)])
        layout[address(levels, depth, np.arange(count))] = np.frombuffer(made, np.uint8).reshape(-1, 32)
    return layout.tobytes(), layout[address(levels, 0, np.zeros(1, np.int64))].tobytes().hex()


def siblings(layout: bytes, n: int, height: int) -> list[tuple[list[str], list[str]]]:
    """For each level from the leaves up, what stands before and behind each of its nodes in the node's run."""
    nodes = np.frombuffer(layout, np.uint8).reshape(-1, 32)
    out, count = [], n
    for depth in range(height, 0, -1):
        text = nodes[address(height + 1, depth, np.arange(count))].tobytes().hex()
        first = [64 * (k - k % ARITY) for k in range(count)]
        out.append(
            ([text[f : 64 * k] for k, f in enumerate(first)], [text[64 * (k + 1) : f + 64 * ARITY] for k, f in enumerate(first)])
        )
        count = -(-count // ARITY)
    return out


def _proofs(layout: bytes, n: int, height: int, places: list[int], chain: list[dict]) -> pa.Array:
    """The proofs of the leaves at ``places``: their siblings in the block and then the block's own proof."""
    found = siblings(layout, n, height)
    before, after = [], []
    tail_before, tail_after = [x["before"] for x in chain], [x["after"] for x in chain]
    for place in places:
        for own_before, own_after in found:
            before.append(own_before[place])
            after.append(own_after[place])
            place //= ARITY
        before += tail_before
        after += tail_after
    steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
    return pa.ListArray.from_arrays(np.arange(len(places) + 1, dtype=np.int32) * (len(found) + len(chain)), steps)


def _blocks(entries: DataFrame, label: str) -> DataFrame:
    """Blocks of ``entries`` (key, number, leaf): key, block, n, height, layout, root; a stored table of the manifest."""
    schema = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("height", pa.int64()), ("layout", pa.binary()), ("root", pa.string())])

    def run(table):
        order = np.argsort(table.column("number").to_numpy())
        leaves = [bytes.fromhex(x) for x in table.column("leaf").take(order).to_pylist()]
        block = table.column("block")[0].as_py()
        # only the first block of a key can be lower than a full one
        height = HEIGHT if block else min(HEIGHT, height_of(len(leaves)))
        layout, root = build_block(leaves, height)
        made = pa.Table.from_pydict({"block": [block], "n": [len(leaves)], "height": [height], "layout": [layout], "root": [root]}, schema)
        return made.add_column(0, table.schema.field("key"), table.column("key").slice(0, 1))

    kind = entries.schema["key"].dataType.simpleString()
    blocked = entries.select("key", "number", "leaf", F.floor(F.col("number") / BLOCK).cast("long").alias("block"))
    made = blocked.groupBy("key", "block").applyInArrow(run, f"key {kind}, block long, n long, height long, layout binary, root string")
    return stored(made, label)


def _raised(entries: DataFrame, label: str) -> list[DataFrame]:
    """The levels of blocks over ``entries``; the last one has one block for each key."""
    levels = [_blocks(entries, f"{label}-0")]
    while not levels[-1].where("block > 0").isEmpty():
        above = levels[-1].select("key", F.col("block").alias("number"), F.col("root").alias("leaf"))
        levels.append(_blocks(above, f"{label}-{len(levels)}"))
    return levels


def _chained(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Blocks of the lowest level with ``proof``, the way from their root up. ``tops`` has the proof (key, proof) of each tree."""
    kind = levels[0].schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k, row in enumerate(batch.select(["n", "height", "layout", "proof"]).to_pylist()):
                proofs = _proofs(row["layout"], row["n"], row["height"], list(range(row["n"])), row["proof"])
                numbers = batch.column("block")[k].as_py() * BLOCK + np.arange(row["n"])
                keys = batch.column("key").slice(k, 1).take(np.zeros(row["n"], np.int64))
                yield pa.RecordBatch.from_arrays([keys, pa.array(numbers), proofs.cast(_PROOF_ARROW)], ["key", "block", "proof"])

    chains = tops.select(F.struct("key", F.lit(0).cast("long").alias("block")).alias("at"), "proof")
    for level in levels[:0:-1]:
        above = _with_chains(level, chains).select("key", "block", "n", "height", "layout", "proof")
        made = above.mapInArrow(run, f"key {kind}, block long, proof {_PROOF}")
        chains = made.select(F.struct("key", "block").alias("at"), "proof")
    return _with_chains(levels[0], chains)


def _with_chains(level: DataFrame, chains: DataFrame) -> DataFrame:
    return level.withColumn("at", F.struct("key", "block")).join(chains, "at").drop("at")


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the order column, the group column, the columns of ``carry`` (expressions over ``docs``), leaf,
    subroot, root and proof, an array of what stands before and after the path's node in its run, level by level.

    The blocks are written to the shared folder: the group's trees, then the tree over the groups.
    """
    carry = carry or {}
    rows = docs.select(
        F.col(order).alias("order"), F.col(group).alias("key"), leaf_digest().alias("leaf"), *[v.alias(f"carry_{k}") for k, v in carry.items()]
    )
    leaves = numbered(rows, ["order", "leaf"], ["key"])
    trees = _raised(leaves, "merkle-rows")
    subroots = numbered(trees[-1].select("key", "root"), ["key"])
    above = _raised(subroots.select(F.lit(0).alias("key"), "number", F.col("root").alias("leaf")), "merkle-groups")
    top = above[-1].select("root").first()
    root = top["root"] if top else None
    start = docs.sparkSession.createDataFrame([(0, [])], f"key int, proof {_PROOF}")
    ways = _opened(subroots.select(F.lit(0).alias("key"), "number", F.struct("key", "root").alias("row")), _chained(above, start))
    ways = ways.select("row.key", F.col("row.root").alias("subroot"), "proof")
    chained = _chained(trees, ways.select("key", "proof"))
    opened = _opened(leaves.select("key", "number", F.struct(*[x for x in leaves.columns if x != "number"]).alias("row")), chained)
    names = ways.select(F.struct("key").alias("of"), "subroot")
    return (
        opened.withColumn("of", F.struct("row.key"))
        .join(names, "of")
        .select(
            F.col("row.order").alias(order), F.col("row.key").alias(group), *[F.col(f"row.carry_{k}").alias(k) for k in carry],
            "row.leaf", "subroot", F.lit(root).alias("root"), "proof",
        )
    )


def _opened(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(row, proof) of ``entries`` (key, number, row) by the blocks that hold them."""
    kind = entries.schema["row"].dataType.simpleString()

    def run(own, block):
        if not block.num_rows or not own.num_rows:
            return pa.Table.from_arrays([own.column("row").slice(0, 0), pa.array([], _PROOF_ARROW)], ["row", "proof"])
        places = (own.column("number").to_numpy() % BLOCK).tolist()
        has = block.select(["n", "height", "layout", "proof"]).to_pylist()[0]
        proofs = _proofs(has["layout"], has["n"], has["height"], places, has["proof"])
        return pa.Table.from_arrays([own.column("row"), proofs.cast(_PROOF_ARROW)], ["row", "proof"])

    a = entries.withColumn("block", F.floor(F.col("number") / BLOCK).cast("long"))
    return a.groupBy("key", "block").cogroup(blocks.groupBy("key", "block")).applyInArrow(run, f"row {kind}, proof {_PROOF}")


def proof_text(proof: Column) -> Column:
    """The siblings of a proof, level by level and from left to right, as one text."""
    return F.array_join(F.transform(proof, lambda x: F.concat(x["before"], x["after"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, x: digest(x["before"], node, x["after"]))
