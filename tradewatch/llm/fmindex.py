"""Benchmark decontamination: an FM-index of each training shard is searched for the benchmark's word windows.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z in lower case. A window is
``window`` consecutive words of a benchmark item; an item of fewer words is one window. A document word inside any
occurrence is hit; a document is contaminated if at least ``least`` of its words are hit (and one is).

Shards are runs of rows of a partition with about ``shard_words`` words, so no shuffle is needed. Words that the windows
do not use become separators, and runs of other words that are shorter than every window cannot hold one and are left
out; this loses nothing. What is left is indexed: suffix array, its Burrows-Wheeler transform in a wavelet matrix, and
every ``sample``-th position. All windows step backwards together; occurrences are located by walking to a sampled position.

The benchmark is read partition by partition and its windows are sent to the executors in blocks of at most ``block_windows``, as flat
arrays; an item that does not fit goes on in the next block. More windows mean more passes over the documents.

Null texts have no words and are not contaminated; null or wordless items have no window. Repeated rows are judged
alone; repeated items count once by their id. Empty tables give no rows, or rows without hits. Other columns are not read.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import ROW, carried, ranges, schema_of
from tradewatch.llm.suffixes import WaveletMatrix, suffix_array

WINDOW = 13
LEAST_SHARE = 20
SHARD_WORDS = 1 << 21
SAMPLE = 8
BLOCK_WINDOWS = 1 << 19
#: A word of the text as it is written, capitals included.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TABLE = bytes(
    x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256)
)
SCHEMA = "doc_id long, _row long, n_words long, spans array<struct<first: long, last: long>>, removal array<struct<start: long, stop: long>>, items array<long>"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_REMOVAL = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("_row", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS), ("removal", _REMOVAL)]
    + [("items", pa.list_(pa.int64()))]
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


class FmIndex:
    """Counts and places of patterns in a sequence of symbols (1 to ``top``; 0 ends the sequence)."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = SAMPLE):
        text = np.concatenate([symbols, [0]]).astype(np.int64)
        self.n = len(text)
        places = suffix_array(text)
        bwt = text[places - 1]
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.bwt = bwt
        self.tree = WaveletMatrix(bwt, max(1, top.bit_length()))
        self.sampled = places % sample == 0
        self.sampled_before = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = places[self.sampled]

    def intervals(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix array that begin with each pattern (a row of ``patterns``, filled up with zeros)."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        alive = np.arange(len(lengths))
        for back in range(int(lengths.max(initial=0))):
            alive = alive[(lengths[alive] > back) & (low[alive] < high[alive])]
            symbol = patterns[alive, lengths[alive] - 1 - back].astype(np.int64)
            start = self.below[symbol]
            low[alive] = start + self.tree.rank(symbol, low[alive])
            high[alive] = start + self.tree.rank(symbol, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of rows of the suffix array."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            at = rows[todo]
            done = self.sampled[at]
            ready = todo[done]
            out[ready] = self.samples[self.sampled_before[at[done]]] + steps[ready]
            todo, at = todo[~done], at[~done]
            symbol = self.bwt[at]
            rows[todo] = self.below[symbol] + self.tree.rank(symbol, at)
            steps[todo] += 1
        return out


class Windows:
    """The distinct windows of a block of pieces (item, words), as numbers of their words, and whose they are: flat arrays."""

    def __init__(self, pieces: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [item for item, _ in pieces]
        rows = [np.zeros((0, window), np.int32)]
        for _, words in pieces:
            given = (self.vocabulary.setdefault(x, len(self.vocabulary) + 2) for x in words)
            numbers = np.zeros(max(window, len(words)), np.int32)
            numbers[: len(words)] = np.fromiter(given, np.int32, len(words))
            rows.append(np.lib.stride_tricks.sliding_window_view(numbers, window))
        owner = np.repeat(np.arange(len(pieces)), [len(x) for x in rows[1:]]) if pieces else np.zeros(0, np.int64)
        every = np.concatenate(rows)
        # equal rows are equal as strings of bytes
        _, first, which = np.unique(every.view(np.dtype((np.void, 4 * window))).ravel(), return_index=True, return_inverse=True)
        self.patterns = every[first]
        self.lengths = (self.patterns > 0).sum(1)
        # the pieces of each window, window by window
        pairs = np.unique(which * max(1, len(pieces)) + owner)
        self.owner = (pairs % max(1, len(pieces))).astype(np.int32)
        self.starts = np.searchsorted(pairs // max(1, len(pieces)), np.arange(len(first) + 1))
        self.shortest = int(self.lengths.min(initial=window))

    def items_of(self, which: np.ndarray) -> set[int | None]:
        """The items that any of the windows belongs to."""
        which = np.unique(which)
        places, _ = ranges(self.starts[which], self.starts[which + 1] - self.starts[which])
        return {self.names[x] for x in np.unique(self.owner[places]).tolist()}

    def occurrences(self, numbers: np.ndarray, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence in a sequence of word numbers, 0 for other words."""
        edge = np.diff(np.concatenate([[0], (numbers > 0).astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - begins >= self.shortest
        begins, lengths = begins[long], (ends - begins)[long]
        if not len(begins) or not len(self.lengths):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # the runs one after the other, each with the separator behind it
        owner = np.repeat(np.arange(len(begins)), lengths + 1)
        inner = np.arange(len(owner)) - (np.cumsum(lengths + 1) - lengths - 1)[owner]
        origin = begins[owner] + inner
        text = np.where(inner < lengths[owner], numbers[np.minimum(origin, len(numbers) - 1)], 1)
        index = FmIndex(text, len(self.vocabulary) + 1, sample)
        low, high = index.intervals(self.patterns, self.lengths)
        counts = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(len(which)) - (np.cumsum(counts) - counts)[which] + low[which]
        return which, origin[index.locate(rows)]


def blocks_of(items, window: int = WINDOW, most: int = BLOCK_WINDOWS):
    """Blocks of pieces (item, words) of (item, text) rows with at most ``most`` windows; an item may go on in the next block."""
    block, room = [], most
    for item, text in items:
        words = words_of(text)
        total = max(1, len(words) - window + 1) if words else 0
        done = 0
        while done < total:
            n = min(room, total - done)
            block.append((item, words[done : done + n + window - 1]))
            done, room = done + n, room - n
            if not room:
                yield block
                block, room = [], most
    if block:
        yield block


def _union(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint runs (last exclusive) that cover the same places."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return list(zip(first[new].tolist(), reach[np.append(new[1:] - 1, len(reach) - 1)].tolist(), strict=True))


def _searched(windows, sample: int, shard_words: int, carry: bool):
    def run(batches):
        block = windows.value
        known = block.vocabulary.get
        names, rows, texts, numbers, counts, n, whole = [], [], [], [], [], 0, []

        def judged():
            flat = np.concatenate(numbers)
            starts = np.cumsum([0, *[x + 1 for x in counts]])
            which, at = block.occurrences(flat, sample)
            doc = np.searchsorted(starts, at, "right") - 1
            order = np.lexsort((at, doc))
            which, at, doc = which[order], at[order], doc[order]
            bounds = np.searchsorted(doc, np.arange(len(counts) + 1))
            out = {"doc_id": names, "_row": rows, "n_words": counts, "spans": [], "removal": [], "items": []}
            for k in range(len(counts)):
                a, b = bounds[k], bounds[k + 1]
                first = at[a:b] - starts[k]
                spans = _union(first, first + block.lengths[which[a:b]]) if b > a else []
                out["spans"].append([{"first": x, "last": y} for x, y in spans])
                places = [m.span() for m in WORD.finditer(texts[k])] if spans else []
                out["removal"].append([{"start": places[x][0], "stop": places[y - 1][1]} for x, y in spans])
                out["items"].append(sorted(block.items_of(which[a:b]), key=lambda x: (x is None, x or 0)))
            found = pa.RecordBatch.from_pydict(out, _ARROW)
            return found.append_column(ROW, pa.concat_arrays(whole)) if carry else found

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("doc_id", "_row", "text")]
            for k, (name, row, text) in enumerate(zip(*columns, strict=True)):
                if carry:
                    whole.append(batch.column(ROW).slice(k, 1))
                words = words_of(text)
                names.append(name)
                rows.append(row)
                texts.append(text or "")
                counts.append(len(words))
                own = np.zeros(len(words) + 1, np.int64)
                own[:-1] = np.fromiter(map(known, words, repeat(0)), np.int64, len(words))
                numbers.append(own)
                n += len(words)
                if n >= shard_words:
                    yield judged()
                    names, rows, texts, numbers, counts, n, whole = [], [], [], [], [], 0, []
        if names:
            yield judged()

    return run


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, sample: int = SAMPLE,
    block_windows: int = BLOCK_WINDOWS, carry: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, spans (hit words, last exclusive), removal (the same in code points), items
    and, with ``carry``, the row itself as a struct."""
    spark = docs.sparkSession
    rows = carried(docs, ["doc_id", "text"], carry).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.select("doc_id", "text", "_row", *[ROW] * carry)
    found = []
    items = benchmark.select("item_id", "text").toLocalIterator()
    for block in blocks_of(items, window, block_windows):
        windows = spark.sparkContext.broadcast(Windows(block, window))
        found.append(rows.mapInArrow(_searched(windows, sample, shard_words, carry), schema_of(SCHEMA, docs, carry)))
    if not found:
        windows = spark.sparkContext.broadcast(Windows([], window))
        found.append(rows.mapInArrow(_searched(windows, sample, shard_words, carry), schema_of(SCHEMA, docs, carry)))
    if len(found) == 1:
        return found[0].drop("_row")
    together = found[0]
    for other in found[1:]:
        together = together.unionAll(other)
    once = [F.first(x).alias(x) for x in ("doc_id", "n_words", *[ROW] * carry)]
    flat = [F.flatten(F.collect_list(x)).alias(x) for x in ("spans", "removal", "items")]
    return together.groupBy("_row").agg(*once, *flat).drop("_row")


def judged(found: DataFrame, least: int = LEAST_SHARE) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated (``least * n_hit >= n_words``) to what ``find_benchmark`` gives."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    hit = F.aggregate(
        F.array_sort("spans"),
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["last"] - F.greatest(acc["end"], x["first"]))).alias("n"),
            F.greatest(acc["end"], x["last"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    names = F.array_sort(F.transform(F.array_distinct("items"), lambda x: x.cast("string")))
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size(F.array_distinct("items")).cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", names).cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * least >= F.col("n_words")))
    )
