"""As few sequences as possible: dominance reduction of a bin packing instance, then best fit for what it leaves.

Documents longer than a window are cut into windows, of which the first may be shorter. What is to be packed is then given
by how many pieces of each length there are: one number for each length up to the window, whatever the size of the corpus.

A set of pieces that holds piece j and fits a window dominates another one with j if each piece of the other, or each group of
its pieces, can be put in the place of a piece of the first that is at least as long. A set that dominates all sets with j
stands in some optimal packing, so it is fixed for good and taken out (``reduce``). Sets of up to three pieces are tried, j falling,
until none is left to be fixed; what holds for one set holds for its repetitions while their pieces last, so they are fixed
together. The remainder is packed by best fit, longest first (``best_fit``), again for all pieces of a length at once.

The plan, a few thousand runs of (length, rank) to (sequence, place), is made on the driver; pieces are ranked within their
length by counts per task, so no task sees more than its own rows.

Null texts are documents of the end id only. Equal rows are documents of their own, null ids are carried. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import tokens
from tradewatch.llm.common import stored
from tradewatch.operators.skew import running_sums

WINDOW = 1024
#: Ids of a record batch that a task hands on.
HELD_IDS = 1 << 20
#: Ranks within a length stay below this.
_RANKS = 1 << 48

Pattern = tuple[tuple[int, int], ...]


class _Sizes:
    """Lengths with how often they occur, in rising order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = Counter({s: n for s, n in counts.items() if n})
        self.sizes = sorted(self.counts)

    def add(self, size: int, n: int) -> None:
        self.counts[size] += n
        if not self.counts[size]:
            del self.counts[size]
            self.sizes.remove(size)
        elif self.counts[size] == n:
            self.sizes.insert(bisect_left(self.sizes, size), size)

    def longest(self, room: int) -> int | None:
        """The longest piece of at most ``room``."""
        k = bisect_right(self.sizes, room)
        return self.sizes[k - 1] if k else None

    def shortest(self, n: int, above: int = 0) -> list[int]:
        """The ``n`` shortest pieces longer than ``above``, or all if they are fewer."""
        out: list[int] = []
        for size in self.sizes[bisect_right(self.sizes, above) :]:
            out += [size] * min(self.counts[size], n - len(out))
            if len(out) == n:
                break
        return out

    def longest_pair(self, room: int) -> int:
        """The largest sum of two pieces that is at most ``room``, or 0."""
        best, high = 0, len(self.sizes) - 1
        for low, size in enumerate(self.sizes):
            while high >= low and size + self.sizes[high] > room:
                high -= 1
            if high < low:
                break
            k = high - 1 if high == low and self.counts[size] < 2 else high
            if k >= low:
                best = max(best, size + self.sizes[k])
        return best


def dominating(pieces: _Sizes, j: int, window: int) -> tuple[int, ...] | None:
    """A set with the piece ``j`` that dominates all others with it; ``pieces`` are those besides j."""
    room = window - j
    short = pieces.shortest(3)
    if not short or short[0] > room:
        return (j,)
    first = pieces.longest(room)
    if first == room or len(short) < 2 or short[0] + short[1] > room:
        return (j, first)  # it fills the window, or no second piece fits beside any
    if len(short) == 3 and sum(short) <= room:
        return None  # sets of four are not tried
    if first >= pieces.longest_pair(room):
        return (j, first)
    pieces.add(first, -1)
    second = pieces.longest(room - first)
    # any other two have one that is no longer than the second, unless two longer ones fit
    fixed = None
    if second is not None:
        others = pieces.shortest(2, above=second)
        if len(others) < 2 or sum(others) > room:
            fixed = (j, first, second)
    pieces.add(first, 1)
    return fixed


def reduce(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """(sets that are fixed with how often, counts of the lengths that are left)."""
    pieces, fixed = _Sizes(counts), []
    changed = True
    while changed:
        changed = False
        for j in reversed(list(pieces.sizes)):
            while pieces.counts[j]:
                pieces.add(j, -1)
                found = dominating(pieces, j, window)
                pieces.add(j, 1)
                if not found:
                    break
                own = Counter(found)
                times = min(pieces.counts[s] // n for s, n in own.items())
                for s, n in own.items():
                    pieces.add(s, -n * times)
                fixed.append((tuple(sorted(own.items(), reverse=True)), times))
                changed = True
    return fixed, dict(pieces.counts)


def best_fit(counts: dict[int, int], window: int = WINDOW) -> list[tuple[Pattern, int]]:
    """Sets and how often, as best fit deals the pieces out one by one, longest first."""
    open_: dict[int, list[tuple[Counter, int]]] = {}  # by room that is left

    def put(pattern: Counter, bins: int, size: int, times: int, room: int) -> None:
        if bins:
            grown = pattern.copy()
            if times:
                grown[size] += times
            open_.setdefault(room - size * times, []).append((grown, bins))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            room = min((r for r in open_ if r >= size), default=window)
            if room in open_:
                pattern, bins = open_[room].pop()
                if not open_[room]:
                    del open_[room]
            else:
                pattern, bins = Counter(), -(-n // (window // size))
            # a window that has taken a piece is the tightest one for the next, until it is full
            each = room // size
            full = min(bins, n // each)
            put(pattern, full, size, each, room)
            n -= full * each
            if full < bins:
                if n:
                    put(pattern, 1, size, n, room)
                    full, n = full + 1, 0
                if pattern:
                    put(pattern, bins - full, size, 0, room)
    return [(tuple(sorted(p.items(), reverse=True)), n) for own in open_.values() for p, n in own]


def least_windows(counts: dict[int, int], window: int = WINDOW) -> int:
    """A lower bound on the windows: for each k, pieces that share none, and the ids that do not fit beside them."""
    best = 0
    for k in [0, *(s for s in counts if 2 * s <= window)]:
        alone = sum(n for s, n in counts.items() if s > window - k)
        half = [(s, n) for s, n in counts.items() if window - k >= s > window / 2]
        small = sum(s * n for s, n in counts.items() if k <= s <= window / 2)
        bins, room = sum(n for _, n in half), sum((window - s) * n for s, n in half)
        best = max(best, alone + bins + max(0, -(-(small - room) // window)))
    return best


class Plan:
    """Where the piece of a length and rank goes, as runs in sorted arrays."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW):
        self.fixed, rest = reduce(counts, window)
        self.patterns = self.fixed + best_fit(rest, window)
        self.windows = sum(n for _, n in self.patterns)
        runs, taken, base = [], Counter(), 0
        for pattern, bins in self.patterns:
            offset = 0
            for size, each in pattern:
                runs.append((size * _RANKS + taken[size], each, base, offset))
                taken[size] += each * bins
                offset += size * each
            base += bins
        runs.sort()
        self.key, self.each, self.base, self.offset = np.array(runs, np.int64).reshape(-1, 4).T

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length * _RANKS + rank
        k = np.searchsorted(self.key, key, side="right") - 1
        within = key - self.key[k]
        return self.base[k] + within // self.each[k], self.offset[k] + within % self.each[k] * length


def pieces_of(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = (n - 1) % window + 1
    return [(0, first), *((at, window) for at in range(first, n, window))]


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    + [("task", pa.int64()), ("local_rank", pa.int64())]
)


def _cut(tokenizer: str, end_id: int, window: int):
    def run(batches):
        task, ranks = TaskContext.get().partitionId(), Counter()
        rows, held = [], 0

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encoded(texts, tokenizer, end_id), strict=True):
                for k, (start, length) in enumerate(pieces_of(len(ids) // 4, window)):
                    rows.append((doc_id, k, start, length, ids[4 * start : 4 * (start + length)], task, ranks[length]))
                    ranks[length] += 1
                    held += length
                if held >= HELD_IDS:
                    yield batch_of()
                    rows, held = [], 0
        if rows:
            yield batch_of()

    return run


def pack_few(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, piece, start (ids of its document before it), length, ids (binary, little-endian unsigned 32-bit),
    sequence_id and offset (its place there)."""
    schema = "doc_id long, piece int, start long, length long, ids binary, task long, local_rank long"
    pieces = stored(docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, end_id, window), schema), "pieces")
    counts = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    plan = Plan({x["length"]: x["n"] for x in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, window)
    before = running_sums(counts, ["length"], "task", ["n"]).select("length", "task", (F.col("run_n") - F.col("n")).alias("before"))
    sent = docs.sparkSession.sparkContext.broadcast(plan)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = sent.value.places(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = pieces.join(before, ["length", "task"]).withColumn("at", place("length", F.col("local_rank") + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "at.sequence_id", "at.offset")
