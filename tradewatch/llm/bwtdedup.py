"""Repeated substrings by a Burrows-Wheeler transform: threshold-bounded interval expansion, breadth first.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same document or another one.
Strings do not cross documents and are judged on the input.

How the corpus is divided: every string of ``length`` bytes belongs to its anchor (``anchors``), and neighbours with one anchor
form a context, the bytes they cover. Equal strings have equal anchors, so the contexts of an anchor can be judged
without the rest of the corpus. Contexts of which nothing occurs twice by its anchor's hash go no further; equal
contexts are ordered once, with a mark that there are more. Contexts of many anchors are put together, sorted by suffixes, and
expanded: the intervals of strings of 8 bytes are extended backwards, one byte at a time, all intervals of a length at once. An
interval whose right end is new ends a run of suffixes that agree on no more bytes than its length so far; so common prefixes come out by
rising value, and expansion stops at ``length``: an interval that is left has one string, which repeats if the interval has
two suffixes or its suffix stands for several equal contexts.

An anchor with more than ``most_contexts`` different contexts (a passage that very many documents share) is divided again. Its
strings fall into classes by how far the anchor stands from their start, ``CLASS`` distances to a class, and by the bytes that all
strings of a class have in common. Classes are judged like anchors. One that is still too large, because the few bytes around
its common ones differ that often, is not ordered: the 128-bit hashes of its strings are counted, which is exact and needs no group.

Null texts are empty. Texts shorter than ``length`` keep all. Repeated rows are documents of their own and so repeat each
other. An empty table gives no rows. Ids may be null or occur several times. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.anchors import anchor_place, anchors
from tradewatch.llm.common import ranges, stored
from tradewatch.llm.suffixes import suffix_array

LENGTH = 200
MOST_CONTEXTS = 1024
CLASS = 8
#: Bytes of contexts that are sorted together.
BATCH_BYTES = 1 << 18
#: Intervals with more suffixes than this ask for the places of each byte instead of listing their suffixes.
LISTED = 4096
_FIRST = 8


def repeated(texts: list[bytes], length: int = LENGTH, several: list[bool] | None = None) -> list[np.ndarray]:
    """For each text, whether the string of ``length`` bytes at each of its places occurs at another place of the texts.

    ``several`` says which texts stand for several equal ones.
    """
    sizes = np.array([len(x) for x in texts], np.int64) + 1
    # bytes of UTF-8 are at most 0xF4: shifted by one, 0 is free for the end and 255 for the border of two texts
    data = np.frombuffer(b"\xfe".join(texts) + b"\xfe", np.uint8) + np.uint8(1)
    data = np.append(data, np.uint8(0))
    n = len(data)
    key = np.concatenate([data, np.zeros(_FIRST, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        key = (key[:-step] << np.uint64(8 * step)) | key[step:]
    key = key[:n]
    places = suffix_array(key, _FIRST, length)
    bwt = data[places - 1]
    below = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=256))])
    origin = np.argsort(bwt, kind="stable")  # where the k-th suffix goes when its first byte is taken away
    target = np.empty(n, np.int64)
    target[origin] = np.arange(n)  # where a suffix goes when the byte before it is put in front
    reached = np.zeros(n + 1, bool)
    reached[0] = reached[n] = True
    sorted_key = key[places]
    reached[1:n] |= sorted_key[1:] != sorted_key[:-1]
    bounds = np.flatnonzero(reached)
    low, high = bounds[:-1], bounds[1:]
    for _ in range(_FIRST, length):
        low, high = _extended(low, high, bwt, below, origin, target)
        new = ~reached[high]
        low, high = low[new], high[new]
        reached[high] = True
        if not len(low):
            break
    twice = np.empty(n, bool)
    twice[places] = ~reached[:n] | ~reached[1:]
    if several:
        twice[: n - 1] |= np.repeat(np.array(several, bool), sizes)
    out, at = [], 0
    for size in sizes.tolist():
        out.append(twice[at : at + max(0, size - length)])
        at += size
    return out


def _extended(low, high, bwt, below, origin, target):
    """The intervals of all strings that put one byte before the strings of the given intervals."""
    sizes = high - low
    many = sizes > LISTED
    a, b = low[~many], high[~many]
    at, owner = ranges(a, b - a)
    byte, to = bwt[at], target[at]
    begins = (to == below[byte]) | (origin[to - 1] < a[owner])
    ends = (to + 1 == below[byte.astype(np.int64) + 1]) | (origin[np.minimum(to + 1, len(origin) - 1)] >= b[owner])
    lows, highs = [np.sort(to[begins])], [np.sort(to[ends]) + 1]
    for x, y in zip(low[many].tolist(), high[many].tolist(), strict=True):
        for byte in np.flatnonzero(np.diff(below)).tolist():
            own = origin[below[byte] : below[byte + 1]]
            first, last = np.searchsorted(own, [x, y])
            if first < last:
                lows.append([below[byte] + first])
                highs.append([below[byte] + last])
    return np.concatenate(lows).astype(np.int64), np.concatenate(highs).astype(np.int64)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true begin and end (exclusive)."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _anchored(length: int):
    schema = pa.schema([("_row", pa.int64())] + [(x, pa.list_(t)) for x, t in (("h", pa.int64()), ("c", pa.int64()), ("first", pa.int32()), ("n", pa.int32()))])

    def run(batches):
        from xxhash import xxh64_intdigest

        for batch in batches:
            out = {x: [] for x in schema.names}
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "replace")
                first, last, hashes = anchors(np.frombuffer(data, np.uint8), length)
                if not len(first):
                    continue
                marks = [xxh64_intdigest(data[a : b + length], 7) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                for key, value in zip(out, (row, hashes.view(np.int64), np.array(marks, np.uint64).view(np.int64), first, last - first + 1), strict=True):
                    out[key].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    return run


def _cut(length: int):
    """The bytes of the wanted contexts of a text."""

    def run(batches):
        for batch in batches:
            out = {"h": [], "c": [], "twice": [], "shared": [], "context": []}
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                for x in wanted:
                    for key in ("h", "c", "twice", "shared"):
                        out[key].append(x[key])
                    out["context"].append(data[x["first"] : x["first"] + x["n"] + length - 1])
            yield pa.RecordBatch.from_pydict(out, _CONTEXTS)

    return run


_CONTEXTS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("twice", pa.bool_()), ("shared", pa.bool_()), ("context", pa.binary())])
_MARKS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
MARKS = "h long, c long, begins array<int>, ends array<int>"


def _expanded(length: int, batch_bytes: int):
    """Marks of contexts that come sorted by anchor; an anchor's contexts stay together."""

    def run(batches):
        names, texts, held = [], [], 0

        def marked():
            flags = repeated([x for x, _ in texts], length, [twice for _, twice in texts])
            out = {x: [] for x in _MARKS.names}
            for (h, c), flag in zip(names, flags, strict=True):
                begins, ends = runs(flag)
                if len(begins):
                    for key, value in zip(out, (h, c, begins, ends), strict=True):
                        out[key].append(value)
            return pa.RecordBatch.from_pydict(out, _MARKS)

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("h", "c", "twice", "context")]
            for h, c, twice, context in zip(*columns, strict=True):
                if held >= batch_bytes and h != names[-1][0]:
                    yield marked()
                    names, texts, held = [], [], 0
                names.append((h, c))
                texts.append((context, twice))
                held += len(context)
        if names:
            yield marked()

    return run


def _classes(length: int):
    """The parts of a context that hold the strings of one class each."""
    schema = pa.schema([(x, pa.int64()) for x in ("h", "c")] + [("at", pa.int32())] + [(x, pa.int64()) for x in ("h2", "c2", "copies")] + [("part", pa.binary())])

    def run(batches):
        from xxhash import xxh64_intdigest

        def signed(x):
            return x - (1 << 64) if x >> 63 else x

        for batch in batches:
            out = {x: [] for x in schema.names}
            for h, c, twice, context in zip(*[batch.column(x).to_pylist() for x in ("h", "c", "twice", "context")], strict=True):
                n, place = len(context) - length + 1, anchor_place(np.frombuffer(context, np.uint8), length)
                for number in range((place - n + 1) // CLASS, place // CLASS + 1):
                    near, far = number * CLASS, (number + 1) * CLASS - 1
                    first, last = max(0, place - far), min(n - 1, place - near)
                    common = context[place - near : place - far + length]
                    part = context[first : last + length]
                    key = xxh64_intdigest(f"{h} {number} ".encode() + common, 11)
                    for name, value in zip(out, (h, c, first, signed(key), signed(xxh64_intdigest(part, 7)), 1 + twice, part), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    return run


def _strings(length: int):
    """The 128-bit hash of every string of a context."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("h", pa.int64()), ("c", pa.int64()), ("at", pa.int32()), ("copies", pa.int64())])

    def run(batches):
        from xxhash import xxh3_128_digest

        for batch in batches:
            for h, c, twice, context in zip(*[batch.column(x).to_pylist() for x in ("h", "c", "twice", "context")], strict=True):
                n = len(context) - length + 1
                pairs = np.frombuffer(b"".join([xxh3_128_digest(context[k : k + length]) for k in range(n)]), "<i8").reshape(n, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array([h] * n, pa.int64()), pa.array([c] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array([1 + twice] * n, pa.int64())],
                    schema=schema,
                )

    return run


def _removed(length: int, with_kept: bool):
    def run(batches):
        for batch in batches:
            out = {x: [] for x in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept)}
            for doc_id, text, begins, ends in zip(*[batch.column(x).to_pylist() for x in ("doc_id", "text", "begins", "ends")], strict=True):
                data = (text or "").encode("utf-8", "replace")
                change = np.zeros(len(data) + 1, np.int64)
                if begins:
                    np.add.at(change, np.array(begins, np.int64), 1)
                    np.add.at(change, np.array(ends, np.int64) + length - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                values = (doc_id, len(data), int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(kept).hexdigest(), *[kept] * with_kept)
                for key, value in zip(out, values, strict=True):
                    out[key].append(value)
            types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_kept
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out.values(), types, strict=True)], names=list(out))

    return run


def _judged(contexts: DataFrame, length: int, batch_bytes: int) -> DataFrame:
    return contexts.repartition("h").sortWithinPartitions("h", "c").select("h", "c", "twice", "context").mapInArrow(_expanded(length, batch_bytes), MARKS)


def _moved(by: str):
    return [F.transform(x, lambda k: k + F.col(by)).alias(x) for x in ("begins", "ends")]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, most_contexts: int = MOST_CONTEXTS, batch_bytes: int = BATCH_BYTES, with_kept: bool = True
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the bytes that stay."""
    rows = docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    found = rows.select("_row", "text").mapInArrow(_anchored(length), "_row long, h array<long>, c array<long>, first array<int>, n array<int>")
    found = stored(found, "anchors")
    flat = found.select("_row", F.explode(F.arrays_zip("h", "c", "first", "n")).alias("x")).select("_row", "x.*")
    # a table of its own, so that the join has two exchanges and can split an anchor that very many places share
    often = stored(flat.groupBy("h").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1").select("h"), "anchors-often")
    again = stored(flat.join(often, "h"), "anchors-again")
    # the sum with zero makes a key of its own, so that copies are counted before they are shuffled
    contexts = (
        again.groupBy("c", (F.col("h") + F.lit(0)).alias("h"))
        .agg((F.count(F.lit(1)) > 1).alias("twice"), F.min(F.struct("_row", "first", "n")).alias("at"))
    )
    contexts = stored(contexts, "contexts")
    shared = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > most_contexts).select("h", F.lit(True).alias("shared"))
    shared = stored(shared, "anchors-shared")
    wanted = contexts.join(shared, "h", "left").select(
        F.col("at._row").alias("_row"),
        F.struct("h", "c", "twice", F.coalesce("shared", F.lit(False)).alias("shared"), "at.first", "at.n").alias("x"),
    )
    texts = rows.join(wanted.groupBy("_row").agg(F.collect_list("x").alias("wanted")), "_row").select("text", "wanted")
    cut = stored(texts.mapInArrow(_cut(length), "h long, c long, twice boolean, shared boolean, context binary"), "context-bytes")
    marks = _judged(cut.where("not shared"), length, batch_bytes)
    classes = cut.where("shared").mapInArrow(_classes(length), "h long, c long, at int, h2 long, c2 long, copies long, part binary")
    classes = stored(classes, "context-classes")
    parts = classes.groupBy("h2", "c2").agg((F.sum("copies") > 1).alias("twice"), F.first("part").alias("context"))
    parts = stored(parts.select(F.col("h2").alias("h"), F.col("c2").alias("c"), "twice", "context"), "class-parts")
    sizes = parts.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max("twice").alias("any")).where("k > 1 or any").select("h", "k")
    parts = parts.join(stored(sizes, "class-sizes"), "h")
    within = _judged(parts.where(F.col("k") <= most_contexts), length, batch_bytes)
    strings = parts.where(F.col("k") > most_contexts).mapInArrow(_strings(length), "u long, v long, h long, c long, at int, copies long")
    strings = stored(strings, "shared-strings")
    often = stored(strings.groupBy("u", "v").agg(F.sum("copies").alias("seen")).where("seen > 1").select("u", "v"), "strings-again")
    counted = strings.join(often, ["u", "v"]).groupBy("h", "c").agg(F.collect_list("at").alias("begins"))
    counted = counted.select("h", "c", "begins", F.transform("begins", lambda x: x + 1).alias("ends"))
    within = stored(within.unionAll(counted), "class-marks").select(F.col("h").alias("h2"), F.col("c").alias("c2"), "begins", "ends")
    moved = classes.select("h", "c", "at", "h2", "c2").join(within, ["h2", "c2"])
    marks = stored(marks.unionAll(moved.select("h", "c", *_moved("at"))), "repeat-marks")
    spans = (
        again.join(marks, ["h", "c"])
        .select("_row", *_moved("first"))
        .groupBy("_row")
        .agg(F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends"))
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return rows.join(spans, "_row", "left").select("doc_id", "text", "begins", "ends").mapInArrow(_removed(length, with_kept), schema)
