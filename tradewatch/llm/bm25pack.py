"""Windows of related documents by lexical retrieval: a BM25 index returns unused neighbours, which fill a window.

Documents are dealt to index shards by a hash, and a shard is indexed once it holds ``shard_ids`` token ids: memory is
bounded and no shard needs another one. Full windows of a long document stand alone. What is left of each document is
indexed by its token ids. A seed (the longest unused rest) asks the index with its ``query_terms`` most telling ids; all
unused documents that share one of them follow by falling score and fill the seed's window. The document that does
not fit is cut; its other part seeds the next window. Where no neighbour is left, the next seed takes the room, so at
most one window of a shard stays unfilled. That one is cut at powers of two, which need no padding.

Null texts are documents of the end id only. Equal rows are documents of their own. Documents of any length are cut, not
dropped. An empty table gives no rows. Null ids are carried. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import tokens

WINDOW = 2048
SHARD_IDS = 1 << 22
QUERY_TERMS = 16
#: Chunks that the encoder keeps beside a shard, and where no earlier stage has left its workers' memory behind.
KEPT_CHUNKS, KEPT_ALONE = 450_000, 900_000
K1, B = 1.2, 0.75
#: Sequence ids of a partition begin at a multiple of this.
SEQUENCES = 1 << 36

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, seed boolean"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64())] + [(x, pa.int64()) for x in "start length ids_crc32 doc_tokens sequence_id offset".split()]
    + [("seed", pa.bool_())]
)


class Bm25Index:
    """Postings of a shard: for each term the documents that hold it, with their weights."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        lengths = np.array([len(x) for x in docs], np.int64)
        self.size = n
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
        terms = np.concatenate(docs).astype(np.int64) if n else np.zeros(0, np.int64)
        pairs, tf = np.unique(terms * max(n, 1) + owner, return_counts=True)
        self.term, self.doc = pairs // max(n, 1), (pairs % max(n, 1)).astype(np.int64)
        self.terms, first, df = np.unique(self.term, return_index=True, return_counts=True)
        self.first, self.df = first, df
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        mean = lengths.mean() if n else 1.0
        at = np.repeat(np.arange(len(df)), df)
        self.weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.doc] / mean))
        # each document's most telling terms, those of the largest weight that another document has as well
        useful = np.flatnonzero(df[at] > 1)
        order = useful[np.lexsort((at[useful], -self.weight[useful], self.doc[useful]))]
        self.query_terms = at[order]
        self.query_first = np.searchsorted(self.doc[order], np.arange(n + 1))

    def neighbours(self, doc: int, unused: np.ndarray, query_terms: int = QUERY_TERMS) -> np.ndarray:
        """Unused documents that share a query term with ``doc``, by falling score, ties by number."""
        a, b = self.query_first[doc], self.query_first[doc + 1]
        places = [slice(self.first[t], self.first[t] + self.df[t]) for t in self.query_terms[a : min(b, a + query_terms)]]
        if not places:
            return np.zeros(0, np.int64)
        docs = np.concatenate([self.doc[x] for x in places])
        score = np.bincount(docs, np.concatenate([self.weight[x] for x in places]), minlength=self.size)
        found = np.flatnonzero((score > 0) & unused)
        return found[np.argsort(-score[found], kind="stable")]


def pack(lengths: np.ndarray, ids: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every id of the documents once. The first of a sequence is its seed."""
    sequences: list[list[tuple[int, int, int]]] = []
    for doc, n in enumerate(lengths.tolist()):
        sequences += [[(doc, at, window)] for at in range(0, n - window + 1, window)]
    rest = lengths % window
    docs = np.flatnonzero(rest)
    index = Bm25Index([ids[d][lengths[d] - rest[d] :] for d in docs.tolist()])
    unused = np.ones(len(docs), bool)
    seeds = iter(np.argsort(-rest[docs], kind="stable").tolist())
    current: list[tuple[int, int, int]] = []
    room, left = window, None

    def put(doc: int, start: int, length: int):
        """Fill the window; what does not fit is handed back as (document, start, length)."""
        nonlocal current, room
        took = min(length, room)
        current.append((doc, start, took))
        room -= took
        if not room:
            sequences.append(current)
            current, room = [], window
        return (doc, start + took, length - took) if took < length else None

    def rest_of(k: int):
        doc = int(docs[k])
        return doc, int(lengths[doc] - rest[doc]), int(rest[doc])

    while True:
        if left is not None:  # the cut document seeds this window
            seed, piece = left
        else:
            seed = next((k for k in seeds if unused[k]), None)
            if seed is None:
                break
            unused[seed] = False
            piece = rest_of(seed)
        left, over = None, put(*piece)
        if over:
            left = (seed, over)
            continue
        for k in index.neighbours(seed, unused).tolist() if current else ():
            unused[k] = False
            if over := put(*rest_of(k)):
                left = (k, over)
            if not current or over:
                break
    if current:
        sequences += _powers(current, window - room)
    return sequences


def _powers(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """The pieces of an unfilled window as sequences whose lengths are powers of two."""
    out: list[list[tuple[int, int, int]]] = []
    queue = pieces[::-1]
    while total:
        size = room = 1 << (total.bit_length() - 1)
        total -= size
        own = []
        while room:
            doc, start, length = queue.pop()
            took = min(room, length)
            own.append((doc, start, took))
            room -= took
            if took < length:
                queue.append((doc, start + took, length - took))
        out.append(own)
    return out


def _packed(tokenizer: str, end_id: int, window: int, shard_ids: int, kept: int, together: bool):
    def run(batches):
        sequence = TaskContext.get().partitionId() * SEQUENCES
        names, held, n = [], [], 0

        def rows():
            nonlocal sequence
            ids = [np.frombuffer(x, "<u4") for x in held]
            out = {x: [] for x in _ARROW.names}
            for pieces in pack(np.array([len(x) for x in ids], np.int64), ids, window):
                offset = 0
                for k, (doc, start, length) in enumerate(pieces):
                    crc = zlib.crc32(held[doc][4 * start : 4 * (start + length)])
                    for key, value in zip(out, (names[doc], start, length, crc, len(ids[doc]), sequence, offset, k == 0), strict=True):
                        out[key].append(value)
                    offset += length
                sequence += 1
            return pa.RecordBatch.from_pydict(out, _ARROW)

        for batch in batches:
            texts = batch.column("text")
            found = tokens.encoded(texts if together else texts.to_pylist(), tokenizer, end_id, kept)
            for name, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                names.append(name)
                held.append(ids)
                n += len(ids) // 4
                if n >= shard_ids:
                    yield rows()
                    names, held, n = [], [], 0
        if held:
            yield rows()

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, shard_ids: int = SHARD_IDS, kept: int = KEPT_CHUNKS,
    together: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it), length, ids_crc32, doc_tokens, sequence_id, offset,
    seed (whether it seeded its window). ``kept`` bounds the encoder's chunks of a generation, which changes nothing but time; so does
    ``together``, by which equal chunks of many texts are looked up once, at the cost of some memory."""
    return (
        docs.select("doc_id", "text")
        .withColumn("_deal", F.xxhash64("doc_id", "text", F.monotonically_increasing_id()))
        .repartition("_deal")
        .sortWithinPartitions("_deal")
        .select("doc_id", "text")
        .mapInArrow(_packed(tokenizer, end_id, window, shard_ids, kept, together), SCHEMA)
    )
