"""Quality rules on repetition: maximal repeated substrings of a document, from the suffix array of its words.

Words are runs of characters other than blank, tab and line ends. In the suffix order of a document, the longest common
prefixes of neighbours form nested intervals; the innermost interval that holds a suffix gives the longest substring
that starts there and occurs again. The spans of those with at least ``min_words`` words are united. A document is kept if
they cover at most ``max_covered`` of its words and the longest has at most ``max_longest`` words.

Base counts come along: word_chars, n_symbols, n_dup_lines, n_repeat_words (words in 5-word windows that occur again),
and base_failed (fewer than 10 words, or more than a fifth of them repeated).

Many documents are ordered together; words of different documents never compare equal. Memory is bounded by
``batch_words`` and the longest document. Null texts have no words and fail. Repeated rows are judged alone. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewatch.llm.suffixes import common_prefixes, doubled_ranks

MIN_WORDS, MAX_COVERED, MAX_LONGEST = 8, 0.2, 100
BASE_WINDOW, LEAST_WORDS = 5, 10
BATCH_WORDS = 1 << 20
SYMBOLS = re.compile(r"[#*$%&|<>]")
BLANKS = " \t\n\x0b\x0c\r"

_FIELDS = [("doc_id", pa.int64())] + [
    (x, pa.int64()) for x in "n_words word_chars n_symbols n_dup_lines n_repeat_words covered_words longest_repeat".split()
]
_ARROW = pa.schema([*_FIELDS, ("base_failed", pa.bool_()), ("kept", pa.bool_())])
SCHEMA = ", ".join(f"{x} long" for x, _ in _FIELDS) + ", base_failed boolean, kept boolean"


def longest_repeats(words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest substring that starts there and occurs elsewhere in the same document.

    ``words`` are numbers of words, ``docs`` the rising number of the document of each place.
    """
    out = np.zeros(len(words), np.int64)
    if not len(words):
        return out
    # a doc's words sort before those of later docs; the place behind a document's end belongs to another one
    levels = list(doubled_ranks(docs * (int(words.max()) + 1) + words))
    rank = levels[-1][1]
    order = np.argsort(rank, kind="stable")
    left, right = order[:-1], order[1:]
    first = levels[0][1]
    may = np.flatnonzero(first[left] == first[right])
    left, right = left[may], right[may]
    common = common_prefixes(levels, left, right)
    np.maximum.at(out, left, common)
    np.maximum.at(out, right, common)
    return out


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def _lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def measured(texts: list[str], min_words: int, max_covered: float, max_longest: int) -> dict[str, list]:
    numbers: dict[bytes, int] = {}
    cut = [x.encode("utf-8", "replace").split() for x in texts]
    counts = np.array([len(x) for x in cut], np.int64)
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for words in cut for w in words), np.int64, int(counts.sum()))
    docs = np.repeat(np.arange(len(texts)), counts)
    repeats = longest_repeats(flat, docs)
    starts = np.cumsum(counts) - counts

    def total(values):
        return np.bincount(docs, values, minlength=len(texts)).astype(np.int64) if len(docs) else np.zeros(len(texts), np.int64)

    at = np.flatnonzero(repeats >= BASE_WINDOW)
    base = total(covered(at, np.full(len(at), BASE_WINDOW), len(flat)))
    at = np.flatnonzero(repeats >= min_words)
    spans = total(covered(at, repeats[at], len(flat)))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, docs, repeats)
    failed = (counts < LEAST_WORDS) | (100 * base > 20 * counts)
    kept = ~failed & (spans <= max_covered * counts) & (longest <= max_longest)
    return {
        "n_words": counts.tolist(),
        "word_chars": [len(x) - sum(map(x.count, BLANKS)) for x in texts],
        "n_symbols": [sum(map(x.count, "#*$%&|<>")) for x in texts],
        "n_dup_lines": [_lines(x) for x in texts],
        "n_repeat_words": base.tolist(),
        "covered_words": spans.tolist(),
        "longest_repeat": longest.tolist(),
        "base_failed": failed.tolist(),
        "kept": kept.tolist(),
    }


def repetition_rules(
    docs: DataFrame, min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
    batch_words: int = BATCH_WORDS,
) -> DataFrame:
    """One row per document: doc_id, the counts, covered_words and longest_repeat (the method's), base_failed, kept."""

    def run(batches):
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            texts = [x or "" for x in batch.column("text").to_pylist()]
            first, n = 0, 0
            for k, text in enumerate(texts):
                n += len(text) // 5
                if n >= batch_words or k == len(texts) - 1:
                    found = measured(texts[first : k + 1], min_words, max_covered, max_longest)
                    yield pa.RecordBatch.from_pydict({"doc_id": names[first : k + 1]} | found, _ARROW)
                    first, n = k + 1, 0

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
