import hashlib
import pickle
import random
import tracemalloc
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.rows import LONG, ODD_TEXTS, frame
from tests.oracle import connect, duck_rows, rows_of
from tradewatch.llm import queries
from tradewatch.llm.anchors import anchors
from tradewatch.llm.bwtdedup import remove_repeats, repeated
from tradewatch.llm.fmindex import BLOCK_WINDOWS, FmIndex, WaveletMatrix, Windows, blocks_of, find_benchmark, judged, words_of
from tradewatch.llm.suffixes import common_prefixes, doubled_ranks, suffix_array
from tradewatch.llm.suffixrules import measured, repetition_rules

SMALL = st.lists(st.integers(1, 3), max_size=40)


@settings(max_examples=200, deadline=None)
@given(SMALL)
def test_suffix_order_and_common_prefixes(symbols):
    text = np.array(symbols, np.int64)
    expected = sorted(range(len(symbols)), key=lambda k: symbols[k:])
    order = suffix_array(text)
    assert order.tolist() == expected
    if len(symbols) > 1:
        common = common_prefixes(list(doubled_ranks(text)), order[:-1], order[1:])
        for a, b, n in zip(order, order[1:], common, strict=False):
            x, y = symbols[a:], symbols[b:]
            assert n == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=40), st.integers(0, 9), st.integers(0, 40))
def test_wavelet_rank(symbols, symbol, end):
    tree = WaveletMatrix(np.array(symbols, np.int64), 4)
    end = min(end, len(symbols))
    assert tree.rank(np.array([symbol]), np.array([end])).tolist() == [symbols[:end].count(symbol)]


@settings(max_examples=200, deadline=None)
@given(SMALL, st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_backward_search_locates_all(symbols, pattern):
    index = FmIndex(np.array(symbols, np.int64), 4, sample=3)
    padded = np.array([[*pattern, 0, 0]])
    low, high = index.intervals(padded, np.array([len(pattern)]))
    found = index.locate(np.arange(low[0], high[0])) if high[0] > low[0] else []
    assert sorted(found) == [k for k in range(len(symbols)) if symbols[k : k + len(pattern)] == pattern]


def brute_benchmark(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for _, text in docs:
        w, hit, found = words_of(text), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if own := wins.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= own
        names = ",".join(sorted(map(str, found)))
        out.append((len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_windows", [1 << 19, 7])
def test_benchmark_against_brute_force(spark, block_windows):
    random.seed(5)
    words = [f"w{k}" for k in range(12)] + ["Éa", "b1"]
    texts = [" ".join(random.choices(words, k=random.randrange(0, 60))) for _ in range(30)] + ODD_TEXTS
    items = [(k, " ".join(random.choices(words, k=random.choice([0, 2, 3, 5, 14, 20])))) for k in range(8)]
    items += [(8, texts[3]), (8, texts[3]), (9, texts[4].upper()), (10, None), (11, ODD_TEXTS[0]), (12, "QUICK, brown")]
    texts[12] = texts[3].upper() + " A B " + texts[11].upper()
    docs = [(k % 35, x) for k, x in enumerate(texts)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = judged(find_benchmark(frame(spark, docs), bench, shard_words=100, sample=4, block_windows=block_windows)).collect()
    got = [(x["doc_id"], x["n_words"], x["n_hit"], x["n_items"], x["items_sha256"], x["contaminated"]) for x in found]
    want = [(d, *x) for (d, _), x in zip(docs, brute_benchmark(docs, items), strict=True)]
    assert sorted(got) == sorted(want)
    for x in found:  # removal spans are the hit words of the text
        text = next(t for d, t in docs if d == x["doc_id"] and len(words_of(t)) == x["n_words"]) if x["removal"] else None
        if block_windows > 1000 and text and sum(d == x["doc_id"] for d, _ in docs) == 1:
            cut = "".join(text[a["start"] : a["stop"]] + " " for a in x["removal"])
            assert len(words_of(cut)) == x["n_hit"]


def test_benchmark_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [x["contaminated"] for x in judged(find_benchmark(frame(spark, [(1, "a b")]), none)).collect()] == [False]
    assert find_benchmark(frame(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    assert Windows([]).occurrences(np.array([0, 0]))[0].tolist() == []


def test_blocks_have_a_bound_and_all_windows():
    random.seed(2)
    words = [f"w{k}".encode() for k in range(5)]
    items = [(k, b" ".join(random.choices(words, k=random.choice([0, 1, 12, 13, 14, 90]))).decode()) for k in range(40)]

    def windows(blocks):
        found = {}
        for block in map(Windows, blocks):
            names = {v: k for k, v in block.vocabulary.items()}
            for k, (row, n) in enumerate(zip(block.patterns.tolist(), block.lengths.tolist(), strict=True)):
                found.setdefault(tuple(names[x] for x in row[:n]), set()).update(block.items_of(np.array([k])))
        return found

    small = list(blocks_of(items, most=10))
    sizes = [sum(max(1, len(w) - 12) for _, w in block) for block in small]
    assert set(sizes[:-1]) == {10} and sizes[-1] <= 10
    want = {}
    for item, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - 12)) if w else ():
            want.setdefault(tuple(w[k : k + 13]), set()).add(item)
    assert windows(small) == windows(blocks_of(items)) == want


def test_memory_of_a_full_block():
    rng = np.random.default_rng(3)
    text = " ".join(f"w{x}" for x in rng.integers(0, 200_000, BLOCK_WINDOWS + 500))
    tracemalloc.start()
    first, second = blocks_of([(1, text)])
    block = Windows(first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(block.lengths) == BLOCK_WINDOWS and len(second[0][1]) == 500
    assert peak < 300 << 20 and len(pickle.dumps(block)) < 60 << 20


def test_benchmark_sql(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.op9_decontaminated(spark, sf)
    names, want = duck_rows(connect(sf), queries.ORACLES["op9_decontaminated"])
    columns, got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    assert columns == names and got == want


def brute_removed(texts, length):
    data = [(x or "").encode() for x in texts]
    seen = Counter(x[k : k + length] for x in data for k in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = [False] * len(x)
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=50), max_size=5), st.sampled_from([8, 9, 13]))
def test_expansion_against_brute_force(texts, length):
    one = [x.encode() for x in texts]
    data = one * 2
    seen = Counter(x[k : k + length] for x in data for k in range(len(x) - length + 1))
    several = [k % 2 == 0 for k in range(len(one))]
    copied = Counter(x[k : k + length] for x, s in zip(one, several, strict=True) for k in range(len(x) - length + 1) for _ in range(1 + s))
    assert [x.tolist() for x in repeated(one, length, several)] == [[copied[x[k : k + length]] > 1 for k in range(len(x) - length + 1)] for x in one]
    assert [x.tolist() for x in repeated(data, length)] == [[seen[x[k : k + length]] > 1 for k in range(len(x) - length + 1)] for x in data]


def test_anchors_cover_each_window_once_and_alike():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    first, last, hashes = anchors(data, 200)
    assert first[0] == 0 and last[-1] == 2800 and (first[1:] == last[:-1] + 1).all()
    inner = anchors(data[500:], 200)
    outer = {int(k): int(h) for a, b, h in zip(first, last, hashes, strict=True) for k in range(a, b + 1)}
    assert all(outer[int(k) + 500] == int(h) for a, b, h in zip(*inner, strict=True) for k in range(a, b + 1))


@pytest.mark.parametrize("most_contexts", [512, 1])
def test_removed_bytes_against_brute_force(spark, most_contexts):
    random.seed(2)
    words = [f"wörd{k}" for k in range(500)]
    passage = " ".join(random.choices(words, k=60))
    texts = [" ".join(random.choices(words, k=random.randrange(0, 200))) for _ in range(20)]
    texts += [x + " " + passage + " " + y for x, y in zip(texts[:8], texts[8:16], strict=True)] + ODD_TEXTS + ["ab" * 300, LONG[:700]]
    docs = frame(spark, [(k, x) for k, x in enumerate(texts)])
    got = {x["doc_id"]: x for x in remove_repeats(docs, most_contexts=most_contexts, batch_bytes=3000).collect()}
    for k, want in enumerate(brute_removed(texts, 200)):
        x = got[k]
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) == want
        assert hashlib.sha256(x["kept"]).hexdigest() == want[3]


def test_removed_bytes_of_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = remove_repeats(frame(spark, [(1, text), (1, text), (None, text[:150])]), with_kept=False).collect()
    assert sorted((x["doc_id"] or 0, x["n_removed"]) for x in rows) == [(0, 0), (1, len(text)), (1, len(text))]
    assert remove_repeats(frame(spark, [])).count() == 0


def brute_rules(text, min_words=8):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    n = len(words)
    windows = Counter(tuple(words[k : k + 5]) for k in range(n - 4))
    repeat = {p for k in range(n - 4) if windows[tuple(words[k : k + 5])] > 1 for p in range(k, k + 5)}
    longest, spans = 0, set()
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
            if k >= min_words:
                spans |= set(range(i, i + k))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat), len(spans), longest


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n#", max_size=60), max_size=4))
def test_rules_against_brute_force(texts):
    found = measured(texts, 3, 0.2, 100)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    for k, x in enumerate(texts):
        assert tuple(found[name][k] for name in names) == brute_rules(x, 3)


def test_rules_on_odd_rows(spark):
    plain = " ".join(f"word{k}" for k in range(40))
    looped = plain + " " + " ".join(f"again{k}" for k in range(12)) * 1 + " x " + " ".join(f"again{k}" for k in range(12))
    docs = frame(spark, [(k, x) for k, x in enumerate([*ODD_TEXTS[:4], *ODD_TEXTS[5:], plain, looped])] + [(99, plain)])
    rows = {x["doc_id"]: x for x in repetition_rules(docs, batch_words=10).collect()}
    n = len(ODD_TEXTS) - 1
    assert rows[n]["kept"] and rows[99]["kept"] and not rows[n]["base_failed"]
    assert not rows[n + 1]["kept"] and rows[n + 1]["longest_repeat"] == 12 and rows[n + 1]["covered_words"] == 24
    assert rows[1]["base_failed"] and rows[2]["base_failed"] and rows[2]["n_words"] == 0
    for k, text in enumerate([*ODD_TEXTS[:4], *ODD_TEXTS[5:], plain, looped]):
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
        assert tuple(rows[k][x] for x in names) == brute_rules(text)
    assert repetition_rules(frame(spark, [])).count() == 0
