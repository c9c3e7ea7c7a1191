import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from tests.llm.rows import LONG, ODD_TEXTS, frame
from tradewatch.llm.dominance import Plan, best_fit, least_windows, pack_few, pieces_of, reduce

FILE = tokenizer_path("byte_bpe_50k.json")


def brute_best_fit(sizes, window):
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in bins if sum(b) + s <= window]
        if fits:
            min(fits, key=lambda b: window - sum(b)).append(s)
        else:
            bins.append([s])
    return bins


def fewest(sizes, window):
    """The least number of windows, by trying every set that holds the longest piece."""
    seen = {}

    def solve(left):
        if not left:
            return 0
        if left not in seen:
            first, rest = left[0], left[1:]
            best = len(left)
            for n in range(len(rest) + 1):
                for chosen in set(combinations(range(len(rest)), n)):
                    if first + sum(rest[k] for k in chosen) <= window:
                        best = min(best, 1 + solve(tuple(x for k, x in enumerate(rest) if k not in chosen)))
            seen[left] = best
        return seen[left]

    return solve(tuple(sorted(sizes, reverse=True)))


def spread(patterns):
    return Counter(x for pattern, n in patterns for x in [pattern] * n)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40), st.sampled_from([20, 23]))
def test_best_fit_deals_as_piece_by_piece(sizes, window):
    want = Counter(tuple(sorted(Counter(b).items(), reverse=True)) for b in brute_best_fit(sizes, window))
    assert sorted(sum(s * n for s, n in p) for p in want.elements()) == sorted(sum(s * n for s, n in p) for p in spread(best_fit(Counter(sizes), window)).elements())
    assert spread(best_fit(Counter(sizes), window)).total() == want.total()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_fixed_sets_are_part_of_an_optimum(sizes):
    fixed, rest = reduce(Counter(sizes), 20)
    bins = sum(n for _, n in fixed)
    assert bins + fewest(list(Counter(rest).elements()), 20) == fewest(sizes, 20) >= least_windows(Counter(sizes), 20)
    held = Counter(rest)
    for pattern, n in fixed:
        assert sum(s * k for s, k in pattern) <= 20
        for s, k in pattern:
            held[s] += n * k
    assert held == Counter(sizes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_plan_places_each_piece_once(sizes):
    plan = Plan(Counter(sizes), 50)
    taken = set()
    for size, n in Counter(sizes).items():
        sequence, offset = plan.places(np.full(n, size), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            new = {(s, k) for k in range(o, o + size)}
            assert not new & taken and o + size <= 50
            taken |= new
    assert len(taken) == sum(sizes)
    for s in {x for x, _ in taken}:
        assert {k for x, k in taken if x == s} == set(range(sum(x == s for x, _ in taken)))
    assert plan.windows >= least_windows(Counter(sizes), 50)


def test_reduction_is_near_the_bound_on_many_pieces():
    random.seed(1)
    counts = Counter(min(1024, int(random.lognormvariate(5.5, 1))) or 1 for _ in range(200_000))
    counts[1024] += 10**9  # a hot length costs no more than another one
    plan = Plan(counts, 1024)
    assert plan.fixed and plan.windows <= 1.001 * least_windows(counts, 1024) and len(plan.patterns) < 10_000


def test_pieces_of_documents():
    assert pieces_of(5, 10) == [(0, 5)] and pieces_of(10, 10) == [(0, 10)]
    assert pieces_of(20, 10) == [(0, 10), (10, 10)] and pieces_of(23, 10) == [(0, 3), (3, 10), (13, 10)]


@pytest.mark.parametrize("window", [16, 1024])
def test_rows_against_whole_texts(spark, window):
    texts = list(enumerate(ODD_TEXTS * 3)) + [(None, LONG), (3, "again")]
    docs = frame(spark, texts).repartition(4)
    rows = [x.asDict() for x in pack_few(docs, FILE, window=window).collect()]
    own = Tokenizer.from_file(FILE)
    want = Counter((d, np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for d, t in texts)
    got, last = Counter(), {}
    for x in rows:
        assert x["length"] == len(x["ids"]) // 4 <= window and (x["piece"] == 0 or x["length"] == window)
        last.setdefault((x["doc_id"], x["piece"]), []).append(x)
    for d, t in texts:
        if (d, t) not in ((3, "again"), (3, ODD_TEXTS[3])):
            pieces = [last[d, k][0] for k in range(sum(1 for a, _ in last if a == d))]
            assert [x["start"] for x in pieces] == np.cumsum([0] + [x["length"] for x in pieces])[:-1].tolist()
            got[d, b"".join(bytes(x["ids"]) for x in pieces)] += 1
    assert got == Counter({k: n for k, n in want.items() if k[0] != 3})
    for s in {x["sequence_id"] for x in rows}:
        at = 0
        for x in sorted((x for x in rows if x["sequence_id"] == s), key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= window
    assert len({x["sequence_id"] for x in rows}) == Plan(Counter(x["length"] for x in rows), window).windows


def test_empty_table(spark):
    assert pack_few(frame(spark, []), FILE).count() == 0
