import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from tests.llm.rows import ODD_TEXTS, frame
from tradewatch.llm.components import components
from tradewatch.llm.pigeonring import near_duplicates, near_pairs, one_of_each, ring_masks, simhash


def brute_hash(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    votes = [xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


@settings(max_examples=200, deadline=None)
@given(st.text("aBÉ \n\t,", max_size=60))
def test_fingerprint(text):
    assert simhash(text) == brute_hash(text)


def test_hash_is_the_engines_own(spark):
    row = spark.sql("select xxhash64('a b c') as h").first()
    assert row["h"] % 2**64 == xxh64_intdigest(b"a b c", 42)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=2))
def test_some_chain_admits_every_near_pair(value, flips):
    other = value
    for k in flips:
        other ^= 1 << k
    chains = [ring_masks(k, 9, 2) for k in range(9)]
    assert all(bin(mask & (2**64 - 1)).count("1") == 64 for mask, _ in (x[-1] for x in chains))
    assert any(all(bin((value ^ other) & mask & (2**64 - 1)).count("1") <= budget for mask, budget in x) for x in chains)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def values():
    random.seed(4)
    out = [random.getrandbits(64) for _ in range(60)]
    for x in out[:30]:
        for _ in range(random.randrange(4)):
            y = x
            for _ in range(random.randrange(4)):
                y ^= 1 << random.randrange(64)
            out.append(y)
    return [*out, 0, 1, 3, 2**64 - 1]


def roots_of(pairs, nodes):
    parent = {x: x for x in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


@pytest.mark.parametrize("bucket", [64, 1])
def test_pairs_against_brute_force(spark, bucket):
    own = sorted({signed(x) for x in values()})
    want = {(a, b) for a in own for b in own if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    got = {tuple(x) for x in near_pairs(spark.createDataFrame([(x,) for x in own], "fp long"), bucket=bucket).collect()}
    assert got <= want and roots_of(got, own) == roots_of(want, own)
    if bucket == 64:
        assert got == want


def test_components_of_long_paths_and_rings(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100 + k, 100 + (k + 1) % 20) for k in range(20)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = [*range(41), *range(100, 120), 200, 201]
    assert got == roots_of([p for p in pairs if None not in p], nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_against_brute_force(spark):
    base = " ".join(f"w{k}" for k in range(300))
    texts = [*ODD_TEXTS, base, base + " tail", base.upper(), base.replace("w7 ", "v7 ")]
    docs = frame(spark, [(50 - k, x) for k, x in enumerate(texts)] + [(None, base), (50, ODD_TEXTS[0])])
    prints = {50 - k: brute_hash(x) for k, x in enumerate(texts)}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    roots = roots_of(links, prints)
    rows = near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    for x in rows:
        if x["doc_id"] is not None:
            assert x["fingerprint"] == f"{prints[x['doc_id']]:016x}" and x["component_id"] == roots[x["doc_id"]]
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(roots.values()))


def test_rows_without_ids_and_empty_tables(spark):
    rows = one_of_each(frame(spark, [(None, "a b c d"), (None, "a b c d"), (None, None)])).collect()
    assert sorted(x["text"] or "" for x in rows) == ["", "a b c d"]
    assert near_duplicates(frame(spark, [])).count() == 0
