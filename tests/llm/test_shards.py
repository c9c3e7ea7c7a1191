import zlib

import pytest

from tests.llm.rows import ODD_TEXTS, frame
from tradewatch.llm.lpt import assign_shards, longest_first


def test_longest_first_is_the_greedy_schedule():
    sizes = {k: (k * 7919) % 101 for k in range(60)}
    loads, expected = [0] * 7, {}
    for item in sorted(sizes, key=lambda x: (-sizes[x], str(x))):
        shard = loads.index(min(loads))
        expected[item] = shard
        loads[shard] += sizes[item]
    assert longest_first(sizes, 7) == expected
    assert longest_first({}, 3) == {}


@pytest.mark.parametrize("per_shard,bundles", [(256, 1 << 15), (2, 40), (10**6, 1)])
def test_groups_stay_together_and_loads_are_near(spark, per_shard, bundles):
    texts = [f"text {k} " * (k % 13) for k in range(300)] + ["hot"] * 200 + ODD_TEXTS
    docs = frame(spark, [(k % 400, x) for k, x in enumerate(texts)] + [(None, "hot")])
    rows = assign_shards(docs, 5, per_shard, bundles, slices=3).collect()
    assert len(rows) == len(texts) + 1
    size = {t: len((t or "").encode()) + 16 for t in set(texts)}
    by_crc = {}
    for x in rows:
        by_crc.setdefault(x["text_crc32"], set()).add(x["shard"])
        assert x["law"] == "bytes" and x["grown_shard"] is None and 0 <= x["shard"] < 5
    crc = lambda t: zlib.crc32((t or "").encode())
    assert all(len(by_crc[crc(t)]) == 1 for t in set(texts) if t not in ("", None))
    assert sorted(x["size"] for x in rows) == sorted([size[t] for t in texts] + [size["hot"]])
    for shard in range(5):
        assert sorted(x["slot"] for x in rows if x["shard"] == shard) == list(range(sum(x["shard"] == shard for x in rows)))
    if bundles > 1000:
        loads = [sum(x["size"] for x in rows if x["shard"] == k) for k in range(5)]
        assert max(loads) - min(loads) <= max(size["hot"] * 201, max(size.values()))


def test_hot_group_fills_its_shard_and_the_rest_is_level(spark):
    docs = frame(spark, [(k, "same words") for k in range(900)] + [(k, f"t{k}") for k in range(1000, 1600)])
    rows = assign_shards(docs, 8).collect()
    loads = sorted(sum(x["size"] for x in rows if x["shard"] == k) for k in range(8))
    assert loads[-1] == 900 * 26
    assert loads[-2] - loads[0] <= 21


def test_empty_table(spark):
    assert assign_shards(frame(spark, []), 5).count() == 0
