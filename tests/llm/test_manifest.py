import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import ODD_TEXTS, frame
from tradewatch.llm import merkle, queries
from tradewatch.llm.merkle import address, build_block, folded, height_of, leaf_digest, manifest, proof_text, siblings, tree_size

SF = "/root/testdata/sf0.001"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, lower=False):
    out = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        v = row[name]
        if v is None:
            out.append("-")
            continue
        v = str(v)
        if lower and name == "text":
            v = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in v)
        out.append(f"{len(v.encode())}:{v}")
    return h(*out)


def brute_tree(leaves):
    """(root, per leaf the siblings level by level)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    ways = []
    for k in range(len(leaves)):
        way = []
        for level in levels[:-1]:
            run = k - k % 8
            way.append((level[run:k], level[k + 1 : run + 8]))
            k //= 8
        ways.append(way)
    return levels[-1][0], ways


def brute_manifest(rows):
    """doc_id, leaf, subroot, root, proof, folded root of the tampered rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    roots, ways, out = {}, {}, []
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
        roots[name], ways[name] = brute_tree([brute_leaf(r) for r in groups[name]])
    root, tops = brute_tree([roots[n] for n in names])
    for k, name in enumerate(names):
        for row, way in zip(groups[name], ways[name], strict=True):
            proof = way + tops[k]
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            node = brute_leaf(row, hit)
            for before, after in proof:
                node = h(*before, node, *after)
            out.append((row["doc_id"], brute_leaf(row), roots[name], root, h(*[x for b, a in proof for x in b + a]), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", range(1, 7))
def test_addresses_are_a_layout_with_whole_subtrees(levels):
    seen = np.concatenate([address(levels, d, np.arange(8**d)) for d in range(levels)])
    assert sorted(seen.tolist()) == list(range(tree_size(levels)))
    top = levels // 2
    if top:  # the upper part comes first, and each lower part is one run of places
        assert sorted(np.concatenate([address(levels, d, np.arange(8**d)) for d in range(top)]).tolist()) == list(range(tree_size(top)))
        lower = tree_size(levels - top)
        for k in range(min(8**top, 20)):
            own = [address(levels, top + d, np.arange(k * 8**d, (k + 1) * 8**d)) for d in range(levels - top)]
            assert sorted(np.concatenate(own).tolist()) == list(range(tree_size(top) + k * lower, tree_size(top) + (k + 1) * lower))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 100, 513])
def test_blocks_and_siblings(n):
    leaves = [h(str(k)) for k in range(n)]
    root, ways = brute_tree(leaves)
    layout, found = build_block([bytes.fromhex(x) for x in leaves], height_of(n))
    assert found == root
    levels = siblings(layout, n, height_of(n))
    for k in range(n):
        place = k
        for (before, after), want in zip(levels, ways[k], strict=True):
            assert (before[place], after[place]) == ("".join(want[0]), "".join(want[1]))
            place //= 8


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_against_one_tree(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 8**height)
    rows = [(k, f"Text {k} {ODD_TEXTS[k % 9]}") for k in range(300)] + list(enumerate(ODD_TEXTS)) + [(None, "No id"), (None, "No id"), (5, "Tie")]
    langs = {k: ("en", "én", "", "de")[k % 4 if k < 40 else 0] for k in range(0, 280)}
    docs = frame(spark, rows, langs)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = leaf_digest({"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")})
    found = manifest(docs, carry={"tampered": F.when(hit, lowered)})
    assert found.columns == ["doc_id", "lang", "tampered", "leaf", "subroot", "root", "proof"]
    again = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    got = found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256), again, again == F.col("root"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest([x.asDict() for x in docs.collect()])


def test_query_on_the_documents(spark):
    rows = [x.asDict() for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op12_manifest(spark, SF).collect()), key=repr)
    assert got == brute_manifest(rows) and {x[-1] for x in got} == {True, False}


def test_empty_table(spark):
    assert manifest(frame(spark, [])).count() == 0
