import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from tests.llm.rows import ODD_TEXTS, frame
from tradewatch.llm import repair, tokens
from tradewatch.llm.bm25pack import Bm25Index, pack, pack_documents

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
WORDS = ["", " ", "  ", "a", "the", "Thé,", "don't", "'s", "\n", "\t", "x.", "..", "<|endoftext|>", "é", "́", " ", "42", "İ", "ΑΣ", "\x1c", "é", "中文"]


def whole(name, text):
    return Tokenizer.from_file(tokenizer_path(name)).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_chunks_encode_as_whole_texts(name):
    own = Tokenizer.from_file(tokenizer_path(name))
    encoder = tokens.encoder(tokenizer_path(name))

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(WORDS) | st.text(max_size=4), max_size=8), st.sampled_from([" ", "", "  ", "\n"]))
    def check(parts, joint):
        text = joint.join(parts).encode("utf-8", "ignore").decode()
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids

    check()


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("text", ["İ,", "wordİ.", "İ., x", "a\nİ\nb.\n\nc", "x.\nY!!", "Dogs'. 'tis!\"", "a<|endoftext|>.", "\n.a\n"])
def test_marks_stops_and_line_ends(name, text):
    assert np.frombuffer(tokens.encoder(tokenizer_path(name)).encode(text), "<u4").tolist() == whole(name, text)


def test_cache_bound_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_CHUNKS", 3)
    encoder = tokens.ChunkEncoder(tokenizer_path(FILES[0]))
    text = "one two three four five six one two, three."
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(FILES[0], text)
    assert len(encoder) <= 4 and len(encoder.older) <= 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_grammar_round_trip_and_random_access(ids, start, stop):
    ids = np.array(ids, np.int64)
    base, rules, spans, sequence = repair.compress(ids, least=2)
    assert repair.expand(base, rules, sequence).tolist() == ids.tolist()
    assert repair.decode_range(base, rules, spans, sequence, start, stop).tolist() == ids[start : max(start, stop)].tolist()
    assert all(spans[k] == len(repair.expand(base, rules, np.array([base + k]))) for k in range(len(rules)))


def test_grammar_shortens_repetition():
    ids = np.tile(np.arange(50), 200)
    assert len(repair.compress(ids)[3]) < len(ids) / 5


def test_files_hold_every_document(spark, tmp_path):
    docs = frame(spark, [(k, x) for k, x in enumerate(ODD_TEXTS)] + [(2, "again"), (None, "no id"), (3, ODD_TEXTS[3])])
    repair.write_token_files(docs, str(tmp_path / "t"), tokenizer_path(FILES[0]), block_ids=50)
    rows = repair.read_token_files(spark, str(tmp_path / "t")).collect()
    expected = sorted([(x["doc_id"], x["text"]) for x in docs.select("doc_id", "text").collect()], key=lambda x: (x[0] is not None, x[0] or 0))
    rows = sorted(rows, key=lambda x: x["start"])
    assert [x["doc_id"] for x in rows] == [x[0] for x in expected]
    at = 0
    for row in rows:
        assert row["start"] == at and row["n_tokens"] == len(row["ids"]) // 4
        at += row["n_tokens"]
    want = sorted((d or -1, np.array([*whole(FILES[0], t or ""), 1], "<u4").tobytes()) for d, t in expected)
    assert sorted((x["doc_id"] or -1, bytes(x["ids"])) for x in rows) == want


def test_empty_table_gives_no_rows(spark, tmp_path):
    docs = frame(spark, [])
    repair.write_token_files(docs, str(tmp_path / "e"), tokenizer_path(FILES[0]))
    assert repair.read_token_files(spark, str(tmp_path / "e")).count() == 0
    assert pack_documents(docs, tokenizer_path(FILES[1])).count() == 0


def brute_bm25(docs, query, terms):
    n, mean = len(docs), np.mean([len(x) for x in docs])
    out = np.zeros(n)
    for t in terms:
        df = sum(t in x for x in docs)
        for k, x in enumerate(docs):
            tf = list(x).count(t)
            out[k] += np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean)) if tf else 0
    return out


def test_index_scores_as_brute_force():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 40, rng.integers(1, 30)) for _ in range(25)]
    index = Bm25Index(docs)
    unused = np.ones(25, bool)
    for k in range(25):
        unused[k] = False
        got = index.neighbours(k, unused, query_terms=10**6)
        shared = [t for t in set(docs[k].tolist()) if sum(t in x for x in docs) > 1]
        score = brute_bm25(docs, k, shared)
        assert set(got.tolist()) == set(np.flatnonzero((score > 1e-12) & unused).tolist())
        assert np.all(np.diff(score[got]) < 1e-9)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=40), max_size=20), st.sampled_from([4, 8, 16]))
def test_packing_keeps_every_id_once(docs, window):
    ids = [np.array(x) for x in docs]
    sequences = pack(np.array([len(x) for x in ids], np.int64), ids, window)
    pieces = sorted(x for s in sequences for x in s)
    assert [(d, k) for d, a, n in pieces for k in range(a, a + n)] == [(d, k) for d, x in enumerate(docs) for k in range(len(x))]
    for s in sequences:
        total = sum(n for _, _, n in s)
        assert total <= window and (total == window or total & (total - 1) == 0)


def test_packed_rows(spark):
    docs = frame(spark, [(k, x) for k, x in enumerate(ODD_TEXTS * 3)])
    rows = pack_documents(docs, tokenizer_path(FILES[1]), window=32).collect()
    byte = {k: np.array([*whole(FILES[1], t or ""), 1], "<u4").tobytes() for k, t in enumerate(ODD_TEXTS * 3)}
    seen = {}
    for x in sorted(rows, key=lambda x: (x["doc_id"], x["start"])):
        own = byte[x["doc_id"]]
        assert x["doc_tokens"] == len(own) // 4 and x["start"] == seen.get(x["doc_id"], 0)
        assert x["ids_crc32"] == zlib.crc32(own[4 * x["start"] : 4 * (x["start"] + x["length"])])
        seen[x["doc_id"]] = x["start"] + x["length"]
    assert seen == {k: len(x) // 4 for k, x in byte.items()}
    for key in {x["sequence_id"] for x in rows}:
        at = 0
        for x in sorted([x for x in rows if x["sequence_id"] == key], key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= 32
