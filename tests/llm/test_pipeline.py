"""Each stage of the pipeline against brute force on its own input."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.rows import ODD_TEXTS, frame
from tests.llm.test_near import brute_hash, roots_of
from tests.llm.test_repeats import brute_benchmark
from tradewatch.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return {x["doc_id"]: x["text"] for x in df.collect()}


def test_columns_and_clean_documents(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    kept, given = texts(stages[1]), texts(stages[0])
    assert kept.items() <= given.items() and len(kept) >= 0.98 * len(given)


def test_one_of_each_group_stays(stages):
    given = texts(stages[1])
    prints = {d: brute_hash(t) for d, t in given.items()}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    assert set(texts(stages[2])) == set(roots_of(links, prints).values())


def test_contaminated_documents_go(spark, stages):
    given = list(texts(stages[2]).items())
    items = [tuple(x) for x in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for (d, _), x in zip(given, brute_benchmark(given, items), strict=True) if x[-1]}
    assert set(texts(stages[3])) == {d for d, _ in given} - bad


def test_personal_data_is_masked(stages):
    from tests.llm.test_models import brute_base

    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for d, text in before.items():
        assert (after[d] != text) == bool(brute_base(text))
        assert not brute_base(after[d])
    assert all(x["n_chars"] == len(x["text"]) for x in stages[4].collect())


def test_all_that_is_kept_is_packed(stages):
    assert {x["doc_id"] for x in stages[5].collect()} == set(texts(stages[4]))


def test_registered_and_odd_rows(spark):
    assert "pipeline" in entry.queries() and sorted(x for x in entry.queries() if x.startswith("op")) == sorted(
        ["op1_token_files", "op2_shards", "op3_personal_data", "op4_urls", "op5_packed", "op6_repetition", "op7_substrings"]
        + ["op8_near_duplicates", "op9_decontaminated", "op10_languages", "op11_few_sequences", "op12_manifest", "op13_clusters"]
    )
    docs = frame(spark, list(enumerate(ODD_TEXTS)) + [(None, "some text of no id"), (0, ODD_TEXTS[0])], {0: "en", 4: "en"})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_kept_chunks_change_no_row(spark):
    from tests.llm.rows import ODD_TEXTS, frame
    from tradewatch.llm.bm25pack import pack_documents
    from tradewatch.llm.queries import tokenizer_path

    docs = frame(spark, list(enumerate(ODD_TEXTS))).coalesce(1)
    few, many = (sorted(map(str, pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), kept=n).collect())) for n in (3, 1 << 20))
    assert few == many


def test_texts_of_an_arrow_array_have_the_ids_of_each_text():
    import random

    import pyarrow as pa

    from tradewatch.llm import tokens
    from tradewatch.llm.queries import tokenizer_path

    random.seed(4)
    parts = ["the", "The", "fox,", " ", "  ", "\n", " \n", "\u2003 ", "\x1c ", "\u00e9t\u00e9.", "it's", "42", "<|x|>", "\u0130I", "a.\nB", "", " b", "c "]
    random_texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(300)]
    texts = [*ODD_TEXTS, *random_texts, None, "", " ", "one two", "the fox, the fox,"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = tokenizer_path(name)
        library = tokens.ChunkEncoder(path)._whole
        want = [library(x or "") + b"\x01\0\0\0" for x in texts]
        for kept, held in ((3, 40), (1 << 20, 1 << 23)):
            tokens.forget()
            tokens.HELD_BYTES, before = held, tokens.HELD_BYTES
            try:
                assert list(tokens.encoded(pa.array(texts, pa.string()), path, 1, kept)) == want
                assert list(tokens.encoded(pa.array([], pa.string()), path, 1, kept)) == []
            finally:
                tokens.HELD_BYTES = before
    tokens.forget()


def test_a_chunk_of_many_texts_is_looked_up_once(monkeypatch):
    import pyarrow as pa

    from tradewatch.llm import tokens
    from tradewatch.llm.queries import tokenizer_path

    asked = []
    own = tokens.ChunkEncoder(tokenizer_path("byte_bpe_50k.json"))
    monkeypatch.setattr(tokens, "encoder", lambda path: own)
    monkeypatch.setattr(tokens.ChunkEncoder, "__getitem__", lambda self, x: asked.append(x) or (self.get(x) or self.__missing__(x)))
    list(tokens.encoded(pa.array(["first fox home"] + ["then fox home"] * 500), "any", 1))
    assert asked.count(" fox") == asked.count(" home") == 1


def test_python_white_space_before_a_blank():
    import sys

    import pyarrow as pa
    import pyarrow.compute as pc

    from tradewatch.llm.tokens import _WIDE

    spaces = [chr(x) for x in range(sys.maxunicode) if chr(x).isspace()]
    assert pc.all(pc.match_substring_regex(pa.array([f"a{x} b" for x in spaces]), _WIDE)).as_py()
    assert not pc.any(pc.match_substring_regex(pa.array(["a b", "a", " ", "\u00e9 b"]), _WIDE)).as_py()
