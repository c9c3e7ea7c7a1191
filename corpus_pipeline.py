"""A training corpus from raw documents: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.common import ROW, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence stay; those without letters and those unlike all languages go."""
    from tradewatch.llm.kneserney import fit, fold, predict

    found = predict(docs, *fit(docs, F.coalesce(fold() == 2, F.lit(False))), carry=True)
    return found.where("accepted").select(f"{ROW}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of 3-word shingles at most two bits apart) stays."""
    from tradewatch.llm.pigeonring import one_of_each

    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    from tradewatch.llm.fmindex import find_benchmark, judged

    found = judged(find_benchmark(docs, table(spark, sf_dir, "benchmark"), carry=True))
    return found.where("not contaminated").select(f"{ROW}.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    from tradewatch.llm.semicrf import find_personal_data, fit

    found = find_personal_data(docs, fit(docs), with_text=True, carry=True)
    new = {"text": F.col("masked"), "n_chars": F.when(F.col(f"{ROW}.text").isNotNull(), F.length("masked").cast("long")).otherwise(F.col(f"{ROW}.n_chars"))}
    return found.select(*[new.get(x, F.col(f"{ROW}.`{x}`")).alias(x) for x in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of related documents."""
    from tradewatch.llm.bm25pack import pack_documents
    from tradewatch.llm.queries import tokenizer_path

    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL cannot express language models, fingerprints of another hash or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
