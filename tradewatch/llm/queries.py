"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from tradewatch.llm.common import table
from tradewatch.llm.sql import clusters_sql, manifest_sql


def op1_token_files(spark, sf_dir):
    from tradewatch.llm import repair
    from tradewatch.session import shared_folder

    docs = table(spark, sf_dir, "documents")
    path = shared_folder(spark, "token-files")
    repair.write_token_files(docs, path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    files = repair.read_token_files(spark, path)
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_shards(spark, sf_dir):
    from tradewatch.llm.lpt import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"), shards=40)


def op3_personal_data(spark, sf_dir):
    from tradewatch.llm.semicrf import find_personal_data, fit

    docs = table(spark, sf_dir, "documents")
    return find_personal_data(docs, fit(docs))


#: The contract's rules for urls.
URL_RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block",
}
#: Rounds written out in the SQL: enough for tables whose hosts lie on no cycle and no longer chain.
SQL_ROUNDS = 10


def op4_urls(spark, sf_dir):
    from tradewatch.llm.linkgraph import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    from tradewatch.llm.linkgraph import DAMPING, FAMILY, LEAST

    def host(url: str) -> str:
        lowered = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
        return f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), {lowered})"

    rules, said = [], []
    for rule in sorted(URL_RULES, key=len, reverse=True):
        at, _, rest = rule.partition("/")
        rules.append(f"WHEN (host = '{at}' OR host LIKE '%.{at}') AND starts_with(path, '/{rest}') THEN '{rule}'")
        said.append(f"WHEN rule = '{rule}' THEN '{URL_RULES[rule]}'")
    link = r"""(?i)href\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]+)"""
    parts = [
        f"p AS (SELECT page_id, html, {host('url')} AS host, "
        "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)",
        f"ruled AS (SELECT page_id, host, path, CASE {' '.join(rules)} END AS rule FROM p)",
        f"judged AS (SELECT *, CASE {' '.join(said)} END AS said FROM ruled)",
        "seeds AS (SELECT host, 2 * count(*) FILTER (said = 'allow') > count(*) AS good, "
        "2 * count(*) FILTER (said = 'block') > count(*) AS bad FROM judged WHERE host <> '' GROUP BY host)",
        f"links AS (SELECT host AS source, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM p)",
        f"linked AS (SELECT source, {host("CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END")} AS target, "
        "count(*)::DOUBLE AS links FROM links GROUP BY ALL)",
        "hosts AS (SELECT host FROM p UNION SELECT target FROM linked)",
        "family AS (SELECT host, regexp_extract(host, '^[^.]+\\.([^.]+\\..+|[^.]+\\.[^.]+)$', 1) AS domain FROM hosts)",
        f"every AS (SELECT * FROM linked UNION ALL SELECT host, domain, {FAMILY} FROM family WHERE domain <> '')",
        "edges AS (SELECT source, target, sum(links) AS links FROM every "
        "WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL)",
        "steps AS (SELECT 'trust' AS way, source AS a, target AS b, links / sum(links) OVER (PARTITION BY source) AS share FROM edges "
        "UNION ALL SELECT 'distrust', target, source, links / sum(links) OVER (PARTITION BY target) FROM edges)",
        "r0 AS (SELECT host, 'trust' AS way, 1.0::DOUBLE AS score FROM seeds WHERE good "
        "UNION ALL SELECT host, 'distrust', 1.0 FROM seeds WHERE bad)",
    ]
    for k in range(SQL_ROUNDS):
        parts.append(
            f"r{k + 1} AS (SELECT host, way, sum(score) AS score FROM (SELECT b AS host, way, share * score * {DAMPING} AS score "
            f"FROM steps JOIN r{k} USING (way) WHERE a = host UNION ALL SELECT host, way, score * {1 - DAMPING} FROM r0) GROUP BY ALL)"
        )
    parts.append(
        "scores AS (SELECT host, coalesce(sum(score) FILTER (way = 'trust'), 0) AS trust, "
        f"coalesce(sum(score) FILTER (way = 'distrust'), 0) AS distrust FROM r{SQL_ROUNDS} GROUP BY host)"
    )
    own = f"CASE WHEN coalesce(distrust, 0) >= {LEAST} AND distrust > trust THEN 'block' ELSE 'allow' END"
    return f"WITH {', '.join(parts)} SELECT page_id, host, path, rule, coalesce(said, {own}) AS verdict FROM judged LEFT JOIN scores USING (host)"


def op5_packed(spark, sf_dir):
    from tradewatch.llm.bm25pack import KEPT_ALONE, pack_documents

    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, kept=KEPT_ALONE, together=True)


def op6_repetition(spark, sf_dir):
    from tradewatch.llm.suffixrules import repetition_rules

    return repetition_rules(table(spark, sf_dir, "documents"))


def op7_substrings(spark, sf_dir):
    from tradewatch.llm.bwtdedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def op8_near_duplicates(spark, sf_dir):
    from tradewatch.llm.pigeonring import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_decontaminated(spark, sf_dir):
    from tradewatch.llm.fmindex import find_benchmark, judged

    found = judged(find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), b1 AS (
  SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS win FROM b1
), sizes AS (SELECT DISTINCT size FROM windows), d1 AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size
), hits AS (
  SELECT d1.doc_id, i, d1.size, item_id FROM d1 JOIN windows ON d1.size = windows.size AND win = array_to_string(w[i:i + d1.size - 1], ' ')
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("\\\\", "\\")


def op10_languages(spark, sf_dir):
    from tradewatch.llm.kneserney import fit, fold, predict

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold() == 2, F.lit(False))
    models, calibration = fit(docs, held_out)
    found = predict(docs, models, calibration)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op11_few_sequences(spark, sf_dir):
    from tradewatch.llm.dominance import pack_few

    packed = pack_few(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_manifest(spark, sf_dir):
    from tradewatch.llm.merkle import folded, leaf_digest, manifest, proof_text

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(hit, leaf_digest({"text": F.translate("text", upper, lower)}))
    found = manifest(table(spark, sf_dir, "documents"), carry={"tampered": tampered})
    again = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_clusters(spark, sf_dir):
    from tradewatch.llm.centroids import cluster_vectors

    found = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_shards": op2_shards,
    "op3_personal_data": op3_personal_data,
    "op4_urls": op4_urls,
    "op5_packed": op5_packed,
    "op6_repetition": op6_repetition,
    "op7_substrings": op7_substrings,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_decontaminated": op9_decontaminated,
    "op10_languages": op10_languages,
    "op11_few_sequences": op11_few_sequences,
    "op12_manifest": op12_manifest,
    "op13_clusters": op13_clusters,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op4_urls": _url_sql(),
    "op9_decontaminated": OP9_SQL,
    "op12_manifest": manifest_sql(),
    "op13_clusters": clusters_sql(),
}
