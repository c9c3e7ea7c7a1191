"""SQL of the manifest and of the clusters, written out level by level and round by round."""

from __future__ import annotations

from tradewatch.llm.centroids import DIMS, K, ROUNDS, SEED

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen(({x})::VARCHAR)::VARCHAR || ':' || ({x})::VARCHAR, '-')" for x in values) + ")"


def _crc32(text: str) -> str:
    """The crc of an ASCII text, bit by bit: a byte is put in and eight steps follow."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: {step}), 4294967295::BIGINT)"


def _tree(name: str, leaves: str, levels: int) -> list[str]:
    """CTEs of the trees over ``leaves`` (g, i, h): levels, what stands beside each node, and the roots."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves})"]
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM "
            f"(SELECT g, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k} WHERE n > 1 GROUP BY g, i // 8))"
        )
        parts.append(
            f"{name}_beside{k} AS MATERIALIZED (SELECT a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before, "
            f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after FROM {name}{k} a JOIN {name}{k} b "
            f"ON a.g IS NOT DISTINCT FROM b.g AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.g, a.i)"
        )
    roots = " UNION ALL ".join(f"SELECT g, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    parts.append(f"{name}_roots AS MATERIALIZED ({roots})")
    return parts


def _fold(name: str, rows: str, levels: int) -> list[str]:
    """CTEs that carry (g, i, proof, node) of ``rows`` up the tree."""
    parts, last = [], rows
    for k in range(levels):
        parts.append(
            f"{name}_fold{k} AS MATERIALIZED (SELECT r.* REPLACE (proof || coalesce(before || after, '') AS proof, "
            f"CASE WHEN before IS NULL THEN node ELSE sha256(before || node || after) END AS node) FROM {last} r "
            f"LEFT JOIN {name}_beside{k} s ON s.g IS NOT DISTINCT FROM r.g AND s.i = r.i // {8**k})"
        )
        last = f"{name}_fold{k}"
    return parts


def manifest_sql(levels: int = 7, group_levels: int = 4) -> str:
    """For up to 8 ** levels rows of a group and 8 ** group_levels groups, with an id on every row."""
    parts = [
        f"leaves AS MATERIALIZED (SELECT doc_id, lang AS g, {_leaf('text')} AS h, "
        f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS t FROM documents)",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, h) - 1 AS i FROM leaves)",
        *_tree("t", "placed", levels),
        "groups AS MATERIALIZED (SELECT g AS name, h, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM t_roots)",
        *_tree("u", "groups", group_levels),
        "start AS (SELECT doc_id, h AS leaf, t AS node, g, i, '' AS proof FROM placed)",
        *_fold("t", "start", levels),
        f"lifted AS (SELECT r.doc_id, r.leaf, r.node, r.proof, r.g AS name, o.h AS subroot, 0 AS g, o.i FROM t_fold{levels - 1} r "
        "JOIN groups o ON o.name IS NOT DISTINCT FROM r.g)",
        *_fold("u", "lifted", group_levels),
    ]
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, u_roots.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, "
        f"node = u_roots.h AS verified FROM u_fold{group_levels - 1}, u_roots"
    )


def clusters_sql() -> str:
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        "v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        f"WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, v FROM v "
        f"QUALIFY c < {K})",
    ]
    for k in range(ROUNDS + 1):
        parts.append(
            f"a{k} AS MATERIALIZED (SELECT vec_id, c, d, v FROM (SELECT v.vec_id, v.v, c.c, {distance} AS d FROM v, c{k} c) "
            "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"
        )
        if k < ROUNDS:
            parts.append(
                f"m{k} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY dim) AS v FROM "
                f"(SELECT c, dim, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({DIMS})) AS dim FROM a{k}) GROUP BY c, dim) GROUP BY c)"
            )
            parts.append(f"c{k + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{k} o LEFT JOIN m{k} m ON m.c = o.c)")
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, "
        "(sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, "
        f"sha256(array_to_string(o.v, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN c{ROUNDS} o ON o.c = a.c"
    )
