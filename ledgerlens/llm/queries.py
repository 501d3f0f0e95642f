"""The registered queries of this subpackage: thin calls of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table, tokenizer_path
from .ann import ann_search
from .bpe import bpe_round_trip
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .license_scan import license_scan
from .lm_score import lm_score
from .merkle import merkle_manifest
from .packing import best_fit_packing
from .prefix_trie import prefix_trie
from .quality import quality
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity
from .warc import warc_round_trip


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("detections")


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search(table(spark, sf_dir, "embeddings"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_ann_search": op2_ann_search,
    "op3_lm_score": op3_lm_score,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_quality": op11_quality,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text in DuckDB: each character is taken in, then shifted out bit by bit."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [CAST(ord(substr({text}, i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], {steps}),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""


def _merkle_sql(levels: int = 14) -> str:
    """The manifest level by level: 3 ** ``levels`` leaves in a part, parts, at most."""

    def field(c: str) -> str:
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    parts = [
        f"""d AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("wrong")} AS claim FROM (
            SELECT *, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS wrong FROM documents)),
        t0 AS (SELECT doc_id, leaf, claim AS folded, source AS part, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            leaf AS node, '' AS proof FROM d)"""
    ]

    def climb(name: str, up: str, group: str, keep: str) -> None:
        """One level: runs of three of the distinct nodes of a group; a group of one node stays."""
        parts.append(f"""r{up} AS (SELECT {group} AS g, pos // 3 AS up, max(CASE WHEN pos % 3 = 0 THEN node END) AS a,
            coalesce(max(CASE WHEN pos % 3 = 1 THEN node END), '') AS b, coalesce(max(CASE WHEN pos % 3 = 2 THEN node END), '') AS c,
            max(max(pos)) OVER (PARTITION BY {group}) AS most FROM {name} GROUP BY 1, 2)""")
        parts.append(f"""{up} AS (SELECT {keep}, {group},
            CASE WHEN most = 0 THEN pos ELSE pos // 3 END AS pos,
            CASE WHEN most = 0 THEN node ELSE sha256(a || b || c) END AS node,
            CASE WHEN most = 0 THEN proof ELSE proof || CASE pos % 3 WHEN 0 THEN b || c WHEN 1 THEN a || c ELSE a || b END END AS proof,
            CASE WHEN most = 0 THEN folded ELSE sha256(CASE pos % 3 WHEN 0 THEN folded || b || c WHEN 1 THEN a || folded || c ELSE a || b || folded END) END AS folded
            FROM {name} JOIN r{up} ON {group} IS NOT DISTINCT FROM g AND pos // 3 = up)""")

    for level in range(levels):
        climb(f"t{level}", f"t{level + 1}", "part", "doc_id, leaf")
    parts.append(f"""s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM (SELECT DISTINCT source FROM documents)),
        u0 AS (SELECT doc_id, leaf, node AS subroot, 0 AS one, s.pos AS pos, node, proof, folded FROM t{levels} JOIN s ON part IS NOT DISTINCT FROM source)""")
    for level in range(levels):
        climb(f"u{level}", f"u{level + 1}", "one", "doc_id, leaf, subroot")
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified FROM u{levels}"""


ORACLE_OP12 = f"""
    WITH t AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), k AS (
        SELECT c, c - c % 5 AS host, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM t)
    ), turns AS (
        SELECT k.c, 0 AS own, pos, role, text FROM k JOIN t ON t.c = k.host AND pos <= h
        UNION ALL
        SELECT k.c, 1 AS own, pos, role, text FROM k JOIN t ON t.c = k.c AND pos > h
    ), placed AS (
        SELECT c, row_number() OVER w AS d, CAST(strlen(text) AS BIGINT) AS bytes,
               sha256(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '') OVER w) AS node
        FROM turns WINDOW w AS (PARTITION BY c ORDER BY own, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), paths AS (
        SELECT c, d, bytes, node, coalesce(lag(node) OVER (PARTITION BY c ORDER BY d), '') AS parent FROM placed
        UNION ALL SELECT c, 0, 0, '', NULL FROM k
    ), nodes AS (
        SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes, min(parent) AS parent FROM paths GROUP BY node, d
    ), kids AS (SELECT parent, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent),
    below AS (
        SELECT a.node, sum((n.n_convs - 1) * n.bytes) AS saved, count(*) FILTER (WHERE n.node NOT IN (SELECT parent FROM kids)) AS leaves
        FROM nodes n JOIN paths a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.node
    ), ends AS (
        SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
        FROM (SELECT c, node, d = max(d) OVER (PARTITION BY c) AS last FROM paths) WHERE last GROUP BY node
    )
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
           b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
    FROM nodes n JOIN below b ON n.node = b.node LEFT JOIN nodes p ON n.parent = p.node
    LEFT JOIN kids ON kids.parent = n.node LEFT JOIN ends ON ends.node = n.node
"""

ORACLE: dict[str, str] = {
    "op7_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep_id FROM pages
        ), b AS (
            SELECT *, array_to_string(list_transform(range(0, 40), lambda i:
                lpad(bin(strpos('0123456789abcdef', substr(sha1(html), i + 1, 1)) - 1), 4, '0')), '') AS bits
            FROM p
        )
        SELECT page_id,
               CAST(strlen(html) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + 16 * CAST(substr(bits, i * 5 + 1, 1) AS INT) + 8 * CAST(substr(bits, i * 5 + 2, 1) AS INT)
                   + 4 * CAST(substr(bits, i * 5 + 3, 1) AS INT) + 2 * CAST(substr(bits, i * 5 + 4, 1) AS INT)
                   + CAST(substr(bits, i * 5 + 5, 1) AS INT), 1)), '') AS payload_digest,
               CASE WHEN page_id = keep_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keep_id THEN keep_id END AS refers_to
        FROM b
    """,
    "op12_prefix_trie": ORACLE_OP12,
    "op13_merkle_manifest": _merkle_sql(),
}
