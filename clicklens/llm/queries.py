"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm.embeddings import embedding_groups
from clicklens.llm.exact import exact_dedup
from clicklens.llm.html import extract_text
from clicklens.llm.lines import document_lines, mark_lines
from clicklens.llm.manifest import merkle_manifest
from clicklens.llm.packing import pack_documents
from clicklens.llm.pieces import sample_pieces
from clicklens.llm.quality import score_quality
from clicklens.llm.secrets import scan_secrets
from clicklens.llm.sharding import shard_documents
from clicklens.llm.simhash import simhash_groups
from clicklens.llm.trie import conversation_trie
from clicklens.llm.urls import Rule, judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents"), words=4, bits=4)


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), shards=40)


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(_table(spark, sf_dir, "documents"), k=2)


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(_table(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id",
        "n_candidates",
        "n_secrets",
        F.col("secret_spans.start").alias("starts"),
        F.crc32("text").alias("text_crc32"),
    )


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(mark_lines(_table(spark, sf_dir, "documents")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle_manifest(_table(spark, sf_dir, "documents"), tampered)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"), family=100, heads=6)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_shards": op3_shards,
    "op4_embeddings": op4_embeddings,
    "op5_pieces": op5_pieces,
    "op6_exact": op6_exact,
    "op7_packing": op7_packing,
    "op8_secrets": op8_secrets,
    "op9_lines": op9_lines,
    "op10_html": op10_html,
    "op11_urls": op11_urls,
    "op12_manifest": op12_manifest,
    "op13_trie": op13_trie,
}

ORACLES: dict[str, str] = {
    "op6_exact": """
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS normal
            FROM documents
        )
        SELECT n.doc_id, g.keep_id, g.group_size,
               n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
               sha256(n.normal) AS text_sha256
        FROM normal n
        JOIN (SELECT normal, max(doc_id) AS keep_id, count(*) AS group_size
              FROM normal GROUP BY normal) g ON g.normal = n.normal
    """,
    "op4_embeddings": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
        ), usable AS (
            SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
            WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
            WHERE a.size > 0 AND b.size > 0 AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9
        ), reach(vec_id, node) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION
            SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.node
        ), roots AS (
            SELECT vec_id, min(node) AS component_id FROM reach GROUP BY vec_id
        )
        SELECT r.vec_id, (SELECT count(*) FROM links WHERE a = r.vec_id) AS n_links,
               r.component_id, r.vec_id = r.component_id AS kept
        FROM roots r
    """,
    "op11_urls": """
        WITH RECURSIVE told AS (
            SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0
                THEN substr(url, strpos(url, '://') + 3) END AS rest
            FROM pages
        ), addresses AS (
            SELECT page_id, url, html,
                   coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail
            FROM told
        ), rules(verdict, rule_host, rule_path) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                   ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
                   ('block', 'net', '/fr/')
        ), tags AS (
            SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^<>]*>')) AS tag
            FROM addresses
            WHERE regexp_matches(html, '(?i)<(?:link|meta)\\b[^<>]*(?:canonical|refresh)')
        ), links AS (
            SELECT url, regexp_extract(tag, '(?i)(?:href|url)\\s*=\\s*["'']?([^"''>\\s]+)', 1) AS target
            FROM tags WHERE regexp_matches(tag, '(?i)\\srel\\s*=\\s*["'']?canonical|http-equiv\\s*=\\s*["'']?refresh')
        ), edges AS (
            SELECT regexp_replace(url, '#.*$', '') AS a, regexp_replace(target, '#.*$', '') AS b
            FROM links WHERE strpos(target, '://') > 0
        ), both_ways AS (
            SELECT a, b FROM edges UNION SELECT b, a FROM edges
        ), reach AS (
            SELECT a, b FROM both_ways
            UNION
            SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b
        ), told_of AS (
            SELECT r.a AS url, regexp_extract(r.b, '://([^/?#]*)', 1) AS host,
                   regexp_extract(r.b, '://[^/?#]*([^?#]*)', 1) AS path, r.b
            FROM reach r
        ), met AS (
            SELECT t.url, arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM told_of t JOIN rules
              ON (t.host = rule_host OR ends_with(t.host, '.' || rule_host)) AND starts_with(t.path, rule_path)
            GROUP BY t.url, t.b
        ), aliases AS (
            SELECT url FROM met GROUP BY url HAVING bool_and(verdict = 'block')
        ), ruled AS (
            SELECT page_id, url, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM addresses JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id, url
        )
        SELECT p.page_id, p.host, p.path, r.rule,
               CASE WHEN r.rule IS NOT NULL THEN r.verdict WHEN a.url IS NOT NULL THEN 'block'
                    ELSE 'allow' END AS verdict,
               CASE WHEN r.rule IS NOT NULL THEN 'rule' WHEN a.url IS NOT NULL THEN 'alias'
                    ELSE 'default' END AS reason
        FROM addresses p
        LEFT JOIN ruled r ON r.page_id = p.page_id AND r.url = p.url
        LEFT JOIN aliases a ON a.url = regexp_replace(p.url, '#.*$', '')
    """,
    "op12_manifest": """
        WITH RECURSIVE crc_steps AS (
            SELECT doc_id, source, lang, n_chars, text, list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(
                    string_split(doc_id::VARCHAR, ''),
                    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda crc, s: xor(xor(crc, s) >> 1, 3988292384::BIGINT * (xor(crc, s) & 1))) AS crc
            FROM documents
        ), told AS (
            SELECT doc_id, lang,
                   CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM crc_steps
        ), leaves AS (
            SELECT doc_id, lang,
                   sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                   sha256(head || coalesce(strlen(changed::VARCHAR) || ':' || changed, '-') || tail) AS tampered
            FROM told
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot
            FROM leaves
        ), nodes(lang, level, slot, digest, n) AS (
            SELECT lang, 0, slot, leaf, count(*) OVER (PARTITION BY lang) FROM placed
            UNION ALL
            SELECT lang, any_value(level) + 1, slot // 2, sha256(string_agg(digest, '' ORDER BY slot)),
                   (any_value(n) + 1) // 2
            FROM nodes WHERE n > 1 GROUP BY lang, slot // 2
        ), subroots AS (
            SELECT lang, digest, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
            FROM nodes WHERE n = 1
        ), tops(level, slot, digest, n) AS (
            SELECT 0, place, digest, count(*) OVER () FROM subroots
            UNION ALL
            SELECT any_value(level) + 1, slot // 2, sha256(string_agg(digest, '' ORDER BY slot)),
                   (any_value(n) + 1) // 2
            FROM tops WHERE n > 1 GROUP BY slot // 2
        ), root AS (
            SELECT digest AS root, level AS top_height FROM tops WHERE n = 1
        ), folds(lang, slot, level, proof, digest) AS (
            SELECT p.lang, p.slot, 0, '', p.tampered FROM placed p
            UNION ALL
            SELECT f.lang, f.slot, f.level + 1,
                   f.proof || coalesce(o.digest, ''),
                   sha256(CASE WHEN (f.slot >> f.level) & 1 = 1 THEN o.digest || f.digest
                               ELSE f.digest || coalesce(o.digest, '') END)
            FROM folds f
            JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang AND f.level < s.height
            LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM f.lang AND o.level = f.level
                 AND o.slot = xor(f.slot >> f.level, 1)
        ), top_folds(lang, slot, place, level, proof, digest) AS (
            SELECT f.lang, f.slot, s.place, 0, f.proof, f.digest
            FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang AND f.level = s.height
            UNION ALL
            SELECT f.lang, f.slot, f.place, f.level + 1,
                   f.proof || coalesce(o.digest, ''),
                   sha256(CASE WHEN (f.place >> f.level) & 1 = 1 THEN o.digest || f.digest
                               ELSE f.digest || coalesce(o.digest, '') END)
            FROM top_folds f
            JOIN root r ON f.level < r.top_height
            LEFT JOIN tops o ON o.level = f.level AND o.slot = xor(f.place >> f.level, 1)
        )
        SELECT p.doc_id, p.leaf, s.digest AS subroot, r.root, sha256(f.proof) AS proof_sha256,
               f.digest AS folded_root, f.digest = r.root AS verified
        FROM top_folds f
        JOIN root r ON f.level = r.top_height
        JOIN placed p ON p.lang IS NOT DISTINCT FROM f.lang AND p.slot = f.slot
        JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
    """,
    "op13_trie": """
        WITH ordered AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
                       strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')
                   )) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), told AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns
            FROM ordered GROUP BY conv_id
        ), crc AS (
            SELECT conv_id, turns, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(
                    string_split(conv_id::VARCHAR, ''),
                    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda crc, s: xor(xor(crc, s) >> 1, 3988292384::BIGINT * (xor(crc, s) & 1)))) % 6 AS h
            FROM told
        ), rebuilt AS (
            SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
            FROM crc c LEFT JOIN told b ON b.conv_id = c.conv_id - c.conv_id % 100
        ), members AS (
            SELECT conv_id, turns[1:d] AS prefix, d, len(turns) = d AS ends
            FROM rebuilt, unnest(range(len(turns) + 1)) AS depths(d)
        ), nodes AS (
            SELECT prefix, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * length(coalesce(prefix[any_value(d)].text, '')) AS saved,
                   sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM members GROUP BY prefix
        ), children AS (
            SELECT p.prefix, count(c.prefix) AS n_children
            FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.prefix[1:p.depth] = p.prefix
            GROUP BY p.prefix
        ), below AS (
            SELECT p.prefix, sum(c.saved) AS saved_tokens, count(*) FILTER (k.n_children = 0) AS n_leaves
            FROM nodes c JOIN children k ON k.prefix = c.prefix
            JOIN nodes p ON p.depth <= c.depth AND c.prefix[1:p.depth] = p.prefix
            GROUP BY p.prefix
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, k.n_children,
               b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n
        JOIN children k ON k.prefix = n.prefix
        JOIN below b ON b.prefix = n.prefix
        LEFT JOIN nodes p ON p.depth = n.depth - 1 AND n.depth > 0 AND n.prefix[1:n.depth - 1] = p.prefix
    """,
}
