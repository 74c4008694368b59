"""The registered queries of this package and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from authweave.llm import (
    decontaminate, embedding_dedup, html_text, merkle, ngram_join, packing, sentencepiece_bpe, spelling, suffix_dedup,
    topk, toxicity, url_filter, warc,
)
from authweave.llm.oracles import OP11, OP12, OP13
from authweave.llm.tables import table

RULES = [  # fixed values: host, path, verdict
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k_quantised(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = toxicity.judge(documents.select("doc_id", "text"), labels)
    return judged.select("doc_id", "held_out", "score", "predicted")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(documents, size=200, with_text=False)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=75)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=2, size=1024)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.digest_documents(table(spark, sf_dir, "documents"), path)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), least=7, twice=2, every=31, times=10)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), every=5).drop("n_steps")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_topk, op2_url_filter, op3_toxicity, op4_embedding_dedup, op5_warc, op6_suffix_dedup, op7_ngram_join, op8_packing, op9_html,
        op10_sentencepiece, op11_decontaminate, op12_spelling, op13_merkle,
    ]
    return {query.__name__: query for query in found}


OP1 = """
WITH quantised AS (
    SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
           list_inner_product(q.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score
    FROM quantised q JOIN quantised r ON q.vec_id <> r.vec_id
    WHERE q.vec_id % 20 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP4 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v,
           sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0),
links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
reached(a, b) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
numbers AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, least.b), vec_id) AS component_id,
       vec_id = coalesce(least(vec_id, least.b), vec_id) AS kept
FROM embeddings LEFT JOIN numbers ON vec_id = numbers.a LEFT JOIN least ON vec_id = least.a
"""

OP2 = """
WITH urls AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
rules(r_host, r_path, r_verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged AS (
    SELECT page_id, host, path,
           (SELECT max_by({'rule': r_host || r_path, 'verdict': r_verdict},
                          length(r_host) + length(r_path))
            FROM rules
            WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
           ) AS best
    FROM urls)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM judged
"""

OP5 = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes
    FROM pages),
named AS (
    SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
           CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS latest
    FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM named
"""

OP7 = """
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
        END AS s
    FROM texts),
tokens AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached(a, b) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, coalesce(least(doc_id, least.b), doc_id) AS component_id
FROM sets LEFT JOIN least ON doc_id = least.a
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": OP1, "op2_url_filter": OP2, "op4_embedding_dedup": OP4, "op5_warc": OP5,
        "op7_ngram_join": OP7, "op11_decontaminate": OP11, "op12_spelling": OP12, "op13_merkle": OP13,
    }
