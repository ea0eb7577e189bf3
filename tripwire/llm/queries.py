"""Queries of the text operators over the given tables, and their DuckDB SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm import balltree, bytecnn, maxsketch, mixing, phrases
from tripwire.llm.common import load

#: Rules of the URL filter query: (verdict, host, path).
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))
TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.html_template import main_texts
    return main_texts(load(spark, sf_dir, "pages"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.merkle import fingerprint_documents
    return fingerprint_documents(load(spark, sf_dir, "documents"))


def op3_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return balltree.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.warc import archive_pages
    return archive_pages(load(spark, sf_dir, "pages"), min_bytes=1000).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(load(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.cpsjoin import near_duplicates
    return near_duplicates(load(spark, sf_dir, "documents"), width=2, threshold=0.8)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.piece_codec import encode_digests
    return encode_digests(load(spark, sf_dir, "documents"), tokenizer_path())


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.url_trie import judge_urls
    return judge_urls(load(spark, sf_dir, "pages"), URL_RULES)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.toxicity import score_toxicity
    return score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripwire.llm.quality import score_quality
    return score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxsketch.ranked_search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=50)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.identify_languages(load(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(load(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_html_extraction, op2_document_fingerprints, op3_ball_tree_top_k, op4_warc_revisits, op5_source_mixing,
        op6_minhash_near_dedup, op7_sentencepiece, op8_url_filter, op9_toxicity, op10_quality_classifier,
        op11_ranked_search, op12_language_id, op13_phrase_collocations)}


_OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS payload_digest FROM pages),
s AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, payload_digest,
    max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM s
"""

_OP8_SQL = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
h AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, verdict, rh || rp AS rule, row_number() OVER (PARTITION BY page_id
    ORDER BY length(rh) DESC, length(rp) DESC) AS k
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) b ON b.page_id = p.page_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ball_tree_top_k": balltree.ORACLE_SQL, "op4_warc_revisits": _OP4_SQL,
            "op5_source_mixing": mixing.ORACLE_SQL, "op8_url_filter": _OP8_SQL,
            "op11_ranked_search": maxsketch.ORACLE_SQL, "op13_phrase_collocations": phrases.ORACLE_SQL}
