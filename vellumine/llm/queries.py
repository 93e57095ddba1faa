"""What the driver runs: one query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine.llm import fingerprint, jaccard, langid, mixing, sentencepiece_fst, token_counts, token_files, topk, toxicity, warc
from vellumine.llm._shared import cut, new_dir

#: Highest number of passes over a source in the mixture.
MAX_REPEATS = 2.0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and length and digest of the text that they decode to."""
    return sentencepiece_fst.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return fingerprint.compare_with_next(_table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.OrdinalModel:
    labels = _table(spark, sf_dir, "labels").select("doc_id", toxicity.grades(F.col("toxic"), F.col("quality")).alias("grade"))
    return toxicity.fit(_table(spark, sf_dir, "documents"), labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return toxicity.rate_documents(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, read back from them."""
    return token_files.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, width=2)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document; the cache starts empty."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), new_dir(spark, "token-counts"), limit=512)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best vectors for each fiftieth vector."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    rows = rows.where(topk.usable(F.col("vector"))).withColumn("vector", topk.quantised(F.col("vector")))
    return topk.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document."""
    return jaccard.link_documents(_table(spark, sf_dir, "documents"), percent=80)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    return langid.identify_pages(_table(spark, sf_dir, "pages"), langid.fit(_table(spark, sf_dir, "documents")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of every document in a mixture of as many words as the corpus has."""
    docs = cut(_table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("words")), "mixing-words")
    mixed = mixing.mix(docs, whole_corpus=True, max_repeats=MAX_REPEATS, n_tokens=F.col("words"))
    return mixed.select("doc_id", "source", F.col("_epoch").alias("epoch"), F.col("_n_tokens").alias("n_tokens"), F.col("_start").alias("start"), F.col("_position").alias("position"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_sentencepiece, op2_fingerprints, op3_toxicity, op4_token_files, op5_token_counts, op6_topk, op7_jaccard, op8_language, op9_warc, op10_mixing)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op6_topk": _TOPK, "op7_jaccard": _JACCARD, "op9_warc": _WARC}


_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS t
  FROM w
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS MATERIALIZED (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edge AS MATERIALIZED (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN f.first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON f.digest = p.digest
"""
