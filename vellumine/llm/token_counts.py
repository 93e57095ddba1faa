"""Token counts through a digest cache.

The cache is a table, one folder per tokenizer digest, of content digests and
counts.  A run joins the documents' digests to it, encodes each distinct text
that it lacks once, appends those counts, and joins them to the documents.
The content is normalised only so far as its count allows: null is empty.

Digests are compared before any text moves: the stored counts of this run's
digests are looked up, and texts are gathered for the missing digests alone.

Defined results: repeated rows and ids each keep their row, a null id stays
null; an empty table gives no rows and appends nothing; extra columns are
ignored, whatever their names.  A very long text is counted whole, part by part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine.llm import _chunks
from vellumine.llm._shared import by_bytes, cut, frugal

CACHE = "content_digest binary, n_tokens int"


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file: another version never meets stored counts."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def read_cache(spark: SparkSession, cache_dir: str, version: str) -> DataFrame | None:
    """Stored counts of a tokenizer, None where there are none; runs at the same time may have stored one twice."""
    try:
        return spark.read.schema(CACHE).parquet(f"{cache_dir}/tokenizer={version}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _counter(tokenizer_path: str):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _chunks.held(tokenizer_path, keeps_space=True, counts=True)
        for batch in batches:
            for some in by_bytes(batch, 1, _chunks.TOGETHER):
                counts = tokenizer.many(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(counts, pa.int32())], ["content_digest", "n_tokens"])

    return frugal(count)


#: So many missing digests, of 32 bytes each, are sent to every task; where more are missing, texts move to their digests.
SENT = 200_000


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_dir: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, by way of the cache in ``cache_dir``."""
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("content_digest")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest)
    texts = docs.select(digest, text.alias("text"))

    stored = read_cache(spark, cache_dir, version)
    if stored is None:
        known, lacking = None, texts.groupBy("content_digest").agg(F.first("text").alias("text"))
    else:
        wanted = cut(keyed.select("content_digest").distinct(), "wanted-digests")
        known = cut(stored.join(wanted, "content_digest", "left_semi").dropDuplicates(["content_digest"]), "known-counts")
        misses = cut(wanted.join(known, "content_digest", "left_anti"), "missing-digests")
        if misses.count() <= SENT:
            lacking = texts.join(F.broadcast(misses), "content_digest", "left_semi").groupBy("content_digest").agg(F.first("text").alias("text"))
        else:  # copies meet in each task before they move
            lacking = texts.groupBy("content_digest").agg(F.first("text").alias("text")).join(misses, "content_digest", "left_semi")
    counts = cut(lacking.mapInArrow(_counter(tokenizer_path), CACHE), "new-counts")
    counts.write.mode("append").parquet(f"{cache_dir}/tokenizer={version}")
    if known is not None:
        counts = counts.unionByName(known)
    n = F.col("n_tokens").cast("long")
    return keyed.join(counts, "content_digest").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
