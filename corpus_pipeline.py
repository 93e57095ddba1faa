"""A corpus from ``documents`` to token ids, in stages.

Each stage works on all that the one before it kept.  SQL cannot express the
models and the tokenizer, so there is no ``ORACLE_SQL``; tests compare the
stages with brute force.

Defined results: a null text is empty: it is civil, and goes with the texts
without a letter in the language stage; rows without an id pass the near-copy
stage; repeated rows are one document there, and kept as often as they occur
where they are the one that stays; ties in the mixture are settled by the rows'
content; an empty table gives an empty result; extra columns, whatever their
names, pass all stages but the last.  Very long texts are read whole.

Batches of rows and the tokenizer's memory are kept small, since the workers of
all stages share their executors' memory.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vellumine.llm import jaccard, langid, mixing, sentencepiece_fst, toxicity
from vellumine.llm._shared import cut, small_batches
from vellumine.llm.queries import toxicity_model

#: A source may be read this many times as often as the source that is read least.
MAX_REPEATS = 1.25


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below one half."""
    small_batches(spark)
    return toxicity.keep_civil(docs, toxicity_model(spark, sf_dir))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold text, in the language that they declare as far as the evidence goes."""
    small_batches(spark)
    return langid.keep_identified(docs, langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for each time that the mixture reads them; every source is read at least once."""
    return mixing.mix(docs, max_repeats=MAX_REPEATS).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each reading."""
    small_batches(spark)
    return sentencepiece_fst.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), bounds=sentencepiece_fst.SMALL)


STAGES = [("toxicity", civil), ("language", identified), ("near_copies", distinct), ("mixing", mixed), ("sentencepiece", encoded)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
