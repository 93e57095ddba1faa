"""Runs that go on where they stopped: a checkpoint table, and a streaming runner for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def pending(work: DataFrame, done: DataFrame, keys: list[str], redo: bool = False) -> DataFrame:
    """Work without a finished row; all of it with ``redo``."""
    return work if redo else work.join(done, keys, "left_anti")


def resume(spark: SparkSession, work: DataFrame, keys: list[str], step: Callable[[DataFrame], DataFrame], path: str, schema: str, redo: bool = False) -> DataFrame:
    """Do what is pending, append it, and return the newest row of each key.

    A key that was done again has several rows; the run number tells them apart.
    """
    full = f"{schema}, _run long"
    have = stored(spark, path, full)
    run = (have.agg(F.max("_run")).first()[0] or 0) + 1
    step(pending(work, have, keys, redo)).withColumn("_run", F.lit(run).cast("long")).write.mode("append").parquet(path)
    rows = stored(spark, path, full)
    newest = rows.groupBy(*keys).agg(F.max("_run").alias("_run"))
    return rows.join(newest, [*keys, "_run"]).drop("_run")


def derive(raw: DataFrame, stages: list[Callable[[DataFrame], DataFrame]], start: int = 0) -> DataFrame:
    """Recompute derived columns from stored raw results, from a stage on."""
    for stage in stages[start:]:
        raw = stage(raw)
    return raw


def run_available(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Process the source's new files once, and end; a batch that is run again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        step(batch).withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(out)

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def threads_per_task(reviews: DataFrame) -> DataFrame:
    """Tasks whose reviews come from more than one conversation."""
    return reviews.groupBy("task_id").agg(F.count_distinct("thread_id").alias("n")).where("n > 1")


def protocol_last(events: DataFrame, method: str) -> DataFrame:
    """The last event of a method in each turn (rows: turn_id, seq, method, params)."""
    return events.where(F.col("method") == method).groupBy("turn_id").agg(F.max_by("params", "seq").alias("params"))
