"""Exact top-k search by inner product, one term (vector component) at a time.

Rows and queries are dealt to blocks of bounded bytes by a hash and written to
the shared folder.  Each pair of a row block and a query block is a task: for
every term, the rows with a non-zero component are its postings, and the
queries with one scatter weight times component into a dense array of scores,
queries by rows.  A partition step keeps each query's k best rows of the block;
the k best of all blocks follow by a merge on the query.  The driver learns how
many blocks there are, and sees no vector.  Scores are integers, so their order
is exact.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part; a component that another vector lacks counts as zero; ties go to
the smaller id.  A query skips rows with its own id.  A repeated query row gets
its own answer rows; repeated rows are candidates each.  Ids may not be null:
such rows take no part.  No queries or no rows give no rows; extra columns are
ignored, whatever their names.  Scores are ordered exactly up to 38 digits and
larger ones count as equal; a score beyond 64 bits comes back as the nearest
number of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumine.llm._shared import frugal, new_dir, open_fs

#: Bytes of a block of rows or of queries, and scores in a dense array.
BLOCK_BYTES = 16_000_000
SCORES = 4_000_000

_PARTIAL = "query_row string, query_id long, vec_id long, score decimal(38,0)"
_MOST = 10**38 - 1


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """``floor(scale * x)`` of each component, x as double."""

    def floored(x: Column) -> Column:
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole numbers

    return F.transform(vector, floored)


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of components, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == lengths[0]).all():
        return flat.reshape(len(lengths), lengths[0])
    out = np.zeros((len(lengths), lengths.max(initial=0)))
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _integers(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as the narrowest integers that hold every partial score."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(queries.shape[1], 1)
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    if kind is object:
        return (np.array([[int(x) for x in r] for r in m], object).reshape(m.shape) for m in (queries, rows))
    return queries.astype(kind), rows.astype(kind)


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Term-at-a-time accumulation: queries by rows."""
    terms = min(queries.shape[1], rows.shape[1])
    queries, rows = _integers(queries[:, :terms], rows[:, :terms])
    out = np.zeros((len(queries), len(rows)), queries.dtype)
    for t in range(terms):
        weights, postings = np.flatnonzero(queries[:, t]), np.flatnonzero(rows[:, t])
        if len(weights) == len(queries) and len(postings) == len(rows):
            out += np.multiply.outer(queries[:, t], rows[:, t])
        elif len(weights) and len(postings):
            out[np.ix_(weights, postings)] += np.multiply.outer(queries[weights, t], rows[postings, t])
    return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, earlier positions first among equals."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def _written(df: DataFrame, name: str, block_bytes: int) -> tuple[str, int]:
    """Vectors in a folder for each block, and the number of blocks."""
    size = df.agg(F.sum(F.size("v") * 8 + 16).alias("n")).first().n or 0
    n_blocks = -(-size // block_bytes)
    uri = new_dir(df.sparkSession, name)
    if n_blocks:
        block = F.pmod(F.xxhash64("id", "v", F.rand(0)), F.lit(n_blocks)).alias("block")  # repeated rows go to any block
        df.select("id", "v", block).repartition(n_blocks, "block").write.partitionBy("block").parquet(uri)
    return uri, n_blocks


def _block(uri: str, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and components of a block, file by file; the files' names are the same for every reader."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    where, path = open_fs(f"{uri}/block={block}")
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    for name in sorted(x.path for x in found if x.path.endswith(".parquet")):
        with where.open_input_file(name) as file:
            table = pq.read_table(file, columns=["id", "v"]).combine_chunks()
        if table.num_rows:
            yield table.column("id").to_numpy(), _matrix(table.column("v").chunk(0))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each query row."""

    def ready(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))

    spark = rows.sparkSession
    row_uri, n_rows = _written(ready(rows), "topk-rows", block_bytes)
    query_uri, n_queries = _written(ready(queries), "topk-queries", block_bytes)
    tasks = spark.range(0, n_rows * n_queries, 1, max(1, n_rows * n_queries))
    cells = tasks.select((F.col("id") % max(1, n_rows)).alias("r"), F.floor(F.col("id") / max(1, n_rows)).cast("long").alias("q"))
    partial = cells.mapInArrow(frugal(_searcher(row_uri, query_uri, k)), _PARTIAL)
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    low, high = F.lit(-(2**63)), F.lit(2**63 - 1)
    score = F.greatest(F.least("score", high.cast("decimal(38,0)")), low.cast("decimal(38,0)")).cast("long")
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def _searcher(row_uri: str, query_uri: str, k: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, q in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part, (query_ids, queries) in enumerate(_block(query_uri, q)):
                    best: list[tuple[np.ndarray, list]] = [(np.empty(0, np.int64), [])] * len(query_ids)
                    step = max(1, SCORES // max(1, len(query_ids)))
                    for ids, vectors in _block(row_uri, r):
                        for at in range(0, len(ids), step):
                            _search(query_ids, queries, ids[at : at + step], vectors[at : at + step], best, k)
                    lengths = [len(b[0]) for b in best]
                    if any(lengths):
                        names = [f"{q}.{part}.{j}" for j in range(len(best))]
                        scores = [Decimal(max(-_MOST, min(_MOST, int(x)))) for b in best for x in b[1]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(names, lengths)), pa.array(np.repeat(query_ids, lengths)), pa.array(np.concatenate([b[0] for b in best])), pa.array(scores, pa.decimal128(38, 0))],
                            ["query_row", "query_id", "vec_id", "score"],
                        )

    return search


def _search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, best: list, k: int) -> None:
    """Take some rows into each query's best ones."""
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], _scores(queries, vectors[order])
    for q, own in enumerate(query_ids):
        row, others = scores[q], ids
        lo, hi = np.searchsorted(ids, (own, own + 1))
        if hi > lo:
            row, others = np.delete(row, slice(lo, hi)), np.delete(ids, slice(lo, hi))
        top = _best(row, k)
        best[q] = _merge(best[q], others[top], [int(x) for x in row[top]], k)


def _merge(have: tuple[np.ndarray, list], ids: np.ndarray, scores: list, k: int) -> tuple[np.ndarray, list]:
    if not len(have[0]):
        return ids, scores
    both = sorted(zip([-s for s in (*have[1], *scores)], (*have[0].tolist(), *ids.tolist()), strict=True))[:k]
    return np.array([i for _, i in both], np.int64), [-s for s, _ in both]
