"""Places that the driver and every executor can reach, lineage cuts, and thrift in the workers."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text that a worker takes together.
TOGETHER = 2_000_000

_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local master gets a temporary folder; any
    other master is refused, since its executors could not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="vellumine-")
    spark.conf.set("spark.checkpoint.dir", root)
    _made.append(root)
    return root


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one; deleted when the driver ends."""
    uri = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(uri)
    return uri


@atexit.register
def _sweep() -> None:
    from pyarrow import fs

    for uri in _made:
        try:
            where, path = fs.FileSystem.from_uri(uri)
            where.delete_dir(path)
        except Exception:  # noqa: BLE001  the driver is ending; what is gone already needs no deletion
            pass


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result survives lost executors and carries no lineage.
    """
    spark = df.sparkSession
    uri = new_dir(spark, name)
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's, sent as Arrow: lists of rows would start Python workers of another kind on the executors."""
    kind = T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], kind)
    columns = [pa.array(c, to_arrow_type(f.dataType)) for f, c in zip(kind.fields, zip(*rows, strict=True), strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=kind.fieldNames()), kind)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on at most so many rows go to a Python worker at once: texts are long, and a batch stands in the JVM and in the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, rows)


#: Schemes of Hadoop's connectors, and pyarrow's own for the same stores.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "viewfs": "hdfs"}


def open_fs(uri: str):
    """pyarrow file system and path of a URI of Spark's."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}{mark}{rest}")


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores behind it until no column of ``taken`` has the name (case does not tell names apart)."""
    lower = {x.lower() for x in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def by_bytes(batch: pa.RecordBatch, column: int, most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """The batch in slices that hold at most ``most`` bytes of a text column, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def together(texts: list[str], most: int = TOGETHER) -> Iterator[list[str]]:
    """The texts in lists that hold ``most`` characters or a little more."""
    some, size = [], 0
    for x in texts:
        some.append(x)
        size += len(x)
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def release() -> None:
    """Give free memory back to the system: a worker lives on after a task, and others stand beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal(function: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """The function of batches, after whose last one the worker gives free memory back."""

    def run(batches: Iterable) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release()

    return run
