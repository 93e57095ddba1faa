"""Token-id files: independent zstandard frames with a trailing seek table.

A shard holds one zstandard frame per document, then a skippable frame with
the document ids, then the seek table of the zstandard seekable format: for
each frame its compressed size, its decompressed size and the low 32 bits of
the XXH64 of its content.  Frames do not depend on one another, so a reader
finds a document's frame in the table and decompresses that frame alone.
That checksum is also the one with which a zstandard frame ends: it is worked
out once on writing, and decompressing verifies it.

Defined results: a null text is an empty document (only the end id); a null
document id sorts first; repeated rows and ids are all written, next to each
other, and may be dealt to several shards; an id that does not fit ``width``
is an error; an empty table gives no shards and no rows; extra columns are
ignored, whatever their names.  A very long text is one frame, which is held
whole; beside it a worker holds a few megabytes of other texts.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine.llm import _chunks
from vellumine.llm._shared import by_bytes, frugal, local_table, new_dir, open_fs

#: Fixed values of the zstandard seekable format.
SKIPPABLE_IDS = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Content of the skippable frame with document ids: width of a token id in bytes, number of documents.
_IDS_HEAD = struct.Struct("<BQ")
#: A null document id in a shard.
_NO_ID = -(2**63)

MANIFEST = "path string, first_id long, last_id long, n_docs long, n_tokens long, n_bytes long"


class ShardWriter:
    """Appends documents' ids to one open shard."""

    def __init__(self, out, width: int, level: int = 3):
        import zstandard

        self.out, self.width = out, width
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.ids: list[int] = []
        self.table: list[bytes] = []
        self.n_tokens = self.n_bytes = 0

    def add(self, doc_ids: Iterable[int | None], coded: list[bytes], end_id: int) -> None:
        """Documents' ids, each as little-endian uint32 bytes; ``end_id`` follows each."""
        end = struct.pack("<I", end_id)
        ids = np.frombuffer(b"".join([y for x in coded for y in (x, end)]), "<u4")
        if self.width < 4 and len(ids) and int(ids.max()) >> 8 * self.width:
            raise ValueError(f"token id {int(ids.max())} does not fit {self.width} bytes")
        raw, at = memoryview(ids.astype(f"<u{self.width}").tobytes()), 0
        for doc_id, x in zip(doc_ids, coded, strict=True):
            size = (len(x) // 4 + 1) * self.width
            frame = self.zstd.compress(raw[at : at + size])
            self.out.write(frame)
            self.ids.append(_NO_ID if doc_id is None else doc_id)
            self.table.append(struct.pack("<II", len(frame), size) + frame[-4:])
            self.n_bytes += len(frame)
            at += size
        self.n_tokens += len(ids)

    def finish(self) -> None:
        body = _IDS_HEAD.pack(self.width, len(self.ids)) + self.zstd.compress(np.array(self.ids, "<i8").tobytes())
        table = b"".join(self.table)
        for magic, content in ((SKIPPABLE_IDS, body), (SKIPPABLE_TABLE, table + struct.pack("<IBI", len(self.ids), CHECKSUM_FLAG, SEEKABLE_MAGIC))):
            self.out.write(struct.pack("<II", magic, len(content)) + content)
            self.n_bytes += 8 + len(content)


class ShardReader:
    """Reads the seek table of a shard; decompresses frames on demand."""

    def __init__(self, file):
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the shard")
        head = size - 9 - 12 * n - 8
        if struct.unpack("<II", self._at(head, 8)) != (SKIPPABLE_TABLE, 12 * n + 9):
            raise ValueError("the seek table is damaged")
        self.table = np.frombuffer(self._at(head + 8, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0], dtype=np.int64)))
        at = int(self.starts[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        body = self._at(at + 8, length)
        self.width, count = _IDS_HEAD.unpack(body[: _IDS_HEAD.size])
        if magic != SKIPPABLE_IDS or count != n:
            raise ValueError("the list of document ids is damaged")
        self.ids = np.frombuffer(self.zstd.decompress(body[_IDS_HEAD.size :], max_output_size=8 * n + 1), "<i8")

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def _plain(self, k: int, stored: memoryview) -> np.ndarray:
        """Content of frame ``k``; decompressing verifies the checksum with which the frame ends."""
        try:
            if bytes(stored[-4:]) != self.table[k, 2].tobytes():
                raise ValueError("checksum")
            raw = self.zstd.decompress(stored, max_output_size=int(self.table[k, 1]))
        except Exception as e:
            raise ValueError(f"frame {k} is damaged") from e
        if len(raw) != self.table[k, 1]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")

    def frame(self, k: int) -> np.ndarray:
        """Ids of one document; no other frame is read."""
        return self._plain(k, memoryview(self._at(int(self.starts[k]), int(self.table[k, 0]))))

    def frames(self, together: int = 8_000_000) -> Iterator[np.ndarray]:
        """Ids of all documents, read from the file's beginning to its end."""
        k = 0
        while k < len(self):
            begin = int(self.starts[k])
            end = max(k + 1, int(np.searchsorted(self.starts, begin + together, "right")) - 1)
            data = memoryview(self._at(begin, int(self.starts[end]) - begin))
            for j in range(k, end):
                at = int(self.starts[j]) - begin
                yield self._plain(j, data[at : at + int(self.table[j, 0])])
            k = end

    def __len__(self) -> int:
        return len(self.table)


def write_token_files(docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> None:
    """Encode every text and write shards, and a ``manifest`` table, to ``out_dir``.

    Documents are dealt by ranges of their id, so shards in the order of
    ``first_id`` hold all documents in ascending order.  ``width`` is the
    number of bytes of a stored id (2 suffices below 65,536).
    """

    @frugal
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _chunks.held(tokenizer_path, keeps_space=False)
        where, folder = open_fs(out_dir)
        writer = path = out = None
        for batch in batches:
            for some in by_bytes(batch, 1, _chunks.TOGETHER):
                if writer is None:
                    where.create_dir(folder, recursive=True)
                    path = f"{folder}/shard-{uuid.uuid4().hex}.ids"  # a retried task writes another file; the manifest names the one that counts
                    out = where.open_output_stream(path)
                    writer = ShardWriter(out, width)
                writer.add(some.column(0).to_pylist(), tokenizer.many(some.column(1).to_pylist()), end_id)
        if writer is not None:
            writer.finish()
            out.close()
            names = ("path", "first_id", "last_id", "n_docs", "n_tokens", "n_bytes")
            known = [None if x == _NO_ID else x for x in (writer.ids[0], writer.ids[-1])]
            row = (f"{out_dir}/{path.rpartition('/')[2]}", *known, len(writer.ids), writer.n_tokens, writer.n_bytes)
            yield pa.RecordBatch.from_pydict({n: pa.array([v], pa.string() if n == "path" else pa.int64()) for n, v in zip(names, row, strict=True)})

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Rows of one id can be dealt to several shards.
    order = ["id", F.xxhash64("text")]
    texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST).write.parquet(f"{out_dir}/manifest")


def _shards(spark: SparkSession, out_dir: str) -> list[tuple]:
    """Path, first and last id, and ids before the shard, in ascending order: one row per shard."""
    rows = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest").collect()
    rows.sort(key=lambda r: (r.first_id is not None, r.first_id, r.last_id is not None, r.last_id, r.path))
    return [(r.path, r.first_id, r.last_id, b) for r, b in zip(rows, accumulate((r.n_tokens for r in rows), initial=0), strict=False)]


def _dealt(spark: SparkSession, shards: list[tuple]) -> DataFrame:
    """A row for each shard, and a task for each row."""
    return local_table(spark, shards, _SHARD).repartitionByRange(len(shards), "path")


_SHARD = "path string, first_id long, last_id long, base long"
_DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_digests(spark: SparkSession, out_dir: str) -> DataFrame:
    """Read all shards back: ids before each document, its number of ids, and their crc32."""
    shards = _shards(spark, out_dir)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                where, name = open_fs(path)
                with where.open_input_file(name) as file:
                    shard = ShardReader(file)
                    counts, crcs = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
                    for k, ids in enumerate(shard.frames()):
                        counts[k], crcs[k] = len(ids), zlib.crc32(ids.astype("<u4"))
                    starts = base + np.concatenate(([0], np.cumsum(counts)))[:-1]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.ids, mask=shard.ids == _NO_ID), pa.array(starts, pa.int64()), pa.array(counts), pa.array(crcs)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    if not shards:
        return spark.createDataFrame([], _DIGESTS)
    return _dealt(spark, shards).mapInArrow(frugal(read), _DIGESTS)


def read_documents(spark: SparkSession, out_dir: str, wanted: list[int]) -> DataFrame:
    """Ids of the wanted documents (doc_id, ids); only their frames are read and decompressed."""
    wanted = sorted(set(wanted))
    shards = [s for s in _shards(spark, out_dir) if any((s[1] is None or s[1] <= w) and w <= s[2] for w in wanted if s[2] is not None)]
    schema = "doc_id long, ids array<long>"

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = open_fs(path)
                with where.open_input_file(name) as file:
                    shard = ShardReader(file)
                    found = np.flatnonzero(np.isin(shard.ids, wanted))
                    ids = [shard.frame(k).astype(np.int64) for k in found]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.ids[found]), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    if not shards:
        return spark.createDataFrame([], schema)
    return _dealt(spark, shards).mapInArrow(frugal(read), schema)


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1, width: int = 2) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and return what the files hold."""
    out_dir = new_dir(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_path, out_dir, end_id, width=width)
    return read_digests(docs.sparkSession, out_dir)
