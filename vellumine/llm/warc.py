"""WARC archives: segmented records written, reassembled and decoded.

Responses are stored with chunked transfer framing.  A block longer than a
segment is split: the first segment keeps the record's type, the others are
``continuation`` records, which name the origin record and their number; the
last one gives the total length.  They go to other files than the first.

Reading parses every file, groups segmented records by the origin's id, puts
segments in the order of their numbers, verifies that none is missing and that
the total length is right, and decodes the chunked framing.  A record that
fails a check comes back with ``complete`` false and without payload figures.

A response that others may refer to is named by its page id and payload digest,
so a revisit names the record that holds its payload; the digest and length of
a revisit are those of that record, and have to agree with its own head.

Defined results: a null html is an empty payload; a null page id stays null
and never is what others refer to; repeated rows each get a record (their
names go on with a part of their own, and references give what is common); an
empty table gives no files and no rows; extra columns are ignored, whatever
their names.  A very long page is written in segments, and is whole in memory
when it is written and when its segments are put together.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine.llm._shared import cut, frugal, new_dir, open_fs

#: Smaller payloads are always stored.
LEAST = 100
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PREFIX = "urn:page:"

FILES = "path string, n_records long, n_bytes long"
PARSED = "record_id string, warc_type string, page_id long, url string, declared_digest string, refers_to long, origin_id string, segment int, total_length long, complete boolean, payload_bytes long, payload_digest string, block binary"
RECORDS = "page_id long, url string, warc_type string, refers_to long, complete boolean, payload_bytes long, payload_digest string, payload binary"


def chunked(payload: bytes, size: int = 8192) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%b\r\n" % (len(x), x) for k in range(0, len(payload), size) if (x := payload[k : k + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Entity body of an HTTP response block."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("the HTTP head does not end")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


class _ArchiveFile:
    """One file of gzip members, a record each."""

    def __init__(self, folder_uri: str):
        self.where, folder = open_fs(folder_uri)
        self.where.create_dir(folder, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        self.uri, self.out = f"{folder_uri}/{name}", self.where.open_output_stream(f"{folder}/{name}", compression=None)
        self.n_records = self.n_bytes = 0

    def add(self, head: dict[str, str], block: bytes, level: int) -> None:
        lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in head.items()), b"Content-Length: %d" % len(block)]
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        data = packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()
        self.out.write(data)
        self.n_records += 1
        self.n_bytes += len(data)


def _line(text: str | None) -> str:
    """A header value: line breaks would end it."""
    return "" if text is None else text.replace("\r", "%0D").replace("\n", "%0A")


def write_warc(pages: DataFrame, out_dir: str, segment_bytes: int = 1 << 20, file_bytes: int = 1 << 28, level: int = 3, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a record for each page, and a table ``files`` of the archive files.

    Of pages with equal payloads of at least ``LEAST`` bytes the one with the
    smallest id is stored; the others become revisits that refer to it.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, _ArchiveFile] = {}
        done: list[_ArchiveFile] = []

        def put(kind: str, head: dict[str, str], block: bytes) -> None:
            file = files.get(kind)
            if file is None:
                file = files[kind] = _ArchiveFile(out_dir)
            file.add(head, block, level)
            if file.n_bytes >= file_bytes:
                done.append(files.pop(kind))

        for batch in batches:
            for page_id, url, payload, digest, first, same in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                revisit = first is not None and first != page_id and len(payload) >= LEAST
                named = page_id is not None and not revisit and same in (None, 1) and len(payload) >= LEAST
                record_id = _record_id(page_id, digest) if named else f"{_record_id('' if page_id is None else page_id, digest)[:-1]}:{uuid.uuid4().hex}>"
                head = {"WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Date": date, "WARC-Target-URI": _line(url), "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response"}
                if url is None:
                    del head["WARC-Target-URI"]
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if revisit:
                    head |= {"WARC-Type": "revisit", "WARC-Profile": _PROFILE, "WARC-Refers-To": _record_id(first, digest)}
                    put("main", head, http + b"Content-Length: %d\r\n\r\n" % len(payload))
                    continue
                block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
                if len(block) <= segment_bytes:
                    put("main", head, block)
                    continue
                put("main", head | {"WARC-Segment-Number": "1"}, block[:segment_bytes])
                starts = range(segment_bytes, len(block), segment_bytes)
                for number, at in enumerate(starts, 2):
                    more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "WARC-Segment-Origin-ID": record_id, "WARC-Segment-Number": str(number)}
                    if at == starts[-1]:
                        more["WARC-Segment-Total-Length"] = str(len(block))
                    put("continued", more, block[at : at + segment_bytes])
        done += files.values()
        for file in done:
            file.out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([f.uri for f in done]), pa.array([f.n_records for f in done], pa.int64()), pa.array([f.n_bytes for f in done], pa.int64())], ["path", "n_records", "n_bytes"])

    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Decided on digests and ids alone; only digests that occur again are looked up.
    same = rows.groupBy("digest", "page_id").agg(F.count("*").alias("rows"))
    first = same.groupBy("digest").agg(F.min("page_id").alias("first"), F.min_by("rows", "page_id").alias("same"), F.sum("rows").alias("copies"))
    first = cut(first.where("copies > 1").select("digest", "first", "same"), "warc-copies")
    rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", "first", "same").mapInArrow(frugal(write), FILES).write.parquet(f"{out_dir}/files")


def _record_id(page_id: int | str, digest: str) -> str:
    return f"<{_PREFIX}{page_id}:{digest[:32]}>"


def parse(data: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Heads (names in lower case) and blocks of the records in a stream of gzip members."""
    unpacker, plain, members = zlib.decompressobj(31), [], iter(data)
    rest = b""
    while True:
        if not rest:
            rest = next(members, b"")
            if not rest:
                if plain:
                    raise ValueError("the archive ends within a record")
                return
        plain.append(unpacker.decompress(rest))
        rest = unpacker.unused_data
        if unpacker.eof:
            record, plain, unpacker = b"".join(plain), [], zlib.decompressobj(31)
            head, _, block = record.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("a record does not start with its version")
            fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            yield fields, block[: int(fields["content-length"])]


def _stream(uri: str, size: int = 1 << 20) -> Iterator[bytes]:
    where, path = open_fs(uri)
    with where.open_input_stream(path, compression=None) as file:
        while data := file.read(size):
            yield data


def _page(uri: str | None) -> int | None:
    """Page id in a record id."""
    if not uri or not uri.startswith(f"<{_PREFIX}"):
        return None
    text = uri[len(_PREFIX) + 1 : -1].partition(":")[0]
    return int(text) if text else None


def _figures(block: bytes, declared: str | None) -> tuple[bool, bytes | None]:
    """Whether the block decodes to what its record declares, and the payload."""
    try:
        payload = payload_of(block)
    except ValueError:
        return False, None
    return declared in (None, hashlib.sha256(payload).hexdigest()), payload


def read_warc(spark: SparkSession, out_dir: str, payloads: bool = True) -> DataFrame:
    """All records, as ``RECORDS``; ``payloads`` false leaves the payload column null."""
    paths = spark.read.schema(FILES).parquet(f"{out_dir}/files").select("path")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PARSED.split(", ")]
        types = {"page_id": pa.int64(), "refers_to": pa.int64(), "segment": pa.int32(), "total_length": pa.int64(), "complete": pa.bool_(), "payload_bytes": pa.int64(), "block": pa.binary()}
        rows: list[tuple] = []
        size = 0

        def packed() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, types.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                for head, block in parse(_stream(path)):
                    kind, record_id = head["warc-type"], head["warc-record-id"]
                    digest = head.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    number = head.get("warc-segment-number")
                    total = head.get("warc-segment-total-length")
                    complete = n = found = kept = None
                    if number is not None:
                        kept = block
                    elif kind == "revisit":
                        length = [x.partition(b":")[2] for x in block.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                        complete, n, found = True, int(length[0]) if length else None, digest
                    else:
                        complete, payload = _figures(block, digest)
                        if complete:
                            n, found, kept = len(payload), hashlib.sha256(payload).hexdigest() if digest is None else digest, payload if payloads else None
                    origin = head.get("warc-segment-origin-id", record_id) if number is not None else None
                    rows.append((record_id, kind, _page(record_id), head.get("warc-target-uri"), digest, _page(head.get("warc-refers-to")), origin, None if number is None else int(number), None if total is None else int(total), complete, n, found, kept))
                    size += len(kept or b"") + 500
                    if size > 8_000_000:
                        yield packed()
                        rows, size = [], 0
        if rows:
            yield packed()

    n_files = paths.count()
    if not n_files:
        return spark.createDataFrame([], RECORDS)
    parsed = cut(paths.repartitionByRange(n_files, "path").mapInArrow(frugal(read), PARSED), "warc-parsed")
    whole = parsed.where(F.col("segment").isNull()).select("page_id", "url", "warc_type", "refers_to", "complete", "payload_bytes", "payload_digest", F.col("block").alias("payload"))

    def reassemble(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment", kind="stable")
        first = group.iloc[0]
        totals = group["total_length"].dropna()
        block = b"".join(group["block"])
        complete = list(group["segment"]) == list(range(1, len(group) + 1)) and len(totals) == 1 and int(totals.iloc[0]) == len(block) and pd.notna(group["total_length"].iloc[-1])
        payload = None
        if complete:
            complete, payload = _figures(block, first["declared_digest"])
        good = payload if complete else None
        row = {"page_id": _page(first["origin_id"]), "url": first["url"], "warc_type": first["warc_type"], "refers_to": None, "complete": complete, "payload_bytes": None if good is None else len(good), "payload_digest": None if good is None else hashlib.sha256(good).hexdigest(), "payload": good if payloads else None}
        return pd.DataFrame([row]).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    segments = parsed.where(F.col("segment").isNotNull()).select("origin_id", "segment", "total_length", "warc_type", "url", "declared_digest", "block")
    return whole.unionByName(segments.groupBy("origin_id").applyInPandas(reassemble, RECORDS))


def resolved(records: DataFrame) -> DataFrame:
    """Records whose revisits have the figures of the responses that they refer to; a record that is damaged, or refers to nothing, is an error."""
    records = records.drop("payload")
    damaged = F.raise_error(F.concat(F.lit("damaged or dangling record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?"))))
    stored = cut(records.where("warc_type = 'response' AND page_id IS NOT NULL").select(F.col("page_id").alias("of"), F.col("payload_digest").alias("its"), F.col("payload_bytes").alias("size")).distinct(), "warc-responses")
    again = records.where("warc_type = 'revisit'")
    again = again.join(stored, (again["refers_to"] == stored["of"]) & (again["payload_digest"] == stored["its"]), "left")
    agrees = F.col("complete") & F.col("size").isNotNull() & (F.col("size") == F.col("payload_bytes"))
    again = again.withColumn("payload_bytes", F.when(agrees, F.col("size")).otherwise(damaged.cast("long"))).drop("of", "its", "size")
    whole = records.where("warc_type <> 'revisit'").withColumn("payload_bytes", F.when(F.col("complete"), F.col("payload_bytes")).otherwise(damaged.cast("long")))
    return whole.unionByName(again)


def round_trip(pages: DataFrame, segment_bytes: int = 1 << 14) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and return what the archives hold, without payloads."""
    out_dir = new_dir(pages.sparkSession, "warc")
    write_warc(pages, out_dir, segment_bytes=segment_bytes)
    return resolved(cut(read_warc(pages.sparkSession, out_dir, payloads=False), "warc-records"))
