"""WARC archives written from pages and read back as a chunked record table.

Writing: each task streams its pages into one ``.warc.gz`` file, a gzip member
for each record.  A page whose payload another page also has is a ``revisit``
record without the payload.  Reading: a payload arrives as rows of (record,
chunk number), each with the digest and length of the payload so far, so that
no step holds a whole record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from headway.llm.common import AtomicFile, local_or_remote, make_folder

#: Bytes of payload in one row of the record table, and of one read from an archive.
CHUNK_BYTES = 1 << 18

# Fixed values of the WARC 1.1 format.
_VERSION = b"WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "archive string, n_records long, n_bytes long"


def revisits(pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """Which (page, payload digest) revisits which page: ``_id``, ``_sha1``, ``refers_to``.

    Of equal payloads of at least ``min_bytes`` the largest id is the response.
    Rows with a null id revisit it too; rows that repeat the largest id with the
    same payload are responses as well.  Without any non-null id all are responses.
    """
    keyed = pages.select(F.col(id_col).alias("_id"), *_digest(payload_col)).filter(F.col("_bytes") >= min_bytes)
    groups = (
        keyed.groupBy("_sha1", "_bytes")
        .agg(F.max("_id").alias("refers_to"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("refers_to").isNotNull())
        .drop("n")
    )
    return (
        keyed.join(groups, ["_sha1", "_bytes"])
        .filter(~F.col("_id").eqNullSafe(F.col("refers_to")))
        .select("_id", "_sha1", "refers_to")
        .distinct()
    )


def _digest(payload_col: str) -> list:
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    return [F.sha1(payload).alias("_sha1"), F.octet_length(payload).cast("long").alias("_bytes")]


def _record_id(page_id: int | None, sha1: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}:{sha1}:{copy}'.encode()).digest())}>"


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A").encode() for k, v in fields]
    return b"\r\n".join([_VERSION, *lines, b"", b""])


def _record_fields(page_id: int | None, url: str | None, sha1: str, size: int, target: int | None, copy: int, date: str) -> list[tuple[str, str]]:
    fields = [
        ("WARC-Type", "response" if target is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, sha1, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url or ""),
        ("WARC-Payload-Digest", _base32(sha1)),
        ("X-Payload-Length", str(size)),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if target is not None:
        fields += [("WARC-Profile", _REVISIT_PROFILE), ("WARC-Refers-To", _record_id(target, sha1, 0)), ("X-Refers-To-Page-ID", str(target))]
    return fields


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 1,
) -> DataFrame:
    """One record for each row of ``pages``, in archives under ``folder``; returns the manifest, read from there.

    A null payload is empty, a null url is written as an empty target, line
    breaks in a url are percent-encoded, a null id is left out.  Rows that repeat
    an id become records of their own.  Other columns are ignored.
    """
    spark = pages.sparkSession
    make_folder(folder)
    page = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(payload_col).alias("_payload"))
    # one shuffle of the payloads; rows with the same id and payload meet in one task
    key = F.concat_ws(":", F.col("_sha1"), F.col("_id").cast("string")).alias("_key")
    keyed = page.select("*", *_digest("_payload")).select("*", key).repartition("_key")
    known = revisits(page, id_col="_id", payload_col="_payload", min_bytes=min_bytes).select(key, "refers_to")
    whole = F.when(F.col("refers_to").isNull(), F.col("_payload").cast("binary"))
    joined = keyed.join(known, "_key", "left").select("_id", "_url", "_sha1", "_bytes", "refers_to", whole.alias("_payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        out = None
        n_records = n_bytes = 0
        copies: dict[tuple, int] = {}
        with ExitStack() as stack:
            for batch in batches:
                for k in range(batch.num_rows):
                    if out is None:
                        out = stack.enter_context(AtomicFile(name))
                    page_id, url, sha1, size, target = (batch.column(c)[k].as_py() for c in range(5))
                    payload = batch.column(5)[k]
                    copy = copies[page_id, sha1] = copies.get((page_id, sha1), -1) + 1
                    body = b"" if target is not None or not payload.is_valid else memoryview(payload.as_buffer())
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
                    fields = _record_fields(page_id, url, sha1, size, target, copy, date)
                    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(head) + len(body)))]
                    gzip = zlib.compressobj(level, zlib.DEFLATED, 31)
                    written = out.write(gzip.compress(_header(fields) + head))
                    for at in range(0, len(body), CHUNK_BYTES):
                        written += out.write(gzip.compress(body[at : at + CHUNK_BYTES]))
                    written += out.write(gzip.compress(b"\r\n\r\n") + gzip.flush())
                    n_records, n_bytes = n_records + 1, n_bytes + written
        if n_records:
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n_records], "n_bytes": [n_bytes]})

    joined.mapInArrow(write, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


class _Members:
    """The plain bytes of a file of gzip members, read piece by piece."""

    def __init__(self, stream, step: int):
        self.stream, self.step = stream, step
        self.raw, self.plain, self.gzip = b"", bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        """Append at most about one step of plain bytes; False at the end of the file."""
        if self.gzip.eof:
            self.raw, self.gzip = self.gzip.unused_data, zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.stream.read(self.step)
            if not self.raw:
                return False
        self.plain += self.gzip.decompress(self.raw, self.step)
        self.raw = self.gzip.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.plain.find(mark)) < 0:
            if not self._more():
                if self.plain:
                    raise ValueError("the archive ends within a header")
                return None
        found = bytes(self.plain[:at])
        del self.plain[: at + len(mark)]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.plain and not self._more():
                raise ValueError("the archive ends within a record")
            part = bytes(self.plain[:n])
            del self.plain[: len(part)]
            n -= len(part)
            if part:
                yield part


def _fields(header: bytes) -> dict[str, str]:
    lines = header.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not a WARC header: {lines[0][:40]!r}")
    return {k.decode().lower(): v.decode().strip() for k, _, v in (line.partition(b":") for line in lines[1:])}


def records(archive: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """The chunks of all records of one archive, in order.

    (record number, header fields, chunk number, is it the last, chunk, payload
    bytes so far, hex SHA-1 of the payload so far).  A record without payload,
    such as a revisit, has one empty chunk.
    """
    fs, path = local_or_remote(archive)
    with fs.open_input_stream(path, compression=None) as stream:
        source, n = _Members(stream, chunk_bytes), 0
        while (header := source.until(b"\r\n\r\n")) is not None:
            fields = _fields(header)
            left = int(fields["content-length"])
            http = source.until(b"\r\n\r\n")
            left -= len(http) + 4
            sha1, size, k, held = hashlib.sha1(), 0, 0, bytearray()
            for part in source.take(left):
                held += part
                while len(held) > chunk_bytes:
                    chunk = bytes(held[:chunk_bytes])
                    del held[:chunk_bytes]
                    sha1.update(chunk)
                    size += len(chunk)
                    yield n, fields, k, False, chunk, size, sha1.hexdigest()
                    k += 1
            sha1.update(held)
            yield n, fields, k, True, bytes(held), size + len(held), sha1.hexdigest()
            if b"".join(source.take(4)) != b"\r\n\r\n":
                raise ValueError("a record is not closed")
            n += 1


RECORD_TABLE = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("record", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("is_last", T.BooleanType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)


def read_archives(spark: SparkSession, folder: str, *, chunk_bytes: int = CHUNK_BYTES, data: bool = True) -> DataFrame:
    """The chunked record table of all archives in ``folder``.

    ``payload_bytes`` and ``payload_digest`` are of the payload up to the end of
    the chunk; in the last chunk, of the whole payload.  For a revisit, whose
    payload is elsewhere, they are what its header says.  A digest that differs
    from the header's raises an error.  ``data=False`` leaves the bytes out.
    """
    archives = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select("archive")
    manifest = archives.repartitionByRange(max(1, archives.count()), "archive")  # a task for each file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema(
            [(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in RECORD_TABLE.fields]
        )
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, held = [], 0
                for n, fields, k, last, chunk, size, digest in records(archive, chunk_bytes):
                    told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if fields["warc-type"] == "revisit":
                        size, digest = int(fields["x-payload-length"]), told
                    elif last and digest != told:
                        raise ValueError(f"{archive}, record {n}: payload digest {digest}, header {told}")
                    page, target = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append(
                        (
                            archive,
                            n,
                            fields["warc-record-id"],
                            fields["warc-type"],
                            None if page is None else int(page),
                            fields["warc-target-uri"],
                            None if target is None else int(target),
                            k,
                            last,
                            size,
                            digest,
                            chunk if data else None,
                        )
                    )
                    held += len(chunk) if data else 0
                    if len(rows) >= 4096 or held >= 16 * CHUNK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)

    return manifest.mapInArrow(read, RECORD_TABLE)
