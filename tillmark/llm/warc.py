"""Web archives as chunked record tables: write pages to WARC files, read WARC files back.

A payload travels as rows (record, chunk number, bytes) of at most ``chunk_bytes``; neither the writer nor the reader
holds a whole record. The writer appends the chunks of a record to its gzip member as they come. The reader
streams an archive through a fixed buffer and gives one row per chunk with the number of payload bytes so far and
the SHA-256 of the payload so far; the last row's digest is checked against the one declared in the record.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is a response, the
others are revisits that refer to it; smaller payloads are always responses. A null payload is empty. Rows with a
null id refer to the smallest id, or are responses if there is none. Rows that repeat an id and a payload are written
each, with the same type. An empty table gives no archive and an empty result.

Archives are written by the tasks to the shared folder, through any file system that pyarrow knows, under names that no
two attempts share. The manifest, a table, names the archives of the attempts that counted, so files of lost or
repeated attempts are never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.session import materialize, scratch_path

BUFFER = 256 * 1024
LINE = b"\r\n"
CHUNK_COLUMNS = [
    ("archive", pa.string(), "string"), ("target", pa.string(), "string"), ("url", pa.string(), "string"),
    ("record_type", pa.string(), "string"), ("refers_to", pa.string(), "string"), ("declared_digest", pa.string(), "string"),
    ("declared_bytes", pa.int64(), "long"), ("chunk_no", pa.int32(), "int"), ("data", pa.binary(), "binary"),
    ("bytes_so_far", pa.int64(), "long"), ("digest_so_far", pa.string(), "string"), ("last", pa.bool_(), "boolean")]
CHUNK_ARROW = pa.schema([(n, t) for n, t, _ in CHUNK_COLUMNS])
CHUNK_SCHEMA = ", ".join(f"{n} {t}" for n, _, t in CHUNK_COLUMNS)


def described(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    return pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")).select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))


def record_chunks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least_bytes: int = 100, chunk_bytes: int = 1 << 20) -> DataFrame:
    """Rows to be written: the record's fields, chunk_no and data; the chunks of a record follow each other.

    Only the first ids of repeated payloads are joined to the pages: small ones are broadcast by the planner, large
    ones shuffled, and partitions of a hot digest split.
    """
    rows = described(pages, id_col, url_col, payload_col)
    firsts = materialize(
        rows.where(F.col("size") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    typed = rows.join(firsts.where("first_id IS NOT NULL"), "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id").cast("string")))
    body = F.when(F.col("refers_to").isNull(), F.col("size")).otherwise(0)
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((body - 1) / chunk_bytes)).cast("int"))
    return typed.withColumn("body", body).withColumn("chunk_no", F.explode(numbers)).select(
        F.col("page_id").cast("string").alias("target"), "url", "size", "digest", "refers_to", "chunk_no",
        F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
        .otherwise(F.lit(b"")).alias("data"),
        ((F.col("chunk_no") + 1) * F.lit(chunk_bytes).cast("long") >= F.col("body")).alias("last"))


def record_id(target: str | None, digest: str) -> str:
    """The id of the response that revisits of a payload refer to, or of a row's own record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{target} {digest}')}>"


def record_head(target: str | None, url: str | None, size: int, digest: str, refers_to: str | None) -> bytes:
    """The WARC header of a record and the HTTP header that its block begins with."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        # a revisit is referred to by no record, so its id can be drawn and differs between repeated rows
        ("WARC-Record-ID", record_id(target, digest) if refers_to is None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(size)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + (size if refers_to is None else 0)))]
    if target is not None:
        fields.append(("X-Target-Id", target))
    if url is None:
        fields.append(("X-No-URI", "1"))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Id", refers_to)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + LINE + http


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class ArchiveWriter:
    """Appends chunks to gzip members, one per record, and begins a new archive when one is full."""

    def __init__(self, folder: str, archive_bytes: int):
        self.folder, self.archive_bytes = folder.rstrip("/"), archive_bytes
        self.stream = self.member = None
        self.done: list[tuple[str, int, int]] = []

    def add(self, row: dict) -> None:
        if row["chunk_no"] == 0:
            if self.stream is None:
                self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
                system, place = _file_system(self.path)
                self.stream, self.records = system.open_output_stream(place, compression=None), 0
            self.member = zlib.compressobj(1, wbits=31)
            self.stream.write(self.member.compress(
                record_head(row["target"], row["url"], row["size"], row["digest"], row["refers_to"])))
        self.stream.write(self.member.compress(row["data"]))
        if row["last"]:
            self.stream.write(self.member.compress(LINE + LINE) + self.member.flush())
            self.records += 1
            if self.stream.tell() >= self.archive_bytes:
                self.close()

    def close(self) -> None:
        if self.stream is not None:
            size = self.stream.tell()
            self.stream.close()
            self.done.append((self.path, self.records, size))
            self.stream = None


def write_archives(chunks: DataFrame, folder: str | None = None, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write record chunks; the manifest (archive, records, bytes), itself a written table."""
    spark = chunks.sparkSession
    folder = folder or scratch_path(spark, "warc")
    system, place = _file_system(folder)
    system.create_dir(place, recursive=True)
    manifest = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, archive_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                writer.add({n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)})
        writer.close()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(manifest.names, d, strict=True)) for d in writer.done], schema=manifest)

    return materialize(chunks.mapInArrow(write, "archive string, records long, bytes long"), "manifest")


def member_bytes(source: pa.NativeFile) -> Iterator[bytes]:
    """The bytes of all gzip members of a file, in pieces of bounded size."""
    inflate = zlib.decompressobj(wbits=31)
    pending, begun = b"", False
    while True:
        if not pending:
            pending = source.read(BUFFER)
            if not pending:
                if begun and not inflate.eof:
                    raise ValueError("archive ends inside a record")
                return
        if inflate.eof:
            inflate = zlib.decompressobj(wbits=31)
        begun = True
        piece = inflate.decompress(pending, BUFFER)
        pending = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
        if piece:
            yield piece


class Cursor:
    """Reads lines and counted stretches from pieces of bytes."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.held += piece
        return bool(piece)

    def head(self) -> list[bytes] | None:
        """Lines up to an empty one; None at the end of the archive."""
        while (end := self.held.find(LINE + LINE)) < 0:
            if not self._more():
                if self.held.strip():
                    raise ValueError("archive ends inside a header")
                return None
        lines, self.held = self.held[:end].split(LINE), self.held[end + 4:]
        return lines

    def take(self, count: int) -> Iterator[bytes]:
        """The next ``count`` bytes, in pieces."""
        while count:
            if not self.held and not self._more():
                raise ValueError("archive ends inside a payload")
            piece, self.held = self.held[:count], self.held[count:]
            count -= len(piece)
            yield piece


def archive_rows(archive: str, source: pa.NativeFile, chunk_bytes: int, with_data: bool) -> Iterator[dict]:
    """One row per payload chunk of each record of an archive."""
    cursor = Cursor(member_bytes(source))
    while (lines := cursor.head()) is not None:
        fields = dict(line.decode().split(": ", 1) if b": " in line else (line.decode().rstrip(":"), "") for line in lines[1:])
        left = int(fields["Content-Length"])
        http = cursor.head()
        left -= sum(len(x) + 2 for x in http) + 2
        row = {
            "archive": archive, "target": fields.get("X-Target-Id"),
            "url": None if "X-No-URI" in fields else fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "refers_to": fields.get("X-Refers-To-Id"), "declared_bytes": int(fields["X-Payload-Length"]),
            "declared_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:")}
        sha, so_far, number = hashlib.sha256(), 0, 0
        while True:
            size, kept = min(chunk_bytes, left), []
            for piece in cursor.take(size):
                sha.update(piece)
                if with_data:
                    kept.append(piece)
            left -= size
            so_far += size
            yield row | {"chunk_no": number, "data": b"".join(kept) if with_data else None, "bytes_so_far": so_far,
                         "digest_so_far": sha.copy().hexdigest(), "last": left == 0}
            number += 1
            if not left:
                break
        if row["record_type"] == "response" and (so_far, sha.hexdigest()) != (row["declared_bytes"], row["declared_digest"]):
            raise ValueError(f"{archive}: the payload of {row['target']} is not the declared one")
        if b"".join(cursor.take(4)) != LINE + LINE:
            raise ValueError(f"{archive}: a record does not end where it should")


def read_archives(manifest: DataFrame, chunk_bytes: int = 1 << 20, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest``, one task per archive."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                system, place = _file_system(archive)
                held, size = [], 0
                with system.open_input_stream(place, compression=None) as source:
                    for row in archive_rows(archive, source, chunk_bytes, with_data):
                        held.append(row)
                        size += len(row["data"] or b"") + 500
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=CHUNK_ARROW)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=CHUNK_ARROW)

    archives = max(1, manifest.count())  # one row per archive, counted from the file's footer
    return manifest.select("archive").repartition(archives).mapInArrow(read, CHUNK_SCHEMA)


def record_table(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk; length and digest of the full payload, also for revisits."""
    full = F.col("record_type") == "response"
    return chunks.where("last").select(
        "target", "url", F.when(full, F.col("bytes_so_far")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(full, F.col("digest_so_far")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", "refers_to")
