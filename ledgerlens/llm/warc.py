"""WARC archives with a Zstandard dictionary in front.

A ``.warc.zst`` file starts with a skippable frame (magic 0x184D2A5D) that
holds a dictionary trained from the file's own first records; every record
after it is one Zstandard frame compressed with that dictionary, so a record
can be read alone given its offset.

Writing: payload digests are computed in the scan; groups of equal payloads
keep their largest page_id as the ``response``, all others become ``revisit``
records that refer to it. Only groups of two or more are joined back. Each task writes its own files below
the shared folder, with names no other attempt uses, and returns a manifest
row per file; the manifest is written by Spark, so files of failed attempts
are never read. Reading: manifest rows are dealt out to tasks, which stream
one record at a time.

Defined cases: a null payload is empty; a null url gives a record without
WARC-Target-URI; a null page_id gives a record without an id, sorts below all
others and is read back as null; rows repeated with the largest page_id of
their group are all responses; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, partitions, scratch, stored, text_of

#: Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: A file is closed once it has so many bytes; a dictionary has so many, from
#: a sample of so many bytes of the file's first records, in pieces of at most so many.
FILE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, PIECE_BYTES = 64 << 20, 64 << 10, 2 << 20, 8 << 10


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """The fields of a record made by :func:`make_record`, checked against its lengths and digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block, end = rest[:length], rest[length:]
    if end != b"\r\n\r\n" or len(block) != length:
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode().split("Content-Length: ")[1].split("\r\n")[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("a payload does not match its digest")

    def number(name: str) -> int | None:
        text = fields[name].removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number("WARC-Record-ID"),
        "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To") if revisit else None,
        "payload": None if revisit else payload,
    }


def _dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary trained on pieces of the records, so that a few large ones
    are enough; too little to train on gives an empty one."""
    import zstandard

    piece = min(PIECE_BYTES, max(256, sum(map(len, records)) // 64))
    samples = [record[at : at + piece] for record in records for at in range(0, len(record), piece)]
    most = SAMPLE_BYTES // piece
    if sum(map(len, samples)) > SAMPLE_BYTES + PIECE_BYTES and len(samples) > most:  # a large last record: pieces from all over
        samples = [samples[k * len(samples) // most] for k in range(most)]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Writer:
    """Writes records to ``.warc.zst`` files of a folder, one after the other."""

    def __init__(self, folder: str, file_bytes: int, level: int = 3):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(folder)
        self.uri, self.file_bytes, self.level = folder, file_bytes, level
        self.fs.create_dir(self.root, recursive=True)
        self.held: list[bytes] = []
        self.held_bytes, self.out, self.n = 0, None, 0

    def add(self, record: bytes) -> dict | None:
        """The manifest row of the file that this record closed, if any."""
        if self.out is None:
            self.held.append(record)
            self.held_bytes += len(record)
            if self.held_bytes >= min(SAMPLE_BYTES, self.file_bytes):
                self._open()
        else:
            self._write(record)
        return self.close() if self.out is not None and self.size >= self.file_bytes else None

    def _open(self) -> None:
        import zstandard

        dictionary = _dictionary(self.held, DICTIONARY_BYTES)
        self.name = f"part-{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary)
        self.size, self.n = 8 + len(dictionary), 0
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=trained, write_checksum=True)
        held, self.held, self.held_bytes = self.held, [], 0
        for record in held:
            self._write(record)

    def _write(self, record: bytes) -> None:
        frame = self.packer.compress(record)
        self.out.write(frame)
        self.size += len(frame)
        self.n += 1

    def close(self) -> dict | None:
        if self.out is None:
            if not self.held:
                return None
            self._open()
        self.out.close()
        row = {"path": f"{self.uri}/{self.name}", "n_records": self.n, "file_bytes": self.size}
        self.out = None
        return row


def read_file(uri: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one file, one at a time."""
    import zstandard
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(uri)
    with filesystem.open_input_stream(path, compression=None) as stream:
        magic, length = struct.unpack("<II", stream.read(8))
        if magic != SKIPPABLE_MAGIC:
            raise ValueError(f"{uri}: no dictionary frame in front")
        dictionary = stream.read(length)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        frame, parts, data, begun = reader.decompressobj(), [], stream.read(chunk), False
        while data:
            parts.append(frame.decompress(data))
            data, begun = b"", True
            if frame.eof:
                yield b"".join(parts)
                data, parts, begun = frame.unused_data, [], False
                frame = reader.decompressobj()
            data = data or stream.read(chunk)
        if begun:
            raise ValueError(f"{uri}: the last record is cut off")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below
    ``folder``; the manifest (path, n_records, file_bytes) is returned."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("payload")).withColumn("sha", F.sha1("payload"))
    big = rows.where(F.octet_length("payload") >= min_bytes)
    groups = big.groupBy("sha").agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n"))
    copies = stored(groups.where("n > 1").select("sha", "keep_id", F.lit(True).alias("copied")), "warc-copies")
    marked = rows.join(copies, "sha", "left").select(
        "page_id", "url", "sha", "payload", "keep_id", (F.col("copied").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))).alias("revisit")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder, file_bytes)
        done: list[dict] = []
        for batch in batches:
            for page_id, url, sha, payload, keep_id, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                row = writer.add(make_record(page_id, url, payload, digest, keep_id, revisit))
                if row:
                    done.append(row)
        last = writer.close()
        done += [last] if last else []
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("file_bytes", pa.int64())]))

    return stored(map_arrow(marked, run, "path string, n_records bigint, file_bytes bigint"), "warc-manifest")


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the manifest's files. Payloads of responses are
    checked against their digests; ``payloads=False`` leaves them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _READ if payloads else pa.schema(list(_READ)[:-1])
        held, size = [], 0
        for batch in batches:
            for path, n in zip(batch.column("path").to_pylist(), batch.column("n_records").to_pylist(), strict=True):
                seen = 0
                for record in read_file(path):
                    row = parse_record(record)
                    if not payloads:
                        row.pop("payload")
                    held.append(row)
                    size += len(record) if payloads else 200
                    seen += 1
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if seen != n:
                    raise ValueError(f"{path}: {seen} records, {n} were written")
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    dealt = manifest.select("path", "n_records").repartition(partitions(manifest.sparkSession))
    return map_arrow(dealt, run, kinds + (", payload binary" if payloads else ""))


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark: SparkSession = pages.sparkSession
    manifest = write_archives(pages, scratch(spark, "warc"), min_bytes)
    return read_archives(manifest, payloads=False).drop("url")
