"""WARC records in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends with the seek table of the
seekable Zstandard format (a skippable frame), so any decoder reads the file and a reader
that wants one record decompresses one frame. The manifest maps a record's id to bundle,
frame, and offset within the frame.

Bundles are written to a folder every executor can reach. Their names are new for every
attempt of a task, and the manifest names only those of attempts that succeeded, so a lost
or repeated task leaves at worst an unnamed file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import small_batches, spare_names
from ordinalis.storage import cut

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20

#: Fixed values of the seekable format: magic numbers of the skippable frame and its footer.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1

#: Fixed values of WARC 1.1: the profile of a revisit that repeats an identical payload.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_DATE = "2024-01-01T00:00:00Z"


def with_revisits(pages: DataFrame, id_col: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """Adds _payload, _sha1 (hex), record_type and refers_to.

    Of rows with equal payloads of at least ``least_bytes`` bytes the smallest id is the
    response and rows with other ids revisit it; equal ids with equal payloads are all
    responses; a null id revisits any other. The payload counts as empty where it is null.
    Columns of the four names added are replaced, others stay; repeated rows are records of
    their own, and an empty table stays empty.
    """
    page, digest, first = spare_names(pages, "_page", "_digest", "_first")
    rows = pages.withColumn("_payload", F.coalesce(payload, F.lit(""))).withColumn("_sha1", F.sha1("_payload"))
    # only digests and ids meet by digest, as a third of all rows may share one; payloads meet by id
    seen = (rows.where(F.octet_length("_payload") >= least_bytes).select(F.col(id_col).alias(page), F.col("_sha1").alias(digest))
            .distinct())
    firsts = (seen.groupBy(F.col(digest).alias("_same")).agg(F.min(page).alias(first), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).where(F.col(first).isNotNull()).drop("_n"))
    # written, so that the join has an exchange of its own on both sides and splits a hot digest
    firsts = cut(firsts, "first-pages")
    again = (seen.join(firsts, seen[digest] == firsts["_same"])
             .where(~F.col(page).eqNullSafe(F.col(first))).select(page, digest, first))
    marked = rows.join(again, F.col(id_col).eqNullSafe(F.col(page)) & (F.col("_sha1") == F.col(digest)), "left")
    return (marked.withColumn("record_type", F.when(F.col(first).isNotNull(), "revisit").otherwise("response"))
            .withColumn("refers_to", F.col(first)).drop(page, digest, first))


def _urn(key) -> str:
    return "<urn:record:none>" if key is None else f"<urn:record:id:{quote(str(key), safe='')}>"


def _key(urn: str) -> str | None:
    return None if urn == "<urn:record:none>" else unquote(urn[len("<urn:record:id:"):-1])


def record(key, url: str | None, payload: bytes, sha1: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record; a revisit has the HTTP header, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(key)}",
             f"WARC-Date: {_DATE}"]
    if url is not None:  # control characters and spaces would end the header line
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "".join(map(chr, range(0x21, 0x7F)))


def parse(data: bytes) -> dict:
    """The parts of a record; a response's payload must have the digest its header names."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    told = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != told or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    return {"_key": _key(fields["WARC-Record-ID"]), "target_uri": fields.get("WARC-Target-URI"),
            "payload": None if revisit else payload, "payload_bytes": told, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "_refers": _key(fields["WARC-Refers-To"]) if revisit else None}


class BundleWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, stream, frame_bytes: int):
        import zstandard

        self._stream, self._frame_bytes = stream, frame_bytes
        self._zstd = zstandard.ZstdCompressor(level=3)
        self._records, self._size, self._frames, self.written = [], 0, [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self._size and self._size + len(data) > self._frame_bytes:
            self._flush()
        at = len(self._frames), self._size
        self._records.append(data)
        self._size += len(data)
        self.written += len(data)
        return at

    def _flush(self) -> None:
        packed = self._zstd.compress(b"".join(self._records))
        self._stream.write(packed)
        self._frames.append((len(packed), self._size))
        self._records, self._size = [], 0

    def close(self) -> None:
        if self._size:
            self._flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self._frames)
        footer = struct.pack("<IBI", len(self._frames), 0, _SEEKABLE)
        self._stream.write(struct.pack("<II", _SKIPPABLE, len(table) + len(footer)) + table + footer)
        self._stream.close()


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, file):
        import zstandard

        self._file, self._zstd = file, zstandard.ZstdDecompressor()
        size = file.size()
        frames, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError("no seek table")
        sizes = struct.unpack(f"<{2 * frames}I", file.read_at(8 * frames, size - 9 - 8 * frames))
        self._packed, self._start = sizes[::2], [0]
        for n in self._packed:
            self._start.append(self._start[-1] + n)

    def frame(self, number: int) -> bytes:
        return self._zstd.decompress(self._file.read_at(self._packed[number], self._start[number]))


def write_bundles(records: DataFrame, folder: str, *, id_col: str, url_col: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write what ``with_revisits`` returned; gives the manifest (id_col, bundle, frame, offset, length).

    The manifest is itself written once, so reading it never writes a bundle again. An empty
    table writes no bundle.
    """
    small_batches(records.sparkSession)
    id_type = dict(records.dtypes)[id_col]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        attempt, writer, number = uuid.uuid4().hex, None, 0
        for batch in batches:
            places = []
            for key, url, payload, sha1, kind, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():06d}-{number:04d}-{attempt}.warc.zst"
                    writer = BundleWriter(system.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                    number += 1
                data = record(key, url, payload.encode("utf-8", "surrogatepass"), sha1, refers, kind == "revisit")
                places.append((key, f"{folder}/{name}", *writer.add(data), len(data)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*places), (batch.schema.field(0).type, pa.string(), pa.int32(),
                                                               pa.int64(), pa.int64()))],
                names=["_id", "bundle", "frame", "offset", "length"]) if places else _no_places(batch)
        if writer is not None:
            writer.close()

    chosen = records.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), "_payload", "_sha1", "record_type", "refers_to")
    manifest = chosen.mapInArrow(write, f"_id {id_type}, bundle string, frame int, offset long, length long")
    return cut(manifest.withColumnRenamed("_id", id_col), "warc-manifest")


def _no_places(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([], t) for t in (batch.schema.field(0).type, pa.string(), pa.int32(), pa.int64(), pa.int64())],
        names=["_id", "bundle", "frame", "offset", "length"])


def read_records(manifest: DataFrame, *, id_col: str) -> DataFrame:
    """(id_col, target_uri, payload, payload_bytes, payload_digest, record_type, refers_to), each
    read back from its frame; payload is null for a revisit, the other values are its response's.

    Rows of one frame that follow each other, as ``write_bundles`` leaves them, open it once.
    """
    id_type = dict(manifest.dtypes)[id_col]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        bundle = reader = number = data = None
        for batch in batches:
            found = []
            for name, frame, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if name != bundle:
                    system, path = fs.FileSystem.from_uri(name)
                    bundle, reader, number = name, BundleReader(system.open_input_file(path)), None
                if frame != number:
                    number, data = frame, reader.frame(frame)
                found.append(parse(data[offset:offset + length]))
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                ("_key", pa.string()), ("target_uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("record_type", pa.string()), ("_refers", pa.string())]))

    rows = manifest.select("bundle", "frame", "offset", "length").mapInArrow(
        read, "_key string, target_uri string, payload binary, payload_bytes long, payload_digest string, "
              "record_type string, _refers string")
    return rows.select(F.col("_key").cast(id_type).alias(id_col), "target_uri", "payload", "payload_bytes",
                       "payload_digest", "record_type", F.col("_refers").cast(id_type).alias("refers_to"))
