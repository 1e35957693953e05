"""WARC archives as seekable Zstandard bundles (operator 4).

Records are grouped into independent Zstandard frames of about ``FRAME_BYTES``; a bundle ends with
a seek table in a skippable frame (sizes of each frame, magic number 0x8F92EAB1), so any frame can
be read alone. The writer returns an index: for each record its bundle, frame, and offset inside
the frame; for each frame its place in the bundle. Of records with equal payloads the one with the
smallest page id is a response, the others are revisits that refer to it; who is which comes from
an aggregation of (digest, smallest id), so a page with very many copies is no hot group.

Bundles are written under unique names below the shared folder; only those named in the written
index count, so tasks that ran twice leave no duplicate records.

Readers are tasks of about ``READ_BYTES`` of archive each, whatever the size of the index. The copies table
is broadcast up to ``BROADCAST_COPIES`` rows; beyond, pages are joined with it by their digest, and the
engine's skew join splits the very common ones.

Defined cases: columns of any other name are not read; a payload larger than a frame is a frame of its own; a null html is an empty payload; a null page id counts as largest (and its records
are named without a number); rows that repeat the smallest id of their payload are responses all;
an empty table gives no bundles and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, qualified, shared_path, small_or_not

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 6
#: Compressed bytes that a reading task gets.
READ_BYTES = 4 << 20
BROADCAST_COPIES = 500_000
#: Format numbers of the seek table.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "kind string, page_id long, bundle string, frame int, frame_at long, frame_bytes long, record_at long, record_bytes long"
CRLF = b"\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the response's head, not its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join((url or 'about:blank').split())}",
        f"WARC-Payload-Digest: sha1:{payload_digest}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_uri(refers_to)}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + CRLF + CRLF


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record in the bytes of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(head["content-length"])
        yield at, head, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer of a bundle: compressed and plain size of every frame."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """The frames named in the last bytes of a bundle (enough of them)."""
    n, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    return [struct.unpack_from("<II", tail, len(tail) - 9 - 8 * (n - i)) for i in range(n)]


def _open(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if not rest:
        raise ValueError(f"{path} names no file system")
    return fs.FileSystem.from_uri(f"file://{rest}" if scheme == "file" and not rest.startswith("//") else path)


class _Bundle:
    """Writes frames to one file; gives the index rows of each finished frame."""

    def __init__(self, folder: str):
        system, inner = _open(folder)
        system.create_dir(inner, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = system.open_output_stream(f"{inner}/{self.name}", compression=None)
        self.frames, self.at, self.buffer, self.waiting = [], 0, bytearray(), []

    def add(self, page_id: int | None, data: bytes) -> None:
        self.waiting.append((page_id, len(self.buffer), len(data)))
        self.buffer += data

    def flush(self, compressor) -> list[tuple]:
        if not self.waiting:
            return []
        packed = compressor.compress(bytes(self.buffer))
        self.out.write(packed)
        rows = [("frame", None, self.name, len(self.frames), self.at, len(packed), 0, len(self.buffer))]
        rows += [("record", p, self.name, len(self.frames), self.at, len(packed), o, n) for p, o, n in self.waiting]
        self.frames.append((len(packed), len(self.buffer)))
        self.at += len(packed)
        self.buffer, self.waiting = bytearray(), []
        return rows

    def close(self) -> None:
        self.out.write(seek_table(self.frames))
        self.out.close()


def write_archives(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``page_id, url, html`` as bundles in ``folder``; returns the written index."""
    folder = qualified(pages.sparkSession, folder)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("sha", F.unhex(F.sha1(F.encode("html", "utf-8"))))
    copies = own.groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    copies = durable(copies.select(F.col("sha").alias("of"), "first_id"), "warc-copies")
    marked = own.join(small_or_not(copies, BROADCAST_COPIES), F.col("sha") == F.col("of"), "left").select(
        "page_id", "url", "html", "first_id", (F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor, bundle = zstandard.ZstdCompressor(level=LEVEL), None
        names = [x.split()[0] for x in INDEX.split(", ")]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            for i in range(b.num_rows):
                page_id, url, html, first_id, revisit = (c[i].as_py() for c in b.columns)
                payload = html.encode()
                bundle = bundle or _Bundle(folder)
                bundle.add(page_id, record(page_id, url, payload, digest(payload), first_id, revisit))
                if len(bundle.buffer) >= frame_bytes:
                    yield table(bundle.flush(compressor))
                    if bundle.at >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if bundle:
            if rows := bundle.flush(compressor):
                yield table(rows)
            bundle.close()

    return durable(marked.mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Read every frame named in the index back, one range of one file at a time:
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``."""
    frames = index.where("kind = 'frame'").select("bundle", "frame_at", "frame_bytes", "record_bytes")
    total = frames.agg(F.coalesce(F.sum("frame_bytes"), F.lit(0))).first()[0]
    frames = frames.repartition(max(1, -(-total // READ_BYTES)), "bundle", "frame_at")
    folder = qualified(index.sparkSession, folder)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"
    number = lambda uri: int(x) if (x := uri[10:-1]) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        system, inner = _open(folder)
        plain = zstandard.ZstdDecompressor()
        for b in batches:
            for bundle, at, size, full in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with system.open_input_file(f"{inner}/{bundle}") as f:
                    data = plain.decompress(f.read_at(size, at), max_output_size=full)
                rows = []
                for _, head, block in parse_records(data):
                    http, _, body = block.partition(b"\r\n\r\n")
                    revisit = head["warc-type"] == "revisit"
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    sha = head["warc-payload-digest"].removeprefix("sha1:")
                    if not revisit and (len(body) != length or digest(body) != sha):
                        raise ValueError(f"record {head['warc-record-id']} in {bundle} is damaged")
                    rows.append((number(head["warc-record-id"]), head["warc-target-uri"], length, sha, head["warc-type"],
                                 number(head["warc-refers-to"]) if revisit else None, None if revisit else body.decode()))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

    return frames.mapInArrow(run, schema)


def read_record(index_row: dict, folder: str) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record by its index row: only its frame is read. ``folder`` names its file system."""
    import zstandard

    system, inner = _open(folder)
    with system.open_input_file(f"{inner}/{index_row['bundle']}") as f:
        data = zstandard.ZstdDecompressor().decompress(f.read_at(index_row["frame_bytes"], index_row["frame_at"]))
    part = data[index_row["record_at"]:index_row["record_at"] + index_row["record_bytes"]]
    return next((h, b) for _, h, b in parse_records(part))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read every record back."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
