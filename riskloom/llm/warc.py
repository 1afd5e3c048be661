"""WARC archives in seekable Zstandard bundles (operator 9).

Records are grouped into frames that decompress on their own; a bundle ends with a seek
table (a skippable frame with the sizes of all frames), and an index maps each record to
its bundle, frame and offset in the frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.files import Replacing, locate
from riskloom.llm.store import Scratch, new_path

#: Smaller payloads are never revisits.
MIN_SHARED_BYTES = 100
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 64 << 20
#: Tasks that read bundles, at most.
MOST_READERS = 20_000
# The seekable format's magic numbers, and the revisit profile's name.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, bundle string, frame long, offset long, length long"
RECORD = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class BundleWriter:
    """Writes one bundle; ``add`` returns the frame and offset of a record."""

    def __init__(self, out) -> None:
        self.out, self.sizes, self.written = out, [], 0
        self.pending = bytearray()
        self.zstd = zstandard.ZstdCompressor(level=3)

    def add(self, record: bytes) -> tuple[int, int]:
        if self.pending and len(self.pending) + len(record) > FRAME_BYTES:
            self.close_frame()
        place = len(self.sizes), len(self.pending)
        self.pending += record
        return place

    def close_frame(self) -> None:
        if self.pending:
            frame = self.zstd.compress(bytes(self.pending))
            self.out.write(frame)
            self.sizes.append((len(frame), len(self.pending)))
            self.written += len(frame)
            self.pending.clear()

    def finish(self) -> None:
        self.close_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


def seek_table(file) -> list[tuple[int, int]]:
    """Where each frame of a bundle begins, and its compressed size."""
    size = file.size()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file does not end with a seek table")
    entry = 12 if flags & 0x80 else 8  # a checksum may follow the sizes
    file.seek(size - 9 - entry * count)
    table, at, frames = file.read(entry * count), 0, []
    for i in range(count):
        packed, _ = struct.unpack_from("<II", table, i * entry)
        frames.append((at, packed))
        at += packed
    return frames


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit that names the record with the same payload."""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Refers-To", record_name(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">") if name else ""
    return int(number) if number else None


def read_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The header fields and block of the record at ``at``, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no record begins here")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    block = data[end + 4 : end + 4 + size]
    return fields, block, end + 4 + size + 4


def record_row(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, record_type, refers_to, payload_bytes, payload_digest, payload. A response's
    size and digest are those of the payload as read; a revisit has them in its header."""
    kind, page = fields["WARC-Type"], _page(fields["WARC-Record-ID"])
    if kind == "revisit":
        return page, kind, _page(fields["WARC-Refers-To"]), int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), None
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    return page, kind, None, len(payload), hashlib.sha256(payload).hexdigest(), payload


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and refers_to (null for responses) of each row of ``pages``.

    Of payloads that stand more than once only digest and smallest id are joined, and Spark
    splits a digest that most rows have."""
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    shared = pages.select(F.col("page_id").cast("long"), html.alias("html")).filter(F.octet_length("html") >= MIN_SHARED_BYTES)
    shared = shared.groupBy(F.sha2("html", 256).alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = shared.filter("n > 1 and first is not null").select("digest", "first")
    return own.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to bundles in ``folder``; returns their index, one row
    per record: page_id, bundle, frame, offset (in the decompressed frame), length.

    Of equal payloads of at least MIN_SHARED_BYTES that of the smallest page_id is a response
    and the others revisit it; where that id stands on several rows all of them are
    responses. A null html is an empty payload, a null url has no target field, a null
    page_id an empty record name (and it is never the one revisited). Very long payloads
    have a frame of their own. Other columns are left behind. An empty table writes no
    bundle. Bundles have the name of the task attempt that wrote them, and only those of
    attempts that ended well are in the index, so lost executors do no harm.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        attempt = uuid4().hex[:12]
        source = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        row = next(source, None)
        while row is not None:
            name, rows = f"part-{part:05d}-{number:04d}-{attempt}.warc.zst", []
            with Replacing(f"{folder}/{name}") as out:
                bundle = BundleWriter(out)
                while row is not None and bundle.written < BUNDLE_BYTES:
                    page_id, url, html, digest, refers_to = row
                    record = record_bytes(page_id, url, html.encode(), digest, refers_to, date)
                    rows.append((page_id, name, *bundle.add(record), len(record)))
                    row = next(source, None)
                bundle.finish()
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), INDEX_TYPES, strict=True)], names=INDEX_NAMES)

    return Scratch(pages.sparkSession, "archives").write(revisits(pages).mapInArrow(work, INDEX), "index")


INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]
INDEX_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
RECORD_NAMES = [x.split()[0] for x in RECORD.split(", ")]
RECORD_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(RECORD_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, RECORD_TYPES, strict=True)], names=RECORD_NAMES)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles in ``index``, frame by frame: page_id, record_type, refers_to,
    payload_bytes, payload_digest, payload."""
    bundles = index.select("bundle").distinct()
    # few names, much to read: as many tasks as bundles allow
    bundles = bundles.repartition(max(1, min(bundles.count(), MOST_READERS)), "bundle")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for name in (n for batch in batches for n in batch.column(0).to_pylist()):
            store, path = locate(f"{folder}/{name}")
            with store.open_input_file(path) as file:
                for at, size in seek_table(file):
                    file.seek(at)
                    data, place, rows = zstd.decompress(file.read(size)), 0, []
                    while place < len(data):
                        fields, block, place = read_record(data, place)
                        rows.append(record_row(fields, block))
                    yield _batch(rows)

    return bundles.mapInArrow(work, RECORD)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """Only the records of the rows in ``index``, by the seek tables: frames without a wanted
    record are not read."""
    frames = index.select("bundle", "frame", "offset", "length")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            held: tuple[str, list] | None = None
            rows, current, data = [], None, b""
            for name, frame, offset in sorted(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), strict=True)):
                store, path = locate(f"{folder}/{name}")
                if (name, frame) != current:
                    with store.open_input_file(path) as file:
                        held = held if held and held[0] == name else (name, seek_table(file))
                        at, size = held[1][frame]
                        file.seek(at)
                        data, current = zstd.decompress(file.read(size)), (name, frame)
                fields, block, _ = read_record(data, offset)
                rows.append(record_row(fields, block))
            if rows:
                yield _batch(rows)

    return frames.mapInArrow(work, RECORD)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes archives in the shared folder and reads all records back."""
    folder = new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
