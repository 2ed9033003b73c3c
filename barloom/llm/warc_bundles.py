"""Web pages as WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some records, and at its end a seek table (a skippable
frame with the sizes of all others), so any frame can be read alone and any plain decoder reads the whole. An index,
a DataFrame, maps record identifiers to bundle, frame and offset within the frame. Payloads of some size that equal
another page's are stored once; the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches
from barloom.sources.workdir import work_folder

#: Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:barloom:warc")

INDEX = "record_id string, page_id bigint, bundle string, frame int, offset bigint, length bigint"


@dataclass(frozen=True)
class Bundles:
    """Settings: raw bytes after which a frame and a bundle are closed, equal payloads from how many bytes on are
    stored once, and the date that records carry."""

    frame_bytes: int = 256 * 1024
    bundle_bytes: int = 16 * 1024 * 1024
    least_shared: int = 1000
    date: str = "1970-01-01T00:00:00Z"
    level: int = 3
    salts: int = 16


def record_id(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, so that a revisit can name the record it refers to."""
    return f"urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{digest}')}"


def _header(value: str) -> str:
    """A value that cannot end its line."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None,
                date: str) -> tuple[str, bytes]:
    """Identifier and bytes of a record: a response with its payload, or a revisit of another page's."""
    revisit = refers_to is not None
    own = record_id(page_id, digest)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{own}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _header(url)))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to, digest)}>"),
                   ("X-Refers-To-Page-ID", str(refers_to)), ("X-Payload-Length", str(size))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields.append(("Content-Type", "application/http;msgtype=response"))
    return own, _record(fields, http if revisit else http + payload)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: compressed and raw size of each frame."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(place, compressed size, raw size) of each frame, from the last bytes of a bundle."""
    count, descriptor, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table at the end")
    step = 12 if descriptor & 0x80 else 8
    entries, at, out = tail[-9 - step * count : -9], 0, []
    if len(entries) < step * count:
        raise EOFError("the seek table is longer than what was read")
    for k in range(count):
        packed, raw = struct.unpack_from("<II", entries, k * step)
        out.append((at, packed, raw))
        at += packed
    return out


def frames_of(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """The seek table of an open bundle: its last bytes tell how long it is."""
    size = file.size()
    tail = file.read_at(min(size, 9), size - min(size, 9))
    full = min(size, 9 + 12 * struct.unpack("<I", tail[:4])[0])
    return read_seek_table(file.read_at(full, size - full))


def records(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields by lower-case name, block) of each record of a frame."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        if raw[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has no end")
        yield at, stop + 4 - at, fields, raw[start:stop]
        at = stop + 4


def with_references(pages: DataFrame, page_id: str, url: str, html: str, settings: Bundles) -> DataFrame:
    """Rows (page_id, url, payload, digest, size, refers_to) for every page; ``refers_to`` for revisits only.

    Only digests that two pages or more have are joined back, dealt by a salt beside the digest: a payload that a
    third of all pages share meets its response in many tasks.
    """
    payload = F.coalesce(F.encode(F.col(f"`{html}`"), "UTF-8"), F.lit(b""))
    each = bounded_batches(pages).select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"),
    )
    shared = (
        each.filter(F.col("size") >= settings.least_shared)
        .groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1")
        .select(F.col("digest").alias("of_digest"), "response", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))).alias("of_salt"))
    )
    salted = each.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(settings.salts)).cast("int"))
    met = salted.join(shared, (F.col("digest") == F.col("of_digest")) & (F.col("salt") == F.col("of_salt")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return met.select("page_id", "url", "payload", "digest", "size", refers.alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  settings: Bundles = Bundles()) -> DataFrame:
    """Writes a record for every row of ``pages`` into ``folder`` (shared, and new); gives the index (:data:`INDEX`).

    The payload is the html in UTF-8, empty for a null. Of pages with one payload of ``least_shared`` bytes or more the
    one with the largest id is the response, the others revisit it; rows that repeat that id are responses too. A null
    id is never the largest; if all are null, all are responses. An empty table makes no bundle.

    A bundle bears the number of the attempt that wrote it, and the index, a table in ``folder/index`` which Spark
    commits for one attempt of each task, names it. What a failed or repeated attempt leaves is in no index and is never
    read, however it was packed.
    """

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        context, compressor = TaskContext.get(), zstandard.ZstdCompressor(level=settings.level, write_checksum=True)
        number, frame, frames, entries, held = 0, bytearray(), [], [], 0

        def close_frame() -> None:
            nonlocal held
            if frame:
                frames.append((compressor.compress(bytes(frame)), len(frame)))
                held += len(frame)
                frame.clear()

        def close_bundle() -> pa.RecordBatch:
            nonlocal number, frames, entries, held
            close_frame()
            name = f"part-{context.partitionId():05d}-{number:04d}-{context.taskAttemptId()}.warc.zst"
            store.create_dir(root, recursive=True)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                for packed, _ in frames:
                    out.write(packed)
                out.write(seek_table([(len(p), n) for p, n in frames]))
            rows = pa.RecordBatch.from_pylist([e | {"bundle": name} for e in entries], index_schema)
            number, frames, entries, held = number + 1, [], [], 0
            return rows

        for batch in batches:
            for k in range(batch.num_rows):
                page, link, payload, digest, size, refers = (batch[c][k].as_py() for c in range(6))
                own, data = page_record(page, link, payload, digest, size, refers, settings.date)
                entries.append({"record_id": own, "page_id": page, "frame": len(frames), "offset": len(frame), "length": len(data)})
                frame += data
                if len(frame) >= settings.frame_bytes:
                    close_frame()
                if held >= settings.bundle_bytes:
                    yield close_bundle()
        if entries:
            yield close_bundle()

    index_schema = pa.schema(
        [("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()),
         ("offset", pa.int64()), ("length", pa.int64())]
    )
    rows = with_references(pages, page_id, url, html, settings)
    rows.mapInArrow(bundled, INDEX).write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index (:data:`INDEX`) of the archives of a folder."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


def parsed(fields: dict[str, str], block: bytes, keep_payload: bool) -> dict:
    """What a record says; a response whose payload does not have the digest that it carries raises."""
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    payload, refers = None, fields.get("x-refers-to-page-id")
    if fields["warc-type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
    page = fields.get("x-page-id")
    return {
        "page_id": int(page) if page is not None else None,
        "payload_bytes": len(payload) if payload is not None else int(fields["x-payload-length"]),
        "payload_digest": digest, "record_type": fields["warc-type"],
        "refers_to": int(refers) if refers is not None else None, "url": fields.get("warc-target-uri"),
        "payload": payload if keep_payload else None,
    }


_RECORD = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
)


def read_bundles(spark: SparkSession, folder: str, keep_payload: bool = False) -> DataFrame:
    """All records of the bundles that the index of ``folder`` names (:data:`RECORD`), one after the other in a task.

    Payloads are checked, and kept if asked for. A bundle is read frame by frame.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle in batch[0].to_pylist():
                with store.open_input_file(f"{root}/{bundle}") as file:
                    for at, packed, _ in frames_of(file):
                        raw = decompressor.decompress(file.read_at(packed, at))
                        rows = [parsed(f, b, keep_payload) for _, _, f, b in records(raw)]
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return read_index(spark, folder).select("bundle").distinct().mapInArrow(read, RECORD)


def fetch(index: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """The records (:data:`RECORD`, with payloads) of the identifiers in ``wanted.record_id``: only their frames are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle, frame, offset, length in zip(*(batch[c].to_pylist() for c in range(4)), strict=True):
                with store.open_input_file(f"{root}/{bundle}") as file:
                    at, packed, _ = frames_of(file)[frame]
                    raw = decompressor.decompress(file.read_at(packed, at))
                _, _, fields, block = next(records(raw[offset : offset + length]))
                yield pa.RecordBatch.from_pylist([parsed(fields, block, True)], _RECORD)

    found = index.join(wanted.select("record_id").distinct(), "record_id").select("bundle", "frame", "offset", "length")
    return found.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, settings: Bundles = Bundles()) -> DataFrame:
    """Writes ``pages`` to a new shared folder and reads the archives back."""
    folder = work_folder(pages.sparkSession, "warc")
    if write_bundles(pages, folder, settings=settings).isEmpty():
        return pages.sparkSession.createDataFrame([], RECORD)
    return read_bundles(pages.sparkSession, folder)
