"""WARC records in seekable Zstandard bundles.

Format. A bundle is a file of independent Zstandard frames, each with whole WARC/1.1 records
up to about ``FRAME_BYTES``; then a skippable frame with the record index; then the seek table
of the Zstandard seekable format (a skippable frame whose last bytes are its footer), so that
any decoder reads a bundle and one that knows the table reads a single frame. The index maps a
record id to its frame and to offset and length within the decompressed frame. Payloads that
occur more than once and have at least ``REVISIT_BYTES`` are stored once: the record with the
largest page_id is the response, others are revisit records that refer to it and keep the HTTP
header, whose Content-Length tells the size of the full payload.

Scale. Payload digests are counted in narrow rows, and only digests that repeat are joined
back, as a skewed join that adaptive execution may split. Bundles are rows of bounded size,
written by Spark's own writer: one file per row, on any file system Spark reaches, and safe
against lost executors and repeated tasks. Nothing passes through the driver.

Defined cases. A null html is an empty payload. Repeated rows get a record each, ids are made
distinct by their place. Rows that share the largest page_id of a payload are all responses; a
row without page_id refers to the response like others, and is a response itself where no row
of its payload has one. A payload longer than a frame makes a frame of its own.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.session import shared_folder

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 16 << 20
LEVEL = 3
# fixed values of the formats: skippable frames, seek table footer, revisit profile
INDEX_MAGIC = 0x184D2A5A
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# the footer's last four bytes as text: Spark's text writer ends every row with a separator
FOOTER_TEXT = struct.pack("<I", FOOTER_MAGIC).decode("latin-1")


# --- one bundle -----------------------------------------------------------------------


def record(page: dict) -> tuple[str, bytes]:
    """(record id, bytes) of a page: a response, or a revisit where ``refers_to`` is set."""
    payload: bytes = page["payload"]
    revisit = page["revisit"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['payload_bytes']}\r\n\r\n".encode()
    block = http if revisit else http + payload
    record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, page['name'])}>"
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id,
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": (page["url"] or "").replace("\r", " ").replace("\n", " "),
        "WARC-Payload-Digest": f"sha1:{page['payload_digest']}",
        "X-Page-ID": "" if page["page_id"] is None else str(page["page_id"]),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "X-Refers-To-Page-ID": str(page["refers_to"])}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return record_id, b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Collects records into frames; ``close`` gives the file's bytes without the last four."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.frame_bytes, self.level = frame_bytes, level
        self.out, self.frame = io.BytesIO(), bytearray()
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, record_id: str, raw: bytes) -> None:
        if self.frame and len(self.frame) + len(raw) > self.frame_bytes:
            self._end_frame()
        self.index.append((record_id, len(self.frames), len(self.frame), len(raw)))
        self.frame += raw

    def _end_frame(self) -> None:
        packed = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(bytes(self.frame))
        self.frames.append((len(packed), len(self.frame)))
        self.out.write(packed)
        self.frame = bytearray()

    @property
    def size(self) -> int:
        return self.out.tell() + len(self.frame)

    def close(self) -> bytes:
        if self.frame:
            self._end_frame()
        index = zstandard.ZstdCompressor(level=self.level).compress(json.dumps(self.index).encode())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = [*self.frames, (8 + len(index), 0)]  # the index frame holds no content
        table = b"".join(struct.pack("<II", *entry) for entry in entries)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table) + 9) + table + struct.pack("<IB", len(entries), 0))
        return self.out.getvalue()


class BundleReader:
    """Random access into a bundle given as bytes."""

    def __init__(self, raw: bytes):
        self.raw = memoryview(raw)
        count, descriptor, magic = struct.unpack("<IBI", self.raw[-9:])
        if magic != FOOTER_MAGIC or descriptor:
            raise ValueError("not a seekable bundle")
        table = self.raw[len(raw) - 9 - 8 * count : len(raw) - 9]
        self.frames, at = [], 0
        for packed, size in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, size))
            at += packed
        start, packed, _ = self.frames.pop()
        if struct.unpack("<I", self.raw[start : start + 4])[0] != INDEX_MAGIC:
            raise ValueError("bundle without a record index")
        index = zstandard.ZstdDecompressor().decompress(self.raw[start + 8 : start + packed])
        self.index = {record_id: tuple(place) for record_id, *place in json.loads(index)}

    def frame(self, number: int) -> bytes:
        start, packed, size = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.raw[start : start + packed], max_output_size=size)

    def read(self, record_id: str) -> bytes:
        """One record; decompresses its frame only."""
        frame, offset, length = self.index[record_id]
        return self.frame(frame)[offset : offset + length]

    def records(self) -> Iterator[tuple[str, bytes]]:
        """All records in order, one frame in memory at a time."""
        at, frame = -1, b""
        for record_id, (number, offset, length) in self.index.items():
            if number != at:
                at, frame = number, self.frame(number)
            yield record_id, frame[offset : offset + length]


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of a record; names in lower case."""
    head, _, rest = raw.partition(b"\r\n\r\n")

    def fields(lines: bytes) -> dict[str, str]:
        pairs = (line.partition(":") for line in lines.decode().split("\r\n")[1:])
        return {name.lower(): value.strip() for name, _, value in pairs}

    warc = fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


# --- tables ---------------------------------------------------------------------------


def planned_records(pages: DataFrame) -> DataFrame:
    """Per page its payload, digest, size and, for a revisit, the page it refers to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")})
    stored = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("stored_as"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "stored_as")
    )
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("stored_as")) & F.col("stored_as").isNotNull(), F.lit(False))
    return (
        rows.join(stored, "payload_digest", "left")
        .withColumn("revisit", revisit)
        .select(
            "page_id", "url", "payload_digest", "payload_bytes", "revisit",
            F.when(F.col("revisit"), F.col("stored_as")).alias("refers_to"),
            F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
        )
    )


def write_bundles(
    pages: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL
) -> None:
    """Write a record per page into bundles under ``path``."""

    def run(batches):
        task, count = TaskContext.get().partitionId(), 0
        bundle = Bundle(frame_bytes, level)
        for batch in batches:
            for at in range(batch.num_rows):
                page = batch.slice(at, 1).to_pylist()[0]
                page["payload"] = page["payload"] or b""
                page["name"] = f"{task}/{count}/{page['page_id']}/{page['payload_digest']}"
                count += 1
                bundle.add(*record(page))
                if bundle.size >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], ["bundle"])
                    bundle = Bundle(frame_bytes, level)
        if bundle.index:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], ["bundle"])

    bundles = planned_records(pages).mapInArrow(run, "bundle binary")
    # the text writer writes a string's bytes as they are, and the separator behind each row
    (
        bundles.select(F.col("bundle").cast("string").alias("value"))
        .write.option("lineSep", FOOTER_TEXT)
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def _bundle_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(bundle, record_id, frame, offset, length) of every record under ``path``."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                index = BundleReader(content.as_py()).index
                places = list(zip(*index.values())) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(index), pa.string()),
                        pa.array(list(index), pa.string()),
                        *(pa.array(list(p), pa.int64()) for p in places),
                    ],
                    ["bundle", "record_id", "frame", "offset", "length"],
                )

    return _bundle_files(spark, path).mapInArrow(
        run, "bundle string, record_id string, frame bigint, offset bigint, length bigint"
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record under ``path`` with what it says of its page; payload null for revisits."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                held = 0
                for record_id, raw in BundleReader(content.as_py()).records():
                    warc, http, payload = parsed(raw)
                    revisit = warc["warc-type"] == "revisit"
                    rows.append(
                        (
                            int(warc["x-page-id"]) if warc["x-page-id"] else None,
                            warc["warc-target-uri"],
                            int(http["content-length"]) if revisit else len(payload),
                            warc["warc-payload-digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest(),
                            warc["warc-type"],
                            int(warc["x-refers-to-page-id"]) if revisit else None,
                            record_id,
                            None if revisit else payload,
                        )
                    )
                    held += len(raw)
                    if held > FRAME_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    return _bundle_files(spark, path).mapInArrow(
        run,
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
        " refers_to bigint, record_id string, payload binary",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "payload"]
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and return what the bundles hold."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_bundles(pages, path)
    return read_records(spark, path)
