"""Web archives (WARC 1.1) compressed record by record with a trained Zstandard dictionary.

Each task trains a dictionary on the first records of its archive, embeds it in a leading skippable frame, and writes
every record as a frame of its own, so that a reader can begin at any record and still profits from what records
share. Equal payloads are stored once: one record is the response, the others are revisits that refer to it.

Archives go to the shared folder, through the file system that its URI names. A file's name holds the task attempt:
an attempt that dies leaves a file that no manifest lists.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.llm.common import small_batches
from snapflow.session import settled, shared_path

# Fixed values of the formats.
DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
ZSTD_FRAME = (0xFD2FB528).to_bytes(4, "little")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"

LEAST_SHARED = 1000  # bytes from which an equal payload is stored once
SAMPLE_BYTES, SAMPLE_RECORDS, DICTIONARY_BYTES = 2 << 20, 1000, 64 << 10
ARCHIVE_BYTES = 1 << 30
MANIFEST_NAMES = ["path", "records", "bytes", "dictionary_bytes"]
MANIFEST = "path string, records long, bytes long, dictionary_bytes long"


def decide(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` of every page.

    Of equal payloads of ``LEAST_SHARED`` bytes or more the record with the largest id is the response (every one of
    its rows, if the id repeats), the others revisit it; smaller payloads are all responses. A null payload is empty;
    a null id never is the largest, and stays a response where all ids of a payload are null. The winner is found by a
    pre-aggregated maximum, and the join back can split a hot payload.
    """
    rows = pages.select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{payload_column}`"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = (rows.filter(F.length("payload") >= LEAST_SHARED).groupBy("digest").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
              .filter("n > 1").select(F.concat(F.lit("d"), "digest").alias("k"), "winner"))
    joined = rows.withColumn("k", F.concat(F.lit("d"), "digest")).join(shared, "k", "left").drop("k")
    again = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return joined.select("page_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
                         F.when(again, F.col("winner")).alias("refers_to"))


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to, date: str) -> bytes:
    """One WARC record. A revisit holds the HTTP header only; its Content-Length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Archive:
    """A file being written: records wait until the sample for the dictionary is full."""

    def __init__(self, folder: str, name: str, level: int):
        self.fs, at = pa.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(at, recursive=True)
        self.path, self.at, self.level = f"{folder}/{name}", f"{at}/{name}", level
        self.out = self.fs.open_output_stream(self.at, compression=None)  # the name must not add a second compression
        self.waiting: list[bytes] | None = []
        self.held = self.records = self.size = self.dictionary = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.waiting is None:
            self._put(self.press.compress(data))
            return
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES or len(self.waiting) >= SAMPLE_RECORDS:
            self._start()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _start(self) -> None:
        waiting, self.waiting = self.waiting, None
        words = None
        try:
            words = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, self.held // 8)), [w[:128 << 10] for w in waiting], k=256, d=8)
        except zstandard.ZstdError:
            pass  # too few or too small records for a dictionary: the archive has none
        if words is not None:
            packed = zstandard.ZstdCompressor(level=self.level).compress(words.as_bytes())
            self._put(DICTIONARY_FRAME + len(packed).to_bytes(4, "little") + packed)
            self.dictionary = len(words.as_bytes())
        self.press = zstandard.ZstdCompressor(level=self.level, dict_data=words) if words else zstandard.ZstdCompressor(level=self.level)
        for data in waiting:
            self._put(self.press.compress(data))

    def close(self) -> tuple[str, int, int, int]:
        if self.waiting is not None:
            self._start()
        self.out.close()
        return self.path, self.records, self.size, self.dictionary


def write(records: DataFrame, folder: str, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of ``decide`` as archives below ``folder``, one or more per partition; returns the manifest.

    The manifest is written at once, so that reading it never writes archives again. No rows give no archive.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        archive, done = None, []
        for batch in small_batches(batches, "payload"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to"))):
                if archive is None:
                    archive = _Archive(folder, f"part-{context.partitionId():06d}-{len(done):03d}-{context.taskAttemptId()}.warc.zst", level)
                archive.add(record(*row, date))
                if archive.size >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        columns = list(zip(*done)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], MANIFEST_NAMES)

    return settled(records.mapInArrow(run, MANIFEST))


def embedded_dictionary(head: bytes) -> zstandard.ZstdCompressionDict | None:
    """The dictionary of an archive's leading skippable frame, None if it has none."""
    if head[:4] != DICTIONARY_FRAME:
        return None
    data = head[8:8 + int.from_bytes(head[4:8], "little")]
    if data[:4] == ZSTD_FRAME:
        data = zstandard.ZstdDecompressor().decompress(data)
    return zstandard.ZstdCompressionDict(data)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC header, HTTP header and payload of each record of an uncompressed stream; one record is held at a time."""
    def header() -> dict[str, str]:
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
            fields[name.lower()] = value.strip()
        return fields

    while stream.readline():  # the version line
        fields = header()
        block = io.BytesIO(stream.read(int(fields["content-length"])))
        stream.read(4)
        block.readline()  # the status line
        http = {}
        while (line := block.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            http[name.lower()] = value.strip()
        yield fields, http, block.read()


def read(manifest: DataFrame, id_type: T.DataType | None = None, payloads: bool = False) -> DataFrame:
    """Records of the archives: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest[, payload]``.

    A response's length and digest are taken from its payload, a revisit's from its headers. A response whose payload
    does not match its recorded digest is an error. One task reads one archive, as a stream.
    """
    spark = manifest.sparkSession
    schema = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string" + (", payload binary" if payloads else "")
    arrow = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), *([("payload", pa.binary())] if payloads else [])])

    def of(path: str) -> Iterator[tuple]:
        fs, at = pa.fs.FileSystem.from_uri(path)
        with fs.open_input_stream(at, compression=None) as f:
            start = f.read(8)
        size = int.from_bytes(start[4:8], "little") if start[:4] == DICTIONARY_FRAME else 0
        with fs.open_input_stream(at, compression=None) as f:
            words = embedded_dictionary(f.read(8 + size)) if size else None
            press = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
            for warc, http, payload in parse(io.BufferedReader(press.stream_reader(f, read_across_frames=True), 1 << 20)):
                number = warc["warc-record-id"][1 + len(RECORD_ID):-1]
                digest = base64.b32decode(warc["warc-payload-digest"].partition(":")[2]).hex()
                if warc["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{path}: record {number} does not match its digest")
                refers = warc.get("warc-refers-to")
                yield (number or None, warc.get("warc-target-uri"), warc["warc-type"], refers and refers[1 + len(RECORD_ID):-1],
                       int(http["content-length"]), digest, *([payload] if payloads else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for row in of(path):
                    rows.append(row)
                    held += 200 + (row[4] if payloads else 0)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    kind = (id_type or T.LongType()).simpleString()
    archives = manifest.select("path")
    found = archives.repartition(max(1, archives.count())).mapInArrow(run, schema)
    return found.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_path(spark, 'warc')}-{uuid.uuid4().hex[:8]}"
