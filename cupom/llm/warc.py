"""WARC archives with one Zstandard dictionary per file.

``write_archives`` turns each partition into archives: the first records of a file train a dictionary
(``SAMPLE_BYTES`` of them at most), which stands compressed in a leading skippable frame; every record
then is a Zstandard frame of its own, made with that dictionary. ``read_archives`` needs the archives
alone: it takes the dictionary from the first frame and cuts the rest at frame boundaries, so memory
is bounded by one record.

Equal payloads of at least ``min_revisit`` bytes are stored once: the row with the smallest id is the
response, the others are ``revisit`` records that carry digest and length of the full payload and refer
to the response. Digests are grouped with map-side aggregation; the equi-join that brings the smallest
id to each row is one that AQE splits where one payload is hot.

Defined results: a null payload is empty; a null URL is left out; a row with a null id is never the
response of others (it revisits the smallest id that has its payload, and is a response if there is
none); rows that repeat the smallest id are all responses; an empty table writes no archive; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from itertools import chain

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cupom.llm.common import stored
from cupom.llm.files import Publisher, open_store

#: Fixed values of the formats: skippable frame of a WARC dictionary, magic of a Zstandard frame.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
#: Records that train a file's dictionary, its size, and the compressed size at which a file ends.
SAMPLE_BYTES, DICT_BYTES, FILE_BYTES = 4 << 20, 64 << 10, 256 << 20
READ_BYTES, BATCH_BYTES = 256 << 10, 8 << 20

MANIFEST = "path string, records long, bytes long, dictionary_bytes long"
RECORDS = "page_id long, target_uri string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) per row; the payload of a revisit is dropped."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    shared = (
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("first_id").isNotNull())
        .select("digest", "first_id")
    )
    revisit = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "digest", F.when(revisit, F.col("first_id")).alias("refers_to")
    )


def _urn(key) -> str:
    return f"<urn:page:{'null' if key is None else key}>"


def _record(page_id, url, payload, payload_bytes, digest, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:  # control characters would break the header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    block = http if refers_to is not None else http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstd.ZstdCompressionDict:
    """A dictionary of the sampled records; their raw content where there are too few to train one."""
    try:
        return zstd.train_dictionary(DICT_BYTES, samples, k=512, d=8)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:], dict_type=zstd.DICT_TYPE_RAWCONTENT)


class _Archive:
    def __init__(self, folder: str, samples: list[bytes]):
        dictionary = train(samples)
        self.file = Publisher(folder, "records", ".warc.zst")
        packed = zstd.ZstdCompressor().compress(dictionary.as_bytes())
        self.file.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.dictionary_bytes, self.records = len(packed), 0
        self.compressor = zstd.ZstdCompressor(dict_data=dictionary, write_checksum=True)

    def add(self, record: bytes) -> None:
        self.file.write(self.compressor.compress(record))
        self.records += 1

    def close(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"path": [self.file.publish()], "records": [self.records], "bytes": [self.file.size], "dictionary_bytes": [self.dictionary_bytes]},
            schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("dictionary_bytes", pa.int64())]),
        )


def write_archives(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``plan_records`` rows under ``folder``; the manifest of finished archives, written too."""

    def task(batches):
        archive, waiting, held = None, [], 0  # records wait until they are enough to train a dictionary
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for row in chain(rows, [None]):
            if row is not None:
                record = _record(*row, date)
                waiting.append(record)
                held += len(record)
            if not waiting or archive is None and row is not None and held < SAMPLE_BYTES:
                continue
            archive = archive or _Archive(folder, waiting)
            for record in waiting:
                archive.add(record)
            waiting, held = [], 0
            if archive.file.size >= file_bytes:
                yield archive.close()
                archive = None
        if archive is not None:
            yield archive.close()

    return stored(records.mapInArrow(task, MANIFEST), "warc-manifest")


def frame_end(buffer: bytes, at: int) -> int | None:
    """End of the frame that starts at ``at``; None if ``buffer`` doesn't hold all of it."""
    if len(buffer) - at < 8:
        return None
    magic, size = struct.unpack_from("<II", buffer, at)
    if magic & 0xFFFFFFF0 == SKIPPABLE & 0xFFFFFFF0:
        end = at + 8 + size
        return end if end <= len(buffer) else None
    if magic != FRAME:
        raise ValueError(f"no Zstandard frame at offset {at}")
    flags = buffer[at + 4]
    single = flags >> 5 & 1
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    last = 0
    while not last:
        if at + 3 > len(buffer):
            return None
        block = int.from_bytes(buffer[at : at + 3], "little")
        last, kind = block & 1, block >> 1 & 3
        at += 3 + (1 if kind == 1 else block >> 3)
    at += 4 * (flags >> 2 & 1)
    return at if at <= len(buffer) else None


def frames(stream):
    """Whole frames of a stream, in order."""
    buffer = b""
    while True:
        more = stream.read(READ_BYTES)
        buffer += more
        at = 0
        while at < len(buffer) and (end := frame_end(buffer, at)) is not None:
            yield buffer[at:end]
            at = end
        buffer = buffer[at:]
        if not more:
            if buffer:
                raise ValueError("the archive ends inside a frame")
            return


def read_archive(uri: str):
    """Parsed records of one archive, as tuples of the columns of RECORDS."""
    fs, path = open_store(uri)
    decompressor = None
    with fs.open_input_stream(path, compression=None) as stream:
        for frame in frames(stream):
            if decompressor is None:
                dictionary = zstd.ZstdDecompressor().decompress(frame[8:])
                kind = zstd.DICT_TYPE_AUTO
                decompressor = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary, dict_type=kind))
                continue
            head, _, block = decompressor.decompress(frame).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
            length = int(re.search(rb"Content-Length: (\d+)", http)[1])
            of = lambda name: None if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) is None else int(m[1])
            uri_ = fields.get("WARC-Target-URI")
            if uri_ is not None:
                uri_ = re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), uri_)
            response = fields["WARC-Type"] == "response"
            stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
            if response and (len(payload) != length or hashlib.sha256(payload).hexdigest() != stated):
                raise ValueError(f"{uri}: {fields['WARC-Record-ID']} doesn't hold the payload that its header states")
            yield of("WARC-Record-ID"), uri_, fields["WARC-Type"], payload if response else None, length, stated, of("WARC-Refers-To")


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """All records of the archives that a manifest lists, a task for each few archives."""
    schema = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def task(batches):
        rows, held = [], 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for row in read_archive(uri):
                    rows.append(row)
                    held += row[4]
                    if held >= BATCH_BYTES or len(rows) >= 10_000:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    # Rows of the manifest are dealt one by one: archives are of like size, and there are few.
    paths = manifest.select("path").repartition(max(2 * spark.sparkContext.defaultParallelism, 1))
    return paths.mapInArrow(task, RECORDS)
