"""Training order: every sequence gets a global slot, shards hold the slots in order.

Documents are encoded, an end token closes each, and the ids are cut into sequences of ``length``. A keyed hash
of (doc_id, text's ids, part) deals sequences to ranges of slots, as many as the text needs at ``range_bytes`` each. A range's task
sorts its n sequences by (doc_id, part, ids) and gives the i-th the slot that a keyed Feistel permutation of
[0, 4^h) with 4^h >= n assigns it, walking the cycle until the slot is below n; global slots follow by adding the sizes of the ranges
before. So slots are a bijection, and depend on the rows and the key alone as long as no (doc_id, text) repeats; it needs no
count of all sequences beforehand, no staged copy and only one shuffle of ids. Each range is a shard of records of
one fixed stride: slot s stands at byte (s - first_slot) * stride of the shard that holds it, and a reader can start, stop and
resume at any slot.

A document's sequences spread over all ranges. Rows of one id with different texts are dealt apart by their ids. Equal rows
(same id, same text) are dealt by how often they came before in their input split, so that a row repeated any number of times
spreads, too: how many of the copies a range gets depends on the splits, and with it the slots, not what is written. Memory per task: an Arrow
batch and 16 bytes for each row of its split, or one range.

Record: doc_id (int64), part (int32), n (int32), then ``length`` ids (16 bits if the vocabulary allows,
else 32), zero after the n-th; little-endian. Defined results: a null text counts as empty, an empty text is one
sequence with the end token alone; a null doc_id is stored as the smallest int64 and read back as null; repeated rows are
written as often as they stand; an empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cupom.llm.common import stored, texts
from cupom.llm.files import Publisher, open_store

HEAD, HEAD_BYTES = "<qii", 16
NO_ID = -(1 << 63)
ROUNDS = 6
#: Records per output batch, bytes that a reader takes at a time, and text per range.
BATCH_ROWS, READ_BYTES, RANGE_BYTES = 4_000, 4 << 20, 16 << 20

WRITTEN = "shard long, path string, records long, stride int"
SEQUENCES = "slot long, shard long, offset long, doc_id long, part int, n_tokens int, ids binary"


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor) over x and the round's key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """Keyed bijection of [0, n)."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        with np.errstate(over="ignore"):
            self.keys = [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64), key & (1 << 64) - 1)]

    def _once(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        with np.errstate(over="ignore"):
            for k in keys:
                left, right = right, left ^ (_mix(right, k) & mask)
        return right << half | left  # halves swapped back: the same rounds, keys reversed, undo it

    def _walk(self, x, keys: list[int]) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), keys)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], keys)
        return x.astype(np.int64)

    def slots(self, numbers) -> np.ndarray:
        return self._walk(numbers, self.keys)

    def numbers(self, slots) -> np.ndarray:
        return self._walk(slots, self.keys[::-1])


def write_shards(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], end_token: int, folder: str, key: int, length: int, wide: bool = False, range_bytes: int = RANGE_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all sequences of ``docs`` in training order; the manifest of the shards, written too.

    ``encoder`` is called in each task and gives the function from a text to its ids.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long") + 1), F.count("*"))).first()[0]
    n_ranges = max(1, -(-total // range_bytes))
    kind = np.dtype("<u4") if wide else np.dtype("<u2")
    stride = HEAD_BYTES + length * kind.itemsize
    own_key = int(_mix(np.array([key & (1 << 64) - 1], np.uint64), 1)[0])

    def deal(batches):
        encode, met = encoder(), Counter()

        def batch():
            documents, parts, contents, times, ids = zip(*cut, strict=True)
            with np.errstate(over="ignore"):
                mixed = _mix(np.array([NO_ID if d is None else d for d in documents], np.int64).view(np.uint64), own_key)
                for more in (contents, parts, times):
                    mixed = _mix(mixed + np.array(more, np.uint64), own_key)
            return pa.RecordBatch.from_arrays([pa.array((mixed % np.uint64(n_ranges)).astype(np.int32)), pa.array(documents, pa.int64()), pa.array(parts, pa.int32()), pa.array(ids, pa.binary())], names=["range", "doc_id", "part", "ids"])

        cut = []
        for given in batches:
            for document, body in zip(given.column(0).to_pylist(), texts(given.column(1)), strict=True):
                ids = np.append(encode(body), end_token)
                if not wide and int(ids.max()) > 0xFFFF:
                    raise ValueError("an id needs more than 16 bits: write wide shards")
                raw = ids.astype(kind).tobytes()
                content = xxhash.xxh64_intdigest(raw)
                row = xxhash.xxh128_digest(b"%d:%d" % (NO_ID if document is None else document, content))
                for part, at in enumerate(range(0, len(raw), length * kind.itemsize)):
                    cut.append((document, part, content, met[row], raw[at : at + length * kind.itemsize]))
                    if len(cut) >= BATCH_ROWS:
                        yield batch()
                        cut = []
                met[row] += 1
        if cut:
            yield batch()

    def write(batches):
        # Ranges come one after the other, each sorted.
        own, records = -1, []

        def done():
            body = bytearray(len(records) * stride)
            for slot, record in zip(Permutation(len(records), key + own).slots(np.arange(len(records))).tolist(), records, strict=True):
                body[slot * stride : slot * stride + len(record)] = record
            file = Publisher(folder, f"shard-{own:08d}", ".bin")
            file.write(bytes(body))
            return pa.RecordBatch.from_pydict({"shard": [own], "path": [file.publish()], "records": [len(records)], "stride": pa.array([stride], pa.int32())})

        for given in batches:
            for number, document, part, ids in zip(*(c.to_pylist() for c in given.columns), strict=True):
                if number != own:
                    if records:
                        yield done()
                    own, records = number, []
                records.append(struct.pack(HEAD, NO_ID if document is None else document, part, len(ids) // kind.itemsize) + ids)
        if records:
            yield done()

    dealt = rows.mapInArrow(deal, "range int, doc_id long, part int, ids binary").repartitionById(n_ranges, F.col("range"))
    written = stored(dealt.sortWithinPartitions("range", "doc_id", "part", "ids").mapInArrow(write, WRITTEN), "order-manifest")
    # A row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first_slot", F.coalesce(F.sum("records").over(before), F.lit(0))).select("shard", "path", "first_slot", "records", "stride")


def read_shard(path: str, first_slot: int, records: int, stride: int, length: int, start: int = 0):
    """(slot, doc_id, part, ids as unsigned 32-bit bytes) from the ``start``-th record on, by offset."""
    fs, name = open_store(path)
    kind = np.dtype("<u2") if stride == HEAD_BYTES + 2 * length else np.dtype("<u4")
    with fs.open_input_file(name) as f:
        f.seek(start * stride)
        at = start
        while at < records:
            block = f.read(min(records - at, max(1, READ_BYTES // stride)) * stride)
            if len(block) < stride:
                raise ValueError(f"{path} ends before record {at}")
            for i in range(0, len(block) - stride + 1, stride):
                doc, part, n = struct.unpack_from(HEAD, block, i)
                yield first_slot + at, None if doc == NO_ID else doc, part, np.frombuffer(block, kind, n, i + HEAD_BYTES).astype("<u4").tobytes()
                at += 1


def read_sequences(spark: SparkSession, manifest: DataFrame, length: int, from_slot: int = 0) -> DataFrame:
    """All sequences from a slot on, read from the shards that a manifest lists."""
    schema = pa.schema([("slot", pa.int64()), ("shard", pa.int64()), ("offset", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("n_tokens", pa.int32()), ("ids", pa.binary())])

    def task(batches):
        rows = []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        for batch in batches:
            for shard, path, first_slot, records, stride in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for slot, doc, part, ids in read_shard(path, first_slot, records, stride, length, max(0, from_slot - first_slot)):
                    rows.append((slot, shard, (slot - first_slot) * stride, doc, part, len(ids) // 4, ids))
                    if len(rows) >= BATCH_ROWS:
                        yield flush()
                        rows = []
        if rows:
            yield flush()

    wanted = manifest.where(F.col("first_slot") + F.col("records") > from_slot)
    return wanted.repartition(max(2 * spark.sparkContext.defaultParallelism, 1)).mapInArrow(task, SEQUENCES)
