"""Removal of passages that an earlier document has too, by sorting suffixes deep and shallow.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id. Strings of
two documents have to meet without sending every suffix, so each string belongs to its anchor: of
the ``GRAM``-byte strings inside it, the one with the smallest hash. Equal strings have equal
anchors. Text is kept in blocks of ``BLOCK`` bytes or so, one row each, and blocks talk to buckets of anchor hashes:

1. every block sends the distinct hashes of its anchors; a bucket answers with a bit for each that another block has too;
2. for those anchors (and those that several of its documents share) a block sends the text around them once per distinct
   context, with the smallest id that has it; a bucket sorts all ``LENGTH``-byte suffixes of its distinct contexts, finds the smallest id of each
   distinct one, and answers with a bit for each: does a smaller id have it than the smallest of the context?
3. the block removes what is covered.

The sort is deep-shallow: multikey quicksort on eight-byte letters down to ``SHALLOW`` bytes, all open groups parted three ways
in one round; groups that still tie are ordered by blind tries of their distinct rests. A group that a third
of all documents shares sends one context per block, so no bucket gets it whole. Messages to buckets are
proportional to the text and go through ordinary shuffles. Blocks are written to the shared folder once and never shuffled: answers are
grouped by block and posted as one small file per block beside them, complete before the step that reads them starts, under names that a
repeated task finds again. Every block has its post, if only an empty one: a lost file is an error, not "nothing shared". A task holds one block, or one bucket's messages (the number of buckets grows with the text).

Defined results: a null text is empty; a null id counts as larger than any; rows with equal ids don't
remove from each other; texts below ``LENGTH`` bytes stay whole; empty tables give no rows; all given columns stay, the text
without what was removed (``kept`` has its exact bytes; in the text, a character of which a part was removed goes
entirely), those named like a result are replaced.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyarrow.fs import FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.llm.common import claim, stored, text_bytes
from cupom.llm.files import open_store
from cupom.llm.words import _BASE, _VALUES, groups, powers
from cupom.session import scratch_path

LENGTH, GRAM, SHALLOW = 50, 32, 24
WINDOW = LENGTH - GRAM + 1
#: A block is small enough to be no huge object in the JVM once it is compressed; larger ones mean fewer messages.
BLOCK, CHUNK, SLICE = 1 << 20, 1 << 20, 1 << 20
#: Text per bucket.
BUCKET_BYTES = 8 << 20
RESULTS = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
NO_ID = np.iinfo(np.int64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (a view)."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


def gram_hashes(data: np.ndarray, start: int, end: int) -> np.ndarray:
    """Hashes of the GRAM bytes at places start .. end - 1; ``data`` has at least GRAM bytes after each."""
    eights = _eights(data)
    with np.errstate(over="ignore"):
        total = eights[start:end] * np.uint64(0x9E3779B97F4A7C15)
        for i in range(8, GRAM, 8):
            total = _mix(total) + eights[start + i : end + i] * np.uint64(0xC2B2AE3D27D4EB4F)
        return _mix(_mix(total))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first string, number of strings, text) of every anchor in a block's texts.

    ``data`` has LENGTH spare bytes at its end. An anchor's strings start at consecutive places.
    """
    n = int(offsets[-1])
    # A string starts at every place of a text but its last LENGTH - 1.
    change = np.zeros(n + 1, np.int32)
    last = np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
    np.add.at(change, offsets[:-1], 1)
    np.add.at(change, last, -1)
    valid = np.cumsum(change[:-1], dtype=np.int32) > 0
    out = []
    mask = np.uint64((1 << 22) - 1)
    for start in range(0, n, CHUNK):
        end = min(n, start + CHUNK)
        hashes = gram_hashes(data, start, end + WINDOW - 1)
        least = hashes & ~mask | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= WINDOW:  # minima of 2, 4, 8 ... neighbours
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: end - start], least[WINDOW - width : WINDOW - width + end - start])
        at = np.flatnonzero(valid[start:end])
        if len(at) == 0:
            continue
        place = (least[at] & mask).astype(np.int64)
        turn = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]))
        out.append((hashes[place[turn]], at[turn] + start, np.diff(np.concatenate([turn, [len(at)]]))))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, first, number = (np.concatenate(x) for x in zip(*out, strict=True))
    return hashes, first, number, np.searchsorted(offsets, first, "right") - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1 ... of each range, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def range_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each range of bytes, a slice of them at a time."""
    out = np.zeros(len(starts), np.uint64)
    ends = np.cumsum(lengths)
    a = 0
    power = powers(int(lengths.max()) if len(lengths) else 1)
    with np.errstate(over="ignore"):
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE, "right")))
            n = lengths[a:b]
            place = ragged(np.zeros(b - a, np.int64), n)
            parts = _VALUES[data[place + np.repeat(starts[a:b], n)]] * power[place]
            out[a:b] = np.add.reduceat(parts, np.cumsum(n) - n)
            a = b
        return _mix(out * _BASE)


# ---------------------------------------------------------------- deep-shallow sort


def blind_trie(strings: list[bytes]) -> list[int]:
    """Order of distinct strings of one length, by a trie whose inner nodes know only where to look.

    A string descends by its letters at the nodes' places alone and is then compared once, with the leaf it reached; that
    tells where it parts, and it is inserted there.
    """
    root: object = 0
    for n in range(1, len(strings)):
        s, node = strings[n], root
        while type(node) is not int:
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        other, part = strings[node], 0
        while s[part] == other[part]:
            part += 1
        above, node = None, root
        while type(node) is not int and node[0] < part:
            above, node = node, node[1][s[node[0]]]
        if type(node) is not int and node[0] == part:
            node[1][s[part]] = n
            continue
        inner = (part, {other[part]: node, s[part]: n})
        if above is None:
            root = inner
        else:
            above[1][s[above[0]]] = inner
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is int:
            order.append(node)
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return order


def deep_shallow(text: np.ndarray, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): ``starts[order]`` is sorted by the ``length`` bytes from there on; equal strings share a group number.

    ``text`` has eight spare bytes at its end.
    """
    n = len(starts)
    order, head = np.arange(n), np.zeros(n, bool)
    if n == 0:
        return order, order
    head[0] = True
    _multikey(text, starts, order, head, length, min(shallow, length))
    tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
    if len(tied) and shallow < length:
        _deep(text, starts, order, head, tied, shallow, length)
    return order, np.cumsum(head) - 1


def _letters(eights: np.ndarray, places: np.ndarray, depths: np.ndarray, length: int) -> np.ndarray:
    """The letters of eight bytes at ``depths`` of the strings at ``places``, without what lies past ``length``."""
    letter = eights[places + depths].byteswap()
    short = np.maximum(8 - (length - depths), 0).astype(np.uint64)
    return letter >> (short * np.uint64(8)) << (short * np.uint64(8)) if short.any() else letter


def _multikey(text, starts, order, head, length, shallow) -> None:
    """Multikey quicksort to ``shallow`` bytes: every open group is parted around a pivot letter of its own.

    A round parts all open groups at once: smaller letters and larger ones stay at the group's depth, equal ones go
    on to the next letter. Strings come in random order, so that the median of three is as good as any three draws. A
    group is closed once it has one string or is equal down to ``shallow``.
    """
    eights = _eights(text)
    item = np.random.default_rng(len(starts)).permutation(len(starts))
    place, size, depth = np.zeros(1, np.int64), np.array([len(starts)]), np.zeros(1, np.int64)
    letter = _letters(eights, starts[item], np.zeros(len(item), np.int64), length)
    while len(item):
        first = np.cumsum(size) - size
        one, two, three = letter[first], letter[first + size // 2], letter[first + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(one, two), np.minimum(np.maximum(one, two), three)), size)
        below, above = letter < pivot, letter > pivot
        n_below, n_above = np.add.reduceat(below, first, dtype=np.int64), np.add.reduceat(above, first, dtype=np.int64)
        n_same = size - n_below - n_above
        parted, sorted_letter = np.empty_like(item), np.empty_like(letter)
        for which, begin, count in ((below, first, n_below), (~(below | above), first + n_below, n_same), (above, first + n_below + n_same, n_above)):
            target = ragged(begin, count)
            parted[target], sorted_letter[target] = item[which], letter[which]
        # Three groups for each; those without a string vanish.
        begin = np.stack([place, place + n_below, place + n_below + n_same], 1).ravel()
        count = np.stack([n_below, n_same, n_above], 1).ravel()
        deeper = np.stack([depth, depth + 8, depth], 1).ravel()
        same = np.tile([False, True, False], len(size))
        some = count > 0
        place, size, depth, same = begin[some], count[some], deeper[some], same[some]
        head[place] = True
        is_open = (size > 1) & (depth < shallow)
        done = np.repeat(~is_open, size)
        order[ragged(place[~is_open], size[~is_open])] = parted[done]
        item, letter = parted[~done], sorted_letter[~done]
        place, size, depth, same = place[is_open], size[is_open], depth[is_open], same[is_open]
        fresh = np.flatnonzero(np.repeat(same, size))
        letter[fresh] = _letters(eights, starts[item[fresh]], np.repeat(depth[same], size[same]), length)


def _deep(text, starts, order, head, tied, shallow, length) -> None:
    """Order tied groups by the rest of their strings: groups of one distinct rest are done, others go through a blind trie."""
    first = np.maximum.accumulate(np.where(head[tied], np.arange(len(tied)), 0))
    rest = length - shallow
    same = np.ones(len(tied), bool)
    own = starts[order[tied]] + shallow
    eights = _eights(text)
    for i in [*range(0, rest - 7, 8), rest - 8] if rest >= 8 else []:
        letters = eights[own + i]
        same &= letters == letters[first]
    if rest < 8:
        for i in range(rest):
            letters = text[own + i]
            same &= letters == letters[first]
    mixed = np.unique(first[~same])
    ends = np.append(np.flatnonzero(head[tied]), len(tied))
    whole = text.tobytes() if len(mixed) else b""
    for a, b in zip(mixed.tolist(), ends[np.searchsorted(ends, mixed, "right")].tolist(), strict=True):
        by_rest: dict[bytes, list[int]] = {}
        for member in order[tied[a:b]].tolist():
            at = int(starts[member]) + shallow
            by_rest.setdefault(whole[at : at + rest], []).append(member)
        rests = list(by_rest)
        at = int(tied[a])
        for i in blind_trie(rests):
            members = by_rest[rests[i]]
            order[at : at + len(members)] = members
            head[at : at + len(members)] = False
            head[at] = True
            at += len(members)


# ---------------------------------------------------------------- blocks


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(a) for a in arrays], np.int64)
    return zstd.ZstdCompressor(level=1).compress(b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpack(packed: bytes, *types: str) -> list[np.ndarray]:
    raw = zstd.ZstdDecompressor().decompress(packed)
    sizes, at, out = np.frombuffer(raw, np.int64, len(types)), 8 * len(types), []
    for size, kind in zip(sizes.tolist(), types, strict=True):
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out


def _block_rows(batches, n_columns: int, size: int):
    """(block, ids, texts, columns) rows; ``columns`` are the other columns as an Arrow message."""
    claim("suffix_dedup")
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column(n_columns + 1))
        ids = np.array([NO_ID if x is None else x for x in batch.column(n_columns).to_pylist()], np.int64)
        others = pa.RecordBatch.from_arrays(batch.columns[:n_columns], names=[f"c{i}" for i in range(n_columns)])
        for a, b in groups(offsets, size):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, others.schema) as out:
                out.write_batch(others.slice(a, b - a))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [part << 32 | number],
                    "n_bytes": [int(offsets[b] - offsets[a])],
                    "texts": [_pack(ids[a:b], (offsets[a : b + 1] - offsets[a]).astype(np.int64), data[offsets[a] : offsets[b]])],
                    "columns": [zstd.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())],
                }
            )
            number += 1


def _open(texts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, bytes with LENGTH spare ones) of a block."""
    ids, offsets, data = _unpack(texts, "<i8", "<i8", "u1")
    return ids, offsets, np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)])


def _dealt(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 40 bits that tell hashes of a bucket apart)."""
    return ((hashes >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64), hashes & np.uint64((1 << 40) - 1)


def _asked(hashes: np.ndarray, n_buckets: int):
    """Distinct hashes in the order in which they are asked, their buckets' bounds, and each hash's place."""
    bucket, low = _dealt(hashes, n_buckets)
    distinct, place = np.unique(bucket.astype(np.uint64) << np.uint64(40) | low, return_inverse=True)
    return distinct, np.searchsorted(distinct >> np.uint64(40), np.arange(n_buckets + 1)), place


def ask(batches, n_buckets: int):
    """Step 1: (bucket, block, hashes) rows, 5 bytes a hash."""
    claim("suffix_dedup")
    for batch in batches:
        for block, texts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            _, offsets, data = _open(texts)
            distinct, bounds, _ = _asked(anchors(data, offsets)[0], n_buckets)
            used = np.flatnonzero(np.diff(bounds))
            five = np.ascontiguousarray(distinct.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]
            rows = [five[bounds[k] : bounds[k + 1]].tobytes() for k in used.tolist()]
            for at in range(0, len(used), 1024):
                part = used[at : at + 1024]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(part), "block": pa.array([block] * len(part), pa.int64()), "hashes": pa.array(rows[at : at + 1024], pa.binary())})


def answer(table: pa.Table) -> pa.Table:
    """Step 1, a bucket: a bit for each hash that several blocks have; blocks without any get no answer."""
    blocks, buckets = table.column("block").to_pylist(), table.column("bucket").to_pylist()
    lists = []
    for raw in table.column("hashes").to_pylist():
        wide = np.zeros((len(raw) // 5, 8), np.uint8)
        wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
        lists.append(wide.view("<u8").ravel())
    everything = np.sort(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
    often = np.unique(everything[1:][everything[1:] == everything[:-1]])
    out = {"block": [], "bucket": [], "bits": []}
    for block, bucket, own in zip(blocks, buckets, lists, strict=True):
        if len(often) and (hit := often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own).any():
            out["block"].append(block)
            out["bucket"].append(bucket)
            out["bits"].append(np.packbits(hit).tobytes())
    return pa.table({"block": pa.array(out["block"], pa.int64()), "bucket": pa.array(out["bucket"], pa.int64()), "bits": pa.array(out["bits"], pa.binary())})


def contexts(texts: bytes, answers: list[tuple[int, bytes]], n_buckets: int):
    """Step 2: (messages by bucket with contexts of shared anchors, where they stand in the block or None)."""
    ids, offsets, data = _open(texts)
    hashes, first, number, text = anchors(data, offsets)
    distinct, bounds, place = _asked(hashes, n_buckets)
    shared = np.zeros(len(distinct), bool)
    for bucket, bits in answers:
        a, b = int(bounds[bucket]), int(bounds[bucket + 1])
        shared[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
    # Anchors that several texts of this block have.
    low, high = np.full(len(distinct), len(ids)), np.full(len(distinct), -1)
    np.minimum.at(low, place, text)
    np.maximum.at(high, place, text)
    shared |= low < high
    mine = np.flatnonzero(shared[place])
    if len(mine) == 0:
        return [], None
    hashes, first, number, text = hashes[mine], first[mine], number[mine], text[mine]
    with np.errstate(over="ignore"):
        content = _mix(range_hashes(data, first, number + LENGTH - 1) + hashes * np.uint64(3) + number.astype(np.uint64))
    _, sample, which = np.unique(content, return_index=True, return_inverse=True)
    bucket = _dealt(hashes[sample], n_buckets)[0]
    # Contexts in the order of their buckets; ``which`` says for each anchor which context it has.
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    which, sample, bucket = rank[which], sample[order], bucket[order]
    least = np.full(len(sample), NO_ID)
    np.minimum.at(least, which, ids[text])
    ends = np.searchsorted(bucket, np.arange(n_buckets + 1))
    messages = []
    for k in np.unique(bucket).tolist():
        part = sample[ends[k] : ends[k + 1]]
        body = data[ragged(first[part], number[part] + LENGTH - 1)]
        messages.append((k, _pack(number[part].astype(np.uint8), least[ends[k] : ends[k + 1]], body)))
    per_context = number[sample]
    per_bucket = np.bincount(bucket, per_context, n_buckets).astype(np.int64)
    return messages, _pack(first.astype(np.int64), number.astype(np.uint8), which.astype(np.int32), per_context.astype(np.uint8), per_bucket[per_bucket > 0], ids[text] > least[which])


def same_contexts(body: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one context of each kind, kind of every context): grouped by hash, then compared byte for byte."""
    with np.errstate(over="ignore"):
        _, sample, kind = np.unique(range_hashes(body, starts, lengths) + lengths.astype(np.uint64), return_index=True, return_inverse=True)
    eights, own = _eights(body), sample[kind]
    differ = lengths != lengths[own]
    for at in range(0, int(lengths.max()), 8):
        # The last eight bytes of a context, where less than eight are left.
        i = np.minimum(at, np.maximum(lengths - 8, 0))
        differ |= eights[starts + i] != eights[starts[own] + i]
    odd = np.flatnonzero(differ)  # of equal hash but different: each is a kind of its own
    kind[odd] = len(sample) + np.arange(len(odd))
    return np.concatenate([sample, odd]), kind


def smallest(table: pa.Table) -> pa.Table:
    """Step 2, a bucket: for each string of each context, whether a smaller id has it than the context's smallest."""
    claim("suffix_dedup")
    blocks, buckets = table.column("block").to_pylist(), table.column("bucket").to_pylist()
    opened = [_unpack(m, "u1", "<i8", "u1") for m in table.column("message").to_pylist()]
    number = np.concatenate([n for n, _, _ in opened]).astype(np.int64)
    least = np.concatenate([x for _, x, _ in opened])
    body = np.concatenate([*(x for _, _, x in opened), np.zeros(8, np.uint8)])
    lengths = number + LENGTH - 1
    first = np.cumsum(lengths) - lengths
    sample, kind = same_contexts(body, first, lengths)
    owner = np.full(len(sample), NO_ID)
    np.minimum.at(owner, kind, least)
    # Strings start at the first ``number`` places of each context.
    starts = ragged(first[sample], number[sample])
    order, group = deep_shallow(body, starts)
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    minimum = np.empty(len(starts), np.int64)
    minimum[order] = np.minimum.reduceat(np.repeat(owner, number[sample])[order], heads)[group]
    begin = np.cumsum(number[sample]) - number[sample]
    smaller = minimum[ragged(begin[kind], number)] < np.repeat(least, number)
    bits, at = [], 0
    for n, _, _ in opened:
        size = int(n.sum(dtype=np.int64))
        bits.append(np.packbits(smaller[at : at + size]).tobytes())
        at += size
    return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array(buckets, pa.int64()), "bits": pa.array(bits, pa.binary())})


# ---------------------------------------------------------------- post between buckets and blocks


def _post_path(folder: str, kind: str, block: int) -> str:
    return f"{folder}/{kind}-{block}"


def post(folder: str, kind: str, block: int, content: bytes) -> None:
    """Leave a block's post under its name, written aside and moved there whole; what an earlier attempt left is the same and stays."""
    fs, path = open_store(_post_path(folder, kind, block))

    def there() -> bool:
        return fs.get_file_info(path).type != FileType.NotFound

    if there():
        return
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(aside, compression=None) as f:
        f.write(content)
    try:
        fs.move(aside, path)
    except OSError:  # another attempt was first
        if not there():
            raise
        fs.delete_file(aside)


def fetch(folder: str, kind: str, block: int) -> bytes:
    """A block's post; an error if it has none."""
    fs, path = open_store(_post_path(folder, kind, block))
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def _posted(messages: DataFrame, blocks: DataFrame, folder: str, kind: str) -> None:
    """Group (block, bucket, bits) rows by block and post them, an empty list for a block without any; done when this returns."""
    messages = messages.unionByName(blocks.select("block", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bits")))

    def task(table: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return pa.table({"block": pa.array([], pa.int64())})
        block = table.column("block")[0].as_py()
        rows = sorted((k, bits) for k, bits in zip(table.column("bucket").to_pylist(), table.column("bits").to_pylist(), strict=True) if k is not None)
        post(folder, kind, block, pickle.dumps(rows))
        return pa.table({"block": [block]})

    messages.groupBy("block").applyInArrow(task, "block long").agg(F.count("*")).collect()


def _answers(folder: str, kind: str, block: int) -> list[tuple[int, bytes]]:
    return pickle.loads(fetch(folder, kind, block))


def removed(offsets: np.ndarray, where: bytes, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """Step 3: mask of a block's removed bytes."""
    n = int(offsets[-1])
    if not where:
        return np.zeros(n, bool)
    first, number, which, per_context, per_bucket, later = _unpack(where, "<i8", "u1", "<i4", "u1", "<i8", "?")
    number, per_context = number.astype(np.int64), per_context.astype(np.int64)
    if len(answers) != len(per_bucket):
        raise ValueError(f"{len(answers)} answers to {len(per_bucket)} messages")
    # Answers stand in the order of their buckets, as the contexts do.
    bits = [np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool) for (_, raw), n in zip(sorted(answers), per_bucket.tolist(), strict=True)]
    sizes = np.cumsum(per_context)
    smaller = np.concatenate(bits)
    at = ragged((sizes - per_context)[which], number)
    gone = smaller[at] | np.repeat(later, number)
    change = np.zeros(n + 1, np.int32)
    start = ragged(first, number)[gone]
    np.add.at(change, start, 1)
    np.add.at(change, start + LENGTH, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK) -> DataFrame:
    """``docs`` with their text reduced, and n_bytes, n_removed, n_spans, spans (byte ranges removed) and kept."""
    spark = docs.sparkSession
    stay = [c for c in docs.columns if c.lower() not in RESULTS]
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("spans", span), T.StructField("kept", T.BinaryType())]
    schema = T.StructType([docs.schema[c] for c in stay] + added)
    others = [c for c in stay if c != text]
    source = docs.select(*others, docs[key].cast("long").alias("_sa_id"), docs[text].cast("string").alias("_sa_text"))
    n_others = len(others)
    blocks = stored(source.mapInArrow(lambda b: _block_rows(b, n_others, block_bytes), "block long, n_bytes long, texts binary, columns binary"), "blocks")
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_buckets = max(2 * spark.sparkContext.defaultParallelism, total // BUCKET_BYTES)
    folder = scratch_path(spark, "block-post")
    bodies = blocks.select("block", "texts")
    asked = bodies.mapInArrow(lambda b: ask(b, n_buckets), "bucket long, block long, hashes binary")
    _posted(asked.groupBy("bucket").applyInArrow(answer, "block long, bucket long, bits binary"), blocks, folder, "shared")

    def send(batches):
        claim("suffix_dedup")
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                messages, where = contexts(body, _answers(folder, "shared", block), n_buckets)
                post(folder, "where", block, where or b"")
                for at in range(0, len(messages), 256):
                    part = messages[at : at + 256]
                    yield pa.RecordBatch.from_pydict({"bucket": [k for k, _ in part], "block": [block] * len(part), "message": [m for _, m in part]})

    sent = bodies.mapInArrow(send, "bucket long, block long, message binary")
    _posted(sent.groupBy("bucket").applyInArrow(smallest, "block long, bucket long, bits binary"), blocks, folder, "smaller")
    place = stay.index(text)

    def finish(batches):
        claim("suffix_dedup")
        for batch in batches:
            for block, body, columns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _finished(body, columns, fetch(folder, "where", block), _answers(folder, "smaller", block), place, [*stay, *RESULTS])

    return blocks.select("block", "texts", "columns").mapInArrow(finish, schema)


def _finished(texts: bytes, columns: bytes, where: bytes, answers: list, place: int, names: list[str]) -> pa.RecordBatch:
    """A block's rows with reduced texts and results."""
    ids, offsets, data = _open(texts)
    gone = removed(offsets, where, answers)
    edge = np.flatnonzero(np.concatenate([[False], gone]) != np.concatenate([gone, [False]]))
    made = [[] for _ in range(6)]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = gone[a:b]
        turns = edge[np.searchsorted(edge, a, "right") : np.searchsorted(edge, b, "left")] - a
        # A run that begins or ends with the text has no turn inside it.
        if b > a and own[0]:
            turns = np.concatenate([[0], turns])
        if b > a and own[-1]:
            turns = np.concatenate([turns, [b - a]])
        kept = data[a:b][~own].tobytes()
        runs = turns.reshape(-1, 2).tolist()
        for c, v in zip(made, (b - a, int(own.sum()), len(runs), [{"start": s, "end": e} for s, e in runs], kept, kept.decode("utf-8", "ignore")), strict=True):
            c.append(v)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(made, kinds, strict=True)]
    body = arrays.pop()
    with pa.ipc.open_stream(zstd.ZstdDecompressor().decompress(columns)) as stream:
        given = stream.read_next_batch().columns
    return pa.RecordBatch.from_arrays([*given[:place], body, *given[place:], *arrays], names=names)
