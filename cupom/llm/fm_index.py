"""Benchmark decontamination by an FM-index of each training shard.

A shard is a run of documents of ``SHARD_BYTES`` or so. Its words become numbers over the words of the
benchmark; any other word, and each document's end, is a terminator that no phrase contains. Terminators
count as distinct letters ordered by place, so suffixes can be sorted exactly and the
sort never looks past one. The index is the usual one: the Burrows-Wheeler transform of the
shard in a wavelet tree (in level order, one bit vector per level with counts per 64 bits), and
suffix positions sampled at every ``SAMPLE``-th word and after each terminator. All test
phrases are searched backward at once; each occurrence is located by walking to a sampled position; covered words are
merged into spans.

A phrase is a window of ``window`` consecutive item words; an item with fewer words, but not none, is one phrase.
A document is contaminated if it has a hit word and ``share`` of its words at least are hit.

The benchmark is read in blocks of ``BLOCK_WORDS`` words, each written to the shared folder; tasks hold one
block at a time and go through all of them for each shard, so nothing grows with the benchmark but time.

Defined results: null texts have no words and no hits; a document without words isn't contaminated; an item without
words has no phrases; rows that repeat are judged each; items that share an id count as
one; a null item id counts as one item that the list of ids leaves out; an empty benchmark hits nothing; given columns stay except
those named like a result, which are replaced.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.llm.common import claim, text_bytes
from cupom.llm.files import Publisher, open_store
from cupom.llm.words import Words, groups, split
from cupom.session import scratch_path

SHARD_BYTES, BLOCK_WORDS, SAMPLE = 2 << 20, 250_000, 16
KIND, LOWER = "alnum", True
RESULTS = ("n_words", "n_hit", "item_ids", "n_items", "spans", "contaminated")


# ---------------------------------------------------------------- index


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks of numbers below 2^levels; each level keeps its nodes side by side, zeros first."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels, self.zeros = [], []
        for level in range(levels - 1, -1, -1):
            ones = (values >> level & 1).astype(bool)
            self.levels.append(Bits(ones))
            self.zeros.append(len(values) - int(np.count_nonzero(ones)))
            values = np.concatenate([values[~ones], values[ones]])
        starts = np.zeros((1 << levels) + 1, np.int64)  # of each number's own run below the last level
        numbers, first = np.unique(values, return_index=True)
        starts[numbers] = first
        self.starts, self.depth = starts, levels

    def rank(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each number stands before its place."""
        for i, bits in enumerate(self.levels):
            one = (numbers >> (self.depth - 1 - i) & 1).astype(bool)
            ones = bits.rank(at)
            at = np.where(one, self.zeros[i] + ones, at - ones)
        return at - self.starts[numbers]

    def get(self, at: np.ndarray) -> np.ndarray:
        numbers = np.zeros(len(at), np.int64)
        for i, bits in enumerate(self.levels):
            one = bits.get(at).astype(bool)
            numbers = numbers << 1 | one
            ones = bits.rank(at)
            at = np.where(one, self.zeros[i] + ones, at - ones)
        return numbers


def sort_suffixes(text: np.ndarray, levels: int) -> np.ndarray:
    """Places of all letters above 0 in the order of their suffixes; each 0 is smaller than any letter, and than any later 0.

    The first letters, as many as fit 62 bits, are sorted as one number; ties that no 0 ends are
    ordered by the ranks of what follows, over twice the length in each round.
    """
    n = len(text)
    places = np.flatnonzero(text)
    if len(places) == 0:
        return places
    width = 62 // levels
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    key, alive = padded[places].astype(np.int64), np.ones(len(places), bool)
    for i in range(1, width):
        letter = padded[places + i]
        alive &= letter > 0
        key = key << levels | np.where(alive, letter, 0)
    order = np.argsort(key)
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    shift = int(n).bit_length()
    # Ties come in the order of their places: right for those that a 0 ends, a start for the others.
    places = np.sort((np.cumsum(head) - 1) << shift | places[order]) & ((1 << shift) - 1)
    within = np.zeros(n, bool)
    within[np.flatnonzero(text)[alive]] = True
    open_ = within[places] & ~(head & np.concatenate([head[1:], [True]]))
    rank = np.arange(n, dtype=np.int64) - n  # zeros: below all letters, by place
    at = np.arange(len(places))
    group = np.maximum.accumulate(np.where(head, at, 0))
    rank[places] = np.where(open_, group, at)
    step = width
    todo = at[open_]
    while len(todo):
        mine = places[todo]
        first, second = rank[mine], rank[mine + step]
        again = np.lexsort((second, first))
        mine, first, second = mine[again], first[again], second[again]
        places[todo] = mine  # groups are runs of ``todo`` in order, so places stay inside their group
        head = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        alone = head & np.concatenate([head[1:], [True]])
        rank[mine] = np.maximum.accumulate(np.where(head, todo, 0))
        todo = todo[~alone]
        step *= 2
    return places


class FMIndex:
    """Counts and locates phrases in a text of letters 1 .. 2^levels - 1 and terminators 0."""

    def __init__(self, text: np.ndarray, levels: int, sample: int = SAMPLE):
        sorted_ = sort_suffixes(text, levels)
        zeros = np.flatnonzero(text == 0)
        suffixes = np.concatenate([zeros, sorted_])
        before = text[suffixes - 1]  # of place 0: the last letter, a terminator
        self.tree = WaveletTree(before, levels)
        counts = np.bincount(text, minlength=1 << levels)
        self.first = np.concatenate([[0], np.cumsum(counts)])  # rows whose suffix starts with a smaller letter
        marked = (suffixes % sample == 0) | (before == 0)
        self.marks, self.samples = Bits(marked), suffixes[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of phrases of one length, by backward search."""
        last = phrases[:, -1]
        low, high = self.first[last].copy(), self.first[last + 1].copy()
        live = np.flatnonzero(low < high)
        for i in range(phrases.shape[1] - 2, -1, -1):
            if len(live) == 0:
                break
            letter = phrases[live, i]
            both = self.tree.rank(np.concatenate([letter, letter]), np.concatenate([low[live], high[live]]))
            low[live] = self.first[letter] + both[: len(live)]
            high[live] = self.first[letter] + both[len(live) :]
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows: step back through the text until a sampled one."""
        places, todo, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            found = self.marks.get(at).astype(bool)
            places[todo[found]] = self.samples[self.marks.rank(at[found])] + steps
            todo, at = todo[~found], at[~found]
            letter = self.tree.get(at)
            at = self.first[letter] + self.tree.rank(letter, at)
            steps += 1
        return places


# ---------------------------------------------------------------- benchmark


@dataclass
class Block:
    """Phrases of some items: sorted hashes of their words, phrases as letters by length, and items by phrase."""

    words: np.ndarray
    levels: int
    phrases: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # letters; first item of each phrase; items
    ids: list

    def letters(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word from 1 on; 0 for words of no item."""
        known = np.zeros(1 << 18, bool)
        known[(self.words >> np.uint64(46)).astype(np.int64)] = True
        letters = np.zeros(len(hashes), np.int32)
        maybe = np.flatnonzero(known[(hashes >> np.uint64(46)).astype(np.int64)])
        at = np.searchsorted(self.words, hashes[maybe])
        hit = self.words[np.minimum(at, len(self.words) - 1)] == hashes[maybe]
        letters[maybe[hit]] = at[hit] + 1
        return letters


def make_block(items: list[tuple[object, str]], window: int) -> Block:
    data = [(x or "").encode() for _, x in items]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    words = split(np.frombuffer(b"".join(data), np.uint8), offsets, KIND, LOWER)
    known = np.unique(words.hashes)
    block = Block(known, max(1, int(len(known)).bit_length()), [], [])
    numbers: dict = {}
    letters = np.searchsorted(known, words.hashes) + 1
    by_length: dict[int, list] = {}
    for i, (key, _) in enumerate(items):
        own = letters[words.firsts[i] : words.firsts[i + 1]]
        if len(own) == 0:
            continue
        item = numbers.setdefault(key, len(numbers))
        length = min(window, len(own))
        cut = np.lib.stride_tricks.sliding_window_view(own, length)
        by_length.setdefault(length, []).append((cut, np.full(len(cut), item)))
    for parts in by_length.values():
        phrases, which = np.unique(np.concatenate([p for p, _ in parts]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate([o for _, o in parts])]), axis=1)
        block.phrases.append((phrases, np.searchsorted(pairs[0], np.arange(len(phrases) + 1)), pairs[1]))
    block.ids = list(numbers)
    return block


def write_blocks(benchmark: DataFrame, item: str, text: str, window: int) -> list[str]:
    """The benchmark as blocks in the shared folder; one block at a time passes through the driver."""
    folder = scratch_path(benchmark.sparkSession, "benchmark")
    paths, items, size = [], [], 0

    def write():
        file = Publisher(folder, f"block-{len(paths):05d}", ".pickle")
        file.write(pickle.dumps(make_block(items, window)))
        paths.append(file.publish())

    for row in benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).toLocalIterator():
        items.append((row.item, row.text))
        size += len((row.text or "").split()) + 1
        if size >= BLOCK_WORDS:
            write()
            items, size = [], 0
    if items:
        write()
    return paths


_BLOCKS: dict[str, Block] = {}


def load_block(path: str) -> Block:
    claim("fm_index", _BLOCKS.clear)
    if path not in _BLOCKS:
        _BLOCKS.clear()
        fs, name = open_store(path)
        with fs.open_input_stream(name, compression=None) as f:
            _BLOCKS[path] = pickle.loads(f.read())
    return _BLOCKS[path]


# ---------------------------------------------------------------- documents


def find(words: Words, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit word numbers' mask, documents, items): where the block's phrases occur in a shard."""
    hit = np.zeros(len(words.hashes) + 1, np.int64)
    n_docs = len(words.firsts) - 1
    docs, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    letters = block.letters(words.hashes)
    if not letters.any():
        return hit[:-1] > 0, docs[0], items[0]
    # One terminator after each document: word w of document d stands at w + d.
    ends = words.firsts[1:]
    text = np.insert(letters, ends, 0)
    index = FMIndex(text, block.levels)
    for phrases, first_item, owners in block.phrases:
        low, high = index.search(phrases)
        n = high - low
        which = np.repeat(np.arange(len(phrases)), n)
        if len(which) == 0:
            continue
        rows = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]
        places = index.locate(rows)
        doc = np.searchsorted(ends + np.arange(n_docs), places, "left")
        word = places - doc
        np.add.at(hit, word, 1)
        np.add.at(hit, word + phrases.shape[1], -1)
        pairs = np.unique(doc * np.int64(len(phrases)) + which)
        doc, which = pairs // len(phrases), pairs % len(phrases)
        n = first_item[which + 1] - first_item[which]
        docs.append(np.repeat(doc, n))
        items.append(owners[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first_item[which], n)])
    return np.cumsum(hit)[:-1] > 0, np.concatenate(docs), np.concatenate(items)


def judge(words: Words, offsets: np.ndarray, blocks) -> list[tuple]:
    """(n_words, n_hit, item_ids, n_items, spans) per document of a shard, over all blocks."""
    n_docs = len(offsets) - 1
    hit = np.zeros(len(words.hashes), bool)
    found: list[set] = [set() for _ in range(n_docs)]
    for block in blocks:
        mask, docs, items = find(words, block)
        hit |= mask
        for d, i in set(zip(docs.tolist(), items.tolist(), strict=True)):
            found[d].add(block.ids[i])
    rows = []
    counted = np.concatenate([[0], np.cumsum(hit)])
    for d in range(n_docs):
        a, b = int(words.firsts[d]), int(words.firsts[d + 1])
        n_hit = int(counted[b] - counted[a])
        spans = []
        if n_hit:
            own = np.concatenate([[False], hit[a:b], [False]])
            turns = np.flatnonzero(own[1:] != own[:-1])
            base = int(offsets[d])
            spans = [{"start": int(words.starts[a + s]) - base, "end": int(words.ends[a + e - 1]) - base} for s, e in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
        ids = sorted((x for x in found[d] if x is not None), key=str)
        rows.append((b - a, n_hit, ids, len(found[d]), spans))
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 13, share: float = 0.05, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids, n_items, spans (byte ranges to remove) and contaminated."""
    paths = write_blocks(benchmark, item, item_text, window)
    stay = [c for c in docs.columns if c.lower() not in RESULTS and (keep_text or c != text)]
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    results = [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(benchmark.schema[item].dataType)),
        T.StructField("n_items", T.LongType()), T.StructField("spans", span), T.StructField("contaminated", T.BooleanType()),
    ]
    schema = T.StructType([docs.schema[c] for c in stay] + results)
    source = docs.select(*stay, docs[text].cast("string").alias("_fm_text"))
    per_cent = round(1 / share) if share else 0

    def task(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            for a, b in groups(offsets, SHARD_BYTES):
                own = offsets[a : b + 1] - offsets[a]
                words = split(data[offsets[a] : offsets[b]], own, KIND, LOWER)
                rows = judge(words, own, map(load_block, paths))
                columns = list(zip(*rows, strict=True))
                dirty = [h > 0 and (not per_cent or per_cent * h >= n) for n, h, *_ in rows]
                made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), None, pa.int64(), None), strict=True) if t]
                ids = pa.array(columns[2], pa.list_(_arrow_type(benchmark_type)))
                spans = pa.array(columns[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:-1]), made[0], made[1], ids, made[2], spans, pa.array(dirty, pa.bool_())], names=[*stay, *RESULTS])

    benchmark_type = benchmark.schema[item].dataType.simpleString()
    return source.mapInArrow(task, schema)


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}[name]
